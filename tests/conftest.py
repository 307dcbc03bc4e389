import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from rowsentry.session import local_session  # noqa: E402

FEATURES_DDL = ("id INT, species STRING, island STRING, culmen_length_mm DOUBLE, culmen_depth_mm DOUBLE, "
                "flipper_length_mm DOUBLE, body_mass_g DOUBLE, sex STRING")
COUNTS = {"Adelie": 146, "Chinstrap": 68, "Gentoo": 119}


@pytest.fixture(scope="session")
def spark():
    with tempfile.TemporaryDirectory(prefix="tests-") as shared:
        session = local_session(4, "tests", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.checkpoint.dir": shared})
        yield session
        session.stop()


def birds():
    """Rows by rule: the class sizes of the cleaned table, and features that depend on the class."""
    rows = []
    islands = {"Adelie": ["Biscoe", "Dream", "Torgersen"], "Chinstrap": ["Dream"], "Gentoo": ["Biscoe"]}
    base = {"Adelie": (38.0, 18.0, 190.0, 3700.0), "Chinstrap": (48.0, 18.5, 196.0, 3730.0), "Gentoo": (47.0, 15.0, 217.0, 5080.0)}
    n = 0
    for name, count in COUNTS.items():
        for i in range(count):
            a, b, c, d = base[name]
            rows.append((n, name, islands[name][i % len(islands[name])], a + (i % 7) * 0.5, b + (i % 5) * 0.2,
                         c + (i % 9), d + (i % 11) * 25.0, "MALE" if i % 2 else "FEMALE"))
            n += 1
    return rows


@pytest.fixture(scope="session")
def labelled(spark):
    return spark.createDataFrame(birds(), FEATURES_DDL)


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path)
