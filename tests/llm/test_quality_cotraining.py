import numpy as np
import pyarrow as pa
import pytest

from rowsentry.llm import quality_cotraining as qc

WORDS = [f"{a}{b}" for a in ("ka", "lo", "mi", "ter", "on", "sal") for b in ("pa", "ra", "tu", "ven", "dor", "mik")]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(0)
    docs, labels = [], []
    for i in range(600):
        words = rng.choice(WORDS, rng.integers(20, 80)).tolist()
        bad = i % 4 == 0
        text = " ".join(f"{w.upper()}!!" for w in words) if bad else ". ".join(" ".join(words[k: k + 9]) for k in range(0, len(words), 9)) + "."
        docs.append((i, text, "en" if i % 3 else None, "spam" if bad and i % 8 else f"s{i % 5}", "clash"))
        if i % 2 == 0:
            labels.append((i, 0 if bad else 1))
    docs += [(800, None, None, None, ""), (801, "", "en", "s1", ""), (802, "ABSURD!! " * 20_000, "en", "spam", ""), (2, docs[2][1], docs[2][2], docs[2][3], "")]
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, keep string"),
            spark.createDataFrame([*labels, (2, 0), (None, 1), (7777, None)], "doc_id long, quality int"))


def test_unlabelled_documents_are_told_apart(corpus):
    got = qc.classify(*corpus).collect()
    assert len(got) == 604 and "text" not in got[0]
    by = {r["doc_id"]: r for r in got}
    assert np.mean([by[i]["keep"] == (i % 4 != 0) for i in range(1, 600, 2)]) >= 0.98
    assert np.mean([by[i]["keep"] == (i % 4 != 0) for i in range(600)]) >= 0.98
    assert not by[802]["keep"] and all(0 <= r["quality_score"] <= 1 for r in got)
    assert len({r["quality_score"] for r in got if r["doc_id"] == 2}) == 1


def test_defined_results_without_labels_or_rows(spark, corpus):
    docs, labels = corpus
    assert {r["quality_score"] for r in qc.classify(docs, labels.filter("false")).collect()} == {0.5}
    assert {r["keep"] for r in qc.classify(docs, labels.filter("quality = 1")).collect()} == {True}
    assert {r["keep"] for r in qc.classify(docs, labels.filter("quality = 0 and doc_id > 2")).collect()} == {False}
    assert qc.classify(docs.filter("false"), labels).count() == 0
    assert qc.classify(docs.select("doc_id", "text"), labels).count() == 604


def test_views_read_what_they_say():
    column = pa.array(["AB cd cd\n\nx.", None, "é|é|"])
    text, meta = qc.text_view(column), qc.metadata_view(column, pa.array(["en", None, "en"]), pa.array([None, None, "s"]))
    assert text.shape == (3, qc.TEXT_FEATURES) and meta.shape == (3, qc.META_FEATURES)
    share = lambda x: int(np.searchsorted(qc._EDGES, x, side="right"))
    assert text[0, 0] == share(2 / 7) and text[0, 8] == share(3 / 4) and text[0, 9] == share(1 / 4) and text[2, 2] == share(2 / 6)
    assert (text[1] == 0).all()
    lines = lambda n: int(np.log2(1 + n) * 2)
    assert meta[0, 1] == lines(3) and meta[1, 1] == lines(1) and meta[0, 4] == share(1 / 3) and meta[0, 5] == lines(8)
    assert meta[1, 6] == 0 and meta[0, 6] == meta[2, 6] > 0 and meta[0, 7] == 0 < meta[2, 7]


def test_weights_settle_where_a_view_parts_the_labels_almost_surely():
    middle = np.arange(-11.75, 12, 0.5)[:, None]
    good, bad = np.zeros(48), np.zeros(48)
    for k, n in {13: 1, 21: 2, 22: 2, 23: 1, 24: 2, 25: 4, 26: 7, 27: 4, 28: 6, 29: 4, 30: 5, 31: 4, 32: 4, 33: 3, 35: 4, 37: 3, 38: 1, 39: 1, 40: 2}.items():
        good[k] = n
    for k, n in {0: 11, 1: 2, 2: 3, 3: 3, 4: 5, 5: 2, 7: 1, 11: 2, 12: 1}.items():
        bad[k] = n
    slope, offset = qc._logistic(middle, good, bad)
    chance = 1 / (1 + np.exp(-(slope * middle[:, 0] + offset)))
    assert (chance[good > 0] > 0.5).all() and (chance[bad > 0] < 0.5).all()
    assert np.allclose(middle[:, 0] @ (good - (good + bad) * chance), 0.01 * slope, atol=1e-6)
