from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rowsentry.fixed_values import FEATURE_DDL
from rowsentry.operators import split
from rowsentry.sources import captures, reports, tables


def write(path, text):
    p = Path(path)
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_text(text)


HEAD = "species,island,culmen_length_mm,culmen_depth_mm,flipper_length_mm,body_mass_g,sex\n"


def test_labelled_csv_reads_every_file_and_null_spelling(spark, folder):
    write(f"{folder}/d/a.csv", HEAD + "Chinstrap,Dream,51.25,19.5,203,4025,FEMALE\nAdelie,Biscoe,NA,N/A,,nan,NA\n")
    write(f"{folder}/d/b.csv", HEAD + "Gentoo,Dream,43.75,14.5,211.0,4625,.\n")
    got = tables.read_labelled_csv(spark, f"{folder}/d")
    assert dict(got.dtypes)["flipper_length_mm"] == "double"
    assert {tuple(r) for r in got.collect()} == {
        ("Chinstrap", "Dream", 51.25, 19.5, 203.0, 4025.0, "FEMALE"), ("Adelie", "Biscoe", None, None, None, None, None),
        ("Gentoo", "Dream", 43.75, 14.5, 211.0, 4625.0, ".")}


def test_headerless_csv(spark, folder):
    write(f"{folder}/t.csv", "Dream,50.5,18.25,199.0,3850.0,FEMALE\n")
    assert tuple(tables.read_headerless_csv(spark, f"{folder}/t.csv", FEATURE_DDL).first()) == ("Dream", 50.5, 18.25, 199.0, 3850.0, "FEMALE")


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_split_layout(spark, labelled, folder, fmt):
    tables.write_splits(split.split_and_fold(labelled, "species", "id"), f"{folder}/s", fmt)
    names = {p.name for p in Path(f"{folder}/s").iterdir() if p.is_dir()}
    assert names == {"split=test", "split=train", "split=validation"}
    assert {p.name for p in Path(f"{folder}/s/split=train").iterdir() if p.is_dir()} == {"fold=1", "fold=2", "fold=3"}
    if fmt == "parquet":
        part = tables.read_split(spark, f"{folder}/s", "train", 3)
        assert part.count() == 212
        assert "PartitionFilters: [isnotnull(split" in part._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        tables.write_splits(labelled, f"{folder}/x", "xml")


def test_ground_truth_events(spark, folder):
    labels = spark.createDataFrame([(0, "Adelie"), (1, "Gentoo")], "id INT, y STRING")
    lines = labels.orderBy("id").select(captures.ground_truth_event(F.col("id"), F.col("y")).alias("v")).collect()
    assert lines[0]["v"] == '{"groundTruthData":{"data":"Adelie","encoding":"CSV"},"eventMetadata":{"eventId":"0"},"eventVersion":"0"}'
    write(f"{folder}/g/2024/03/05/07/0809.jsonl", "\n".join(r["v"] for r in lines))
    got = captures.read_ground_truth(spark, f"{folder}/g").orderBy("inference_id").collect()
    assert [(r["inference_id"], r["truth"], str(r["gt_ts"])) for r in got] == [
        ("0", "Adelie", "2024-03-05 07:08:09"), ("1", "Gentoo", "2024-03-05 07:08:09")]


CAPTURE_DDL = "inference_id STRING, ts TIMESTAMP, content_type STRING, input STRING, output STRING"


def traffic(spark, n=40):
    df = spark.range(n).select(
        F.col("id").cast("string").alias("inference_id"), F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 300).alias("ts"),
        F.when(F.col("id") % 10 == 9, "image/png").otherwise("text/csv").alias("content_type"), F.lit("1,2").alias("input"), F.lit("x").alias("output"))
    return df


def test_captures_keep_known_types_by_hour(spark, folder):
    captures.capture_inferences(traffic(spark), f"{folder}/c")
    assert captures.read_captures(spark, f"{folder}/c").count() == 36
    hour = captures.read_captures(spark, f"{folder}/c", "2024-01-01", 1)
    assert hour.count() == 11 and {r["hour"] for r in hour.collect()} == {1}
    captures.capture_inferences(traffic(spark), f"{folder}/h", percent=50)
    assert 0 < captures.read_captures(spark, f"{folder}/h").count() < 36


def test_streamed_captures(spark, folder):
    traffic(spark).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(CAPTURE_DDL).parquet(f"{folder}/in")
    captures.stream_captures(stream, f"{folder}/c", f"{folder}/ck").awaitTermination(120)
    assert captures.read_captures(spark, f"{folder}/c").count() == 36


def test_violations_round_trip(spark, folder):
    found = spark.createDataFrame([("r1", "sex", "completeness", "d"), ("r1", "mass", "sign", "e"), ("r2", "a", "b", "c")],
                                  "run_id STRING, column STRING, check STRING, detail STRING")
    reports.write_violations(found, f"{folder}/v")
    back = reports.read_violations(spark, f"{folder}/v")
    assert {tuple(r) for r in back.select(*found.columns).collect()} == {tuple(r) for r in found.collect()}
    assert {(r["window_start"], r["value"], r["floor"]) for r in back.collect()} == {(None, None, None)}
    write(f"{folder}/one/v.json", '{"run_id": "r",\n "violations": [\n {"column": "sex", "check": "c", "detail": "d"}]}')
    assert tuple(reports.read_violations(spark, f"{folder}/one", multi_line=True).select(*found.columns).first()) == ("r", "sex", "c", "d")


def test_metrics_table_appends(spark, folder):
    rows = spark.createDataFrame([("accuracy", 0.5)], "metric STRING, value DOUBLE")
    reports.write_metrics(rows, f"{folder}/m", "a")
    reports.write_metrics(rows, f"{folder}/m", "b")
    got = spark.read.parquet(f"{folder}/m")
    assert set(got.columns) == set(reports.METRIC_COLUMNS) and got.count() == 2
