import pytest
from pyspark.sql import functions as F

from rowsentry.functions import arrays
from rowsentry.functions.keys import hash_percent
from rowsentry.functions.text import drop_trailing_label, record_to_map
from rowsentry.operators import rows


def test_clean_rows_drops_missing_and_foreign_values(spark):
    raw = [("Adelie", "39.1", "181", "MALE"), ("Adelie", "NA", "195", "MALE"), ("Gentoo", "44.5", "216", "."),
           ("Adelie", "40.3", "195", "NA"), ("Gentoo", "50.0", "220", "FEMALE"), ("Gentoo", None, "220", "FEMALE")]
    df = spark.createDataFrame(raw, "species STRING, length STRING, flipper STRING, sex STRING")
    out = rows.clean_rows(df, domains={"sex": ["MALE", "FEMALE"]}, numeric=["length", "flipper"])
    assert [tuple(r) for r in out.collect()] == [("Adelie", 39.1, 181.0, "MALE"), ("Gentoo", 50.0, 220.0, "FEMALE")]
    assert dict(out.dtypes)["flipper"] == "double"


def test_projections(spark, labelled):
    x, y = rows.split_features_label(labelled)
    assert "species" not in x.columns and y.columns == ["species"]
    assert rows.tail_columns(labelled, 2).columns == ["body_mass_g", "sex"]
    assert rows.tail_columns(labelled, 7, rest=True).columns == ["id"]
    assert rows.select_by_dtype(labelled, "categorical", "species").columns == ["island", "sex"]
    numeric = rows.select_by_dtype(labelled, "numeric")
    assert numeric.columns[0] == "id" and set(dict(numeric.dtypes).values()) == {"double"}
    with pytest.raises(ValueError):
        rows.rename_by_position(labelled, ["a"])
    with pytest.raises(ValueError, match="species"):
        rows.split_features_label(x)


def test_record_to_map_pads_keys_and_keeps_blanks(spark):
    line = ",".join(["a", " b", "", *map(str, range(98))])
    got = spark.createDataFrame([(line,)], "input STRING").select(record_to_map("input").alias("m")).first()["m"]
    assert got["00"] == "a" and got["01"] == " b" and got["02"] == "" and got["10"] == "7" and got["100"] == "97"
    assert set(got) == {str(i).zfill(2) for i in range(101)}
    one = spark.createDataFrame([("Torgersen,39.1,18.7",)], "input STRING")
    assert rows.with_record_hook(one).first()["record"] == {"00": "Torgersen", "01": "39.1", "02": "18.7"}
    hooked = rows.with_record_hook(one, lambda d: d.withColumn("record", F.upper("input")))
    assert hooked.first()["record"] == "TORGERSEN,39.1,18.7"


def test_record_columns_bind_names_and_types(spark):
    df = spark.createDataFrame([("Torgersen,39.1",), ("Dream,x",), ("Dream",)], "input STRING")
    out = rows.record_columns(rows.with_record_hook(df), "island STRING, culmen_length_mm DOUBLE").drop("input")
    assert [tuple(r) for r in out.collect()] == [("Torgersen", 39.1), ("Dream", None), ("Dream", None)]


EVENT_DDL = ("`detail-type` STRING, source ARRAY<STRING>, detail STRUCT<ModelPackageGroupName: STRING, "
             "ModelPackageVersion: INT, ModelApprovalStatus: STRING>")


def test_event_pattern_on_structs_and_arrays(spark):
    events = [("State Change", ["origin.a"], ("g", 1, "Approved")), ("State Change", ["origin.a"], ("g", 2, "Rejected")),
              ("Other", ["origin.a"], ("g", 3, "Approved")), ("State Change", ["b", "c"], ("g", 4, "Approved")),
              ("State Change", None, ("g", 5, "Approved"))]
    df = spark.createDataFrame(events, EVENT_DDL)
    pattern = {"source": ["origin.a"], "detail-type": ["State Change"], "detail": {"ModelPackageGroupName": ["g"], "ModelApprovalStatus": ["Approved"]}}
    assert [r["detail"]["ModelPackageVersion"] for r in rows.event_pattern_filter(df, pattern).collect()] == [1]


def test_event_pattern_on_json(spark):
    df = spark.createDataFrame([('{"a":{"b-c":"x"},"n":3}',), ('{"a":{"b-c":"y"},"n":3}',), ("broken",)], "body STRING")
    kept = rows.event_pattern_filter(df, {"a": {"b-c": ["x", "z"]}, "n": [3]}, "body")
    assert kept.count() == 1


def test_quality_gate_is_inclusive(spark):
    reports = spark.createDataFrame([('{"metrics":{"accuracy":{"model_1":0.6}}}',), ('{"metrics":{"accuracy":{"model_1":0.59}}}',), ("{}",)], "report STRING")
    got = [(r["passed"], r["message"]) for r in rows.quality_gate(reports).collect()]
    text = "Model's accuracy is less than accuracy threshold 0.6"
    assert got == [(True, None), (False, text), (False, text)]
    assert rows.quality_gate(reports.filter("report like '%0.6}%'"), strict=True).collect()[0]["passed"]
    with pytest.raises(Exception, match="less than accuracy threshold"):
        rows.quality_gate(reports, strict=True).collect()


def test_label_codes_and_argmax(spark):
    domain = ["Adelie", "Chinstrap", "Gentoo"]
    df = spark.createDataFrame([("Gentoo", [0.1, 0.6, 0.3]), ("nobody", [0.4, 0.4, 0.2])], "y STRING, p ARRAY<DOUBLE>")
    got = df.select(arrays.encode_label("y", domain).alias("c"), arrays.argmax("p").alias("a"), arrays.confidence("p").alias("f"),
                    arrays.decode_label(arrays.argmax("p"), domain).alias("d")).collect()
    assert [tuple(r) for r in got] == [(2, 1, 0.6, "Chinstrap"), (None, 0, 0.4, "Adelie")]
    assert df.select(arrays.decode_label(F.lit(3), domain).alias("d")).first()["d"] is None


def test_drop_trailing_label_per_row(spark):
    df = spark.createDataFrame([(["a", "b", "L"],), (["a", "b"],), (["a"],)], "f ARRAY<STRING>")
    assert [r["x"] for r in df.select(drop_trailing_label("f", 2).alias("x")).collect()] == [["a", "b"], ["a", "b"], ["a"]]


def test_hash_percent_range(spark):
    got = spark.range(2000).select(hash_percent("id").alias("b")).agg(F.min("b"), F.max("b")).first()
    assert tuple(got) == (0, 99)
