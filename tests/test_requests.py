import json

import pytest
from pyspark.sql import functions as F

from rowsentry.fixed_values import FEATURE_COLUMNS
from rowsentry.sources import requests as req, responses as res

DDL = "inference_id STRING, content_type STRING, body STRING"
ONE = ("Dream", 41.5, 17.25, 201.0, 3925.0, "FEMALE")
LINE = "Dream,41.5,17.25,201,3925,FEMALE"
JSON_BODY = json.dumps(dict(zip(FEATURE_COLUMNS, ("Dream", 41.5, 17.25, 201, 3925, "FEMALE"))))


def features(row):
    return tuple(row[c] for c in FEATURE_COLUMNS)


def test_csv_body_with_blanks_and_lines(spark):
    df = spark.createDataFrame([("a", "text/csv", f" \r\n\t {LINE} \n\n"),
                                ("b", "text/csv", "Dream, 1.5,2,3,4,FEMALE\nBiscoe,NA,2,3,4,MALE,Gentoo\r\n")], DDL)
    got = {(r["inference_id"], r["row_no"]): r for r in req.parse_csv_requests(df).collect()}
    assert features(got[("a", 0)]) == ONE
    assert features(got[("b", 0)]) == ("Dream", 1.5, 2.0, 3.0, 4.0, "FEMALE")
    assert features(got[("b", 1)]) == ("Biscoe", None, 2.0, 3.0, 4.0, "MALE")
    assert all(r["error"] is None for r in got.values()) and len(got) == 3


def test_csv_quotes(spark):
    df = spark.createDataFrame([("a", "text/csv", '"Dre,am",41.5,17.25,201,3925,FEMALE')], DDL)
    assert features(req.parse_csv_requests(df).first())[0] == "Dre,am"


def test_csv_errors(spark):
    df = spark.createDataFrame([("a", "text/csv", None), ("b", "text/csv", "x,1"), ("c", "text/csv", "x,one,2,3,4,MALE"), ("d", "text/csv", " \n ")], DDL)
    got = {r["inference_id"]: r["error"] for r in req.parse_csv_requests(df).collect()}
    assert got == {"a": "No input data received.", "b": "Expected 6 values, got 2.", "c": "The input could not be read.", "d": "No input data received."}
    with pytest.raises(Exception, match="No input data received"):
        req.parse_csv_requests(df.filter("inference_id = 'a'"), strict=True).collect()


def test_json_binds_by_name(spark):
    swapped = json.dumps(dict(reversed(list(json.loads(JSON_BODY).items()))))
    df = spark.createDataFrame([("a", "application/json", JSON_BODY), ("b", "application/json", swapped),
                                ("c", "application/json", JSON_BODY[:-1] + ',"species":"Adelie"}'),
                                ("d", "application/json", '{"island":"Dream"}'), ("e", "application/json", "{"), ("f", "application/json", None)], DDL)
    got = {r["inference_id"]: r for r in req.parse_json_requests(df).collect()}
    assert features(got["a"]) == features(got["b"]) == features(got["c"]) == ONE
    assert got["d"]["error"].startswith("Missing values: culmen_length_mm")
    assert got["e"]["error"] == "The input could not be read." and got["f"]["error"] == "No input data received."


def test_routing(spark):
    df = spark.createDataFrame([("a", "text/csv", LINE), ("b", "application/json", JSON_BODY),
                                ("c", "application/xml", "<row/>"), ("d", None, "?")], DDL)
    parsed = req.parse_requests(df)
    good, bad = req.split_errors(parsed)
    assert {features(r) for r in good.collect()} == {ONE} and good.count() == 2
    assert {r["inference_id"]: r["error"] for r in bad.collect()} == {
        "c": "Content type application/xml is not supported.", "d": "Content type null is not supported."}
    with pytest.raises(Exception, match="application/xml is not supported"):
        req.route_by_content_type(df.filter("inference_id = 'c'"), strict=True).collect()


def test_request_lines_round_trip(spark, labelled):
    lines = req.to_request_lines(labelled, "id", list(FEATURE_COLUMNS))
    back = req.parse_csv_requests(lines.withColumn("content_type", F.lit("text/csv")))
    joined = back.withColumn("id", F.col("inference_id").cast("int")).select("id", *FEATURE_COLUMNS)
    assert joined.exceptAll(labelled.select("id", *FEATURE_COLUMNS)).isEmpty() and joined.count() == 333


def test_model_responses(spark):
    body = '{"predictions": [[0.1, 0.2, 0.7], [0.5, 0.5, 0.0]]}'
    df = spark.createDataFrame([("a", "application/json", body), ("b", "application/json", None), ("c", "application/json", ""),
                                ("d", "text/x", body), ("e", "application/json", "{}")], DDL)
    got = {(r["inference_id"], r["row_no"]): (r["probabilities"], r["error"]) for r in res.parse_model_response(df).collect()}
    assert got[("a", 0)] == ([0.1, 0.2, 0.7], None) and got[("a", 1)] == ([0.5, 0.5, 0.0], None)
    empty = "No predictions/probabilities received from the model."
    assert got[("b", 0)] == (None, empty) and got[("c", 0)] == (None, empty)
    assert got[("d", 0)][1] == "text/x is not supported." and got[("e", 0)][1]
    with pytest.raises(Exception, match="is not supported"):
        res.parse_model_response(df.filter("inference_id = 'd'"), strict=True).collect()


def test_instances(spark):
    df = spark.createDataFrame([("r", 1, 3.0, 4.0), ("r", 0, 1.0, 2.0)], "req STRING, row_no INT, a DOUBLE, b DOUBLE")
    assert json.loads(res.render_instances(df, ["a", "b"], "req").first()["body"]) == {"instances": [[1.0, 2.0], [3.0, 4.0]]}
    assert json.loads(res.render_instances(df.limit(1), ["a", "b"]).first()["body"]) == {"instances": [[3.0, 4.0]]}


def test_rendered_predictions(spark):
    rows = [("m", "application/json", 0, "Gentoo", 0.75), ("m", "application/json", 1, "Adelie", 0.625), ("m", "application/json", 2, "Gentoo", 0.5),
            ("s", "application/json", 0, "Gentoo", 0.875), ("c", "text/csv", 0, "Adelie", 0.5), ("c", "text/csv", 1, "Gentoo", 0.25), ("x", "image/png", 0, "Adelie", 0.375)]
    df = spark.createDataFrame(rows, "inference_id STRING, accept STRING, row_no INT, prediction STRING, confidence DOUBLE")
    got = {r["inference_id"]: r for r in res.render_predictions(df).collect()}
    assert json.loads(got["m"]["response"]) == [{"0": "Gentoo", "1": 0.75}, {"0": "Adelie", "1": 0.625}, {"0": "Gentoo", "1": 0.5}]
    assert json.loads(got["s"]["response"]) == {"0": "Gentoo", "1": 0.875}
    assert got["c"]["response"] == "Adelie,0.5\nGentoo,0.25"
    assert got["x"]["response"] is None and got["x"]["error"] == "image/png accept type is not supported."
    single = df.withColumn("n_rows", F.when(F.col("inference_id").isin("s", "x"), 1).otherwise(F.when(F.col("inference_id") == "c", 2).otherwise(3)))
    again = {r["inference_id"]: (r["response"], r["error"]) for r in res.render_predictions(single).collect()}
    assert again == {k: (r["response"], r["error"]) for k, r in got.items()}
    with pytest.raises(Exception, match="accept type is not supported"):
        res.render_predictions(df.filter("inference_id = 'x'"), strict=True).collect()


def test_single_row_requests_are_answered_without_a_shuffle(spark):
    df = spark.createDataFrame([(None, "text/csv", 0, 1, "Adelie", 0.5), (None, "text/csv", 0, 1, "Gentoo", 0.25)],
                               "inference_id STRING, accept STRING, row_no INT, n_rows INT, prediction STRING, confidence DOUBLE")
    assert sorted(r["response"] for r in res.render_predictions(df).collect()) == ["Adelie,0.5", "Gentoo,0.25"]
    several = df.withColumn("n_rows", F.lit(2))
    assert [r["error"] for r in res.render_predictions(several).collect()] == ["A request of several rows needs an id."]


def test_request_sizes(spark):
    df = spark.createDataFrame([("a", "text/csv", "1\n2\n\n3"), ("b", "text/csv", None), ("c", "application/json", '{"x": 1}'), ("d", "z", "q")], DDL)
    got = [(r["inference_id"], r["row_no"], r["n_rows"], r["x"]) for r in req.parse_requests(df, "x INT").orderBy("inference_id", "row_no").collect()]
    assert got == [("a", 0, 3, 1), ("a", 1, 3, 2), ("a", 2, 3, 3), ("b", 0, 1, None), ("c", 0, 1, 1), ("d", 0, 1, None)]


def test_every_spelling_of_a_missing_value_is_null(spark):
    from rowsentry.fixed_values import NULL_MARKERS

    rows = [(str(i), "text/csv", f"{m},{m},1.5") for i, m in enumerate(NULL_MARKERS)]
    got = req.parse_csv_requests(spark.createDataFrame(rows, DDL), "a STRING, b DOUBLE, c DOUBLE").collect()
    assert len(got) == len(NULL_MARKERS) and {(r["a"], r["b"], r["c"], r["error"]) for r in got} == {(None, None, 1.5, None)}


def test_quoted_line_breaks_stay_in_their_field(spark):
    rows = [("a", "text/csv", '"first\nsecond",1\r\n"say ""hi"", you",2\n\nplain,3'), ("b", "text/csv", 'x,1\ny,2'), ("c", "text/csv", 'open "quote,1')]
    got = req.parse_csv_requests(spark.createDataFrame(rows, DDL), "t STRING, n INT").orderBy("inference_id", "row_no").collect()
    assert [(r["t"], r["n"], r["n_rows"]) for r in got[:5]] == [("first\nsecond", 1, 3), ('say "hi", you', 2, 3), ("plain", 3, 3), ("x", 1, 2), ("y", 2, 2)]


def test_request_lines_keep_nulls_and_awkward_texts(spark):
    rows = [(1, "a,b", 1.5), (2, None, None), (3, 'say "x"', 2.0), (4, "two\nlines", -1.0), (5, "plain", None)]
    df = spark.createDataFrame(rows, "id INT, t STRING, x DOUBLE")
    back = req.parse_csv_requests(req.to_request_lines(df, "id", ["t", "x"]), "t STRING, x DOUBLE")
    assert sorted((int(r["inference_id"]), r["t"], r["x"]) for r in back.collect()) == rows


def test_a_request_is_answered_once_whole_or_with_an_error(spark):
    kinds = "inference_id STRING, accept STRING, row_no INT, n_rows INT, prediction STRING, confidence DOUBLE, error STRING"
    rows = [("three", "text/csv", 0, 3, "a", 0.5, None), ("three", "text/csv", 1, 3, None, None, "second is bad"), ("three", "text/csv", 2, 3, "b", 0.5, None),
            ("two", "application/json", 0, 2, None, None, "first is bad"), ("two", "application/json", 1, 2, "b", 0.25, None),
            ("good", "application/json", 0, 2, "a", 0.5, None), ("good", "application/json", 1, 2, "b", 0.25, None),
            ("one", "application/json", 0, 1, None, None, "bad"), ("lost", "application/json", 1, 2, "a", 0.5, None),
            ("null", "text/csv", 0, 1, None, 0.5, None), ("comma", "text/csv", 0, 1, "a,b", None, None)]
    got = {r["inference_id"]: (r["response"], r["error"]) for r in res.render_predictions(spark.createDataFrame(rows, kinds)).collect()}
    assert got == {"three": (None, "second is bad"), "two": (None, "first is bad"), "one": (None, "bad"),
                   "lost": (None, "Rows of the request are missing."), "good": ('[{"0":"a","1":0.5},{"0":"b","1":0.25}]', None),
                   "null": (",0.5", None), "comma": ('"a,b",', None)}


def test_bodies_are_read_once(spark):
    from rowsentry.operators import features, scoring

    rows = spark.createDataFrame([("a", 1.0, "x"), ("b", 2.0, "y"), ("a", 3.0, "x")], "kind STRING, size DOUBLE, label STRING")
    fitted = features.fit_columns(rows, "label")
    sent = spark.createDataFrame([("1", "text/csv", "text/csv", "a,1.0"), ("2", "application/json", "application/json", '{"kind": "c", "size": 2}'),
                                  ("3", "text/csv", "text/csv", "a,1.0\nb,2.0")], "inference_id STRING, content_type STRING, accept STRING, body STRING")
    model = scoring.SoftmaxModel([[0.0] * 3, [1.0] * 3], [0.0, 0.0])
    answers = scoring.answer_requests(*scoring.score_requests(sent, fitted, model, ["x", "y"], "kind STRING, size DOUBLE"))
    assert {r["inference_id"]: r["error"] is None for r in answers.collect()} == {"1": True, "2": False, "3": True}
    plan = answers._jdf.queryExecution().optimizedPlan().toString()
    assert "from_csv" not in plan and "from_json" not in plan and "csvtostructs" not in plan.lower(), plan
