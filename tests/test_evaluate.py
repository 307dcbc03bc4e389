import json

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from rowsentry.operators import evaluate
from rowsentry.sources import reports


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.range(2000).select(
        (F.col("id") % 3).cast("string").alias("truth"),
        F.when(F.col("id") % 7 < 5, F.col("id") % 3).otherwise((F.col("id") * 5) % 3).cast("string").alias("prediction"))


def test_metrics_agree_with_sparks_own(pairs):
    got = {r["metric"]: r["value"] for r in evaluate.multiclass_metrics(evaluate.confusion_matrix(pairs)).collect()}
    numbers = pairs.select(F.col("truth").cast("double").alias("label"), F.col("prediction").cast("double").alias("prediction"))
    for ours, theirs in (("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"), ("weighted_recall", "weightedRecall"), ("weighted_f1", "f1")):
        assert got[ours] == pytest.approx(MulticlassClassificationEvaluator(metricName=theirs).evaluate(numbers))


def test_confusion_total_and_accuracy(pairs):
    matrix = evaluate.confusion_matrix(pairs)
    assert matrix.agg(F.sum("n")).first()[0] == 2000
    direct = evaluate.accuracy(pairs).first()["accuracy"]
    from_matrix = {r["metric"]: r["value"] for r in evaluate.multiclass_metrics(matrix).collect()}["accuracy"]
    assert direct == pytest.approx(from_matrix)


def test_class_never_predicted(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", None)], "truth STRING, prediction STRING")
    got = {r["label"]: r for r in evaluate.class_metrics(evaluate.confusion_matrix(df)).collect()}
    assert got["b"]["precision"] == got["b"]["recall"] == got["b"]["f1"] == 0.0
    assert got["a"]["precision"] == 0.5 and got["a"]["recall"] == 1.0
    assert evaluate.accuracy(df).first()["accuracy"] == pytest.approx(1 / 3)


def test_report_shape_and_path(spark, pairs, folder):
    long = evaluate.predictions_by_model(pairs, "truth", {f"model_{i}": "prediction" for i in (1, 2, 3)})
    report = evaluate.eval_report(evaluate.evaluate_models(long))
    doc = json.loads(report.first()["report"])
    assert set(doc["metrics"]["accuracy"]) == {"model_1", "model_2", "model_3"}
    reports.write_eval_report(report, f"{folder}/r")
    back = reports.read_eval_report(spark, f"{folder}/r").select(reports.read_report_path("report")).first()[0]
    assert back == doc["metrics"]["accuracy"]["model_1"]


def test_model_quality_floor(spark):
    floors = evaluate.suggest_model_constraints(spark.createDataFrame([("accuracy", 0.8), ("weighted_f1", 0.7)], "metric STRING, value DOUBLE"))
    now = spark.createDataFrame([("accuracy", 0.75), ("weighted_f1", 0.7)], "metric STRING, value DOUBLE")
    assert [tuple(r) for r in evaluate.check_model_quality(now, floors).collect()] == [("accuracy", 0.75, 0.8)]


def test_batch_score_keeps_three_columns(spark):
    df = spark.createDataFrame([(1.0, "Gentoo", "Adelie", 0.52)], "x DOUBLE, species STRING, prediction STRING, confidence DOUBLE")
    out = evaluate.batch_score_with_source(df, "species")
    assert out.columns == ["truth", "prediction", "confidence"] and tuple(out.first()) == ("Gentoo", "Adelie", 0.52)
