"""Scores, reports, gates and multiclass quality on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.catalog import query, table
from rowsentry.functions.arrays import argmax
from rowsentry.operators import evaluate as ops, rows, scoring
from rowsentry.sources.reports import read_report_path

LIMITS = {"model_1": 500, "model_2": 1500, "model_3": 5000}


def labelled_documents(spark, sf):
    """Documents with their label and one rule-based guess per model."""
    docs = table(spark, sf, "documents").select("doc_id", "n_chars", "source")
    joined = docs.join(table(spark, sf, "labels"), "doc_id")
    for model, limit in LIMITS.items():
        joined = joined.withColumn(model, (F.col("n_chars") > limit).cast("int"))
    return joined


def _by_model(spark, sf):
    return ops.predictions_by_model(labelled_documents(spark, sf), "quality", {m: m for m in LIMITS})


_RULES = " UNION ALL ".join(
    f"SELECT '{m}' AS model, quality AS truth, CAST(n_chars > {n} AS INTEGER) AS prediction FROM documents JOIN labels USING (doc_id)"
    for m, n in LIMITS.items())


@query("""
  SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS prediction,
         round(CAST(list_max(embedding) AS DOUBLE), 6) AS confidence FROM embeddings
""")
def argmax_confidence(spark, sf):
    rows_ = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("probabilities"))
    return scoring.argmax_confidence(rows_).select("vec_id", "prediction", F.round("confidence", 6).alias("confidence"))


@query("""
  SELECT round(avg(CAST(CAST(n_chars > 500 AS INTEGER) = quality AS DOUBLE)), 6) AS accuracy FROM documents JOIN labels USING (doc_id)
""")
def accuracy(spark, sf):
    return ops.accuracy(labelled_documents(spark, sf), "quality", "model_1").select(F.round("accuracy", 6).alias("accuracy"))


@query(f"SELECT model, round(avg(CAST(truth = prediction AS DOUBLE)), 6) AS accuracy FROM ({_RULES}) GROUP BY model")
def evaluate_models(spark, sf):
    return ops.evaluate_models(_by_model(spark, sf)).select("model", F.round("accuracy", 6).alias("accuracy"))


@query(f"""
  SELECT max(CASE WHEN model = 'model_1' THEN a END) AS model_1, max(CASE WHEN model = 'model_2' THEN a END) AS model_2,
         max(CASE WHEN model = 'model_3' THEN a END) AS model_3
  FROM (SELECT model, round(avg(CAST(truth = prediction AS DOUBLE)), 6) AS a FROM ({_RULES}) GROUP BY model)
""")
def eval_report(spark, sf):
    report = ops.eval_report(ops.evaluate_models(_by_model(spark, sf)))
    return report.select(*[F.round(read_report_path("report", f"metrics.accuracy.{m}"), 6).alias(m) for m in LIMITS])


@query(f"""
  SELECT source, round(a, 6) AS metric, CAST(0.6 AS DOUBLE) AS threshold, a >= 0.6 AS passed,
         CASE WHEN a >= 0.6 THEN NULL ELSE 'Model''s accuracy is less than accuracy threshold 0.6' END AS message
  FROM (SELECT source, avg(CAST(CAST(n_chars > 500 AS INTEGER) = quality AS DOUBLE)) AS a
        FROM documents JOIN labels USING (doc_id) GROUP BY source)
""")
def quality_gate(spark, sf):
    docs = labelled_documents(spark, sf)
    long = ops.predictions_by_model(docs, "quality", {"model_1": "model_1"}, ["source"])
    reports = ops.eval_report(ops.evaluate_models(long, by="source"), by="source")
    return rows.quality_gate(reports).select("source", F.round("metric", 6).alias("metric"), "threshold", "passed", "message")


@query("""
  SELECT quality AS truth, CAST(n_chars > 500 AS INTEGER) AS prediction, round(n_chars / (n_chars + 500.0), 6) AS confidence
  FROM documents JOIN labels USING (doc_id)
""")
def batch_score_with_source(spark, sf):
    scored = labelled_documents(spark, sf).withColumn("confidence", F.round(F.col("n_chars") / (F.col("n_chars") + 500.0), 6))
    return ops.batch_score_with_source(scored, "quality", "model_1")


def vector_predictions(spark, sf):
    code = argmax(F.col("embedding"))
    return table(spark, sf, "embeddings").select(
        "vec_id", F.col("label").cast("string").alias("truth"), F.pmod(code, F.lit(10)).cast("string").alias("prediction"))


VECTORS = """(SELECT vec_id, CAST(label AS VARCHAR) AS truth,
                     CAST((list_position(embedding, list_max(embedding)) - 1) % 10 AS VARCHAR) AS prediction FROM embeddings)"""


def event_predictions(spark, sf):
    """Truth is the event type; the guess is read off the number in props."""
    k = F.get_json_object("props", "$.k").cast("int")
    guess = F.when(k < 20, "click").when(k < 40, "error").when(k < 60, "purchase").when(k < 80, "signup").otherwise("view")
    return table(spark, sf, "events").select("event_id", "ts", F.col("event_type").alias("truth"), guess.alias("prediction"))


EVENT_GUESSES = """(SELECT event_id, ts, event_type AS truth,
    CASE WHEN k < 20 THEN 'click' WHEN k < 40 THEN 'error' WHEN k < 60 THEN 'purchase' WHEN k < 80 THEN 'signup' ELSE 'view' END AS prediction
    FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events))"""


def class_sql(source: str, by: str = "") -> str:
    """Per-class quality of a truth/prediction relation."""
    keys = f"{by}, " if by else ""
    return f"""
      SELECT {keys}label, support, predicted, hits, precision, recall,
             coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1
      FROM (SELECT {keys}label, support, predicted, hits, coalesce(hits / nullif(predicted, 0), 0) AS precision,
                   coalesce(hits / nullif(support, 0), 0) AS recall
            FROM (SELECT {keys}label, CAST(sum(s) AS BIGINT) AS support, CAST(sum(p) AS BIGINT) AS predicted, CAST(sum(h) AS BIGINT) AS hits
                  FROM (SELECT {keys}truth AS label, 1 AS s, 0 AS p, CAST(truth = prediction AS INTEGER) AS h FROM {source}
                        UNION ALL SELECT {keys}prediction, 0, 1, 0 FROM {source}) GROUP BY {keys}label))"""


def metric_sql(source: str, by: str = "") -> str:
    """Overall metrics as ``metric, value`` rows."""
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""
      SELECT {keys}unnest(['accuracy', 'weighted_precision', 'weighted_recall', 'weighted_f1']) AS metric, unnest(v) AS value FROM (
        SELECT {keys}[sum(hits) / sum(support), sum(support * precision) / sum(support), sum(support * recall) / sum(support),
                      sum(support * f1) / sum(support)] AS v FROM ({class_sql(source, by)}) {group})"""


@query(f"SELECT truth, prediction, count(*) AS n FROM {VECTORS} GROUP BY truth, prediction")
def confusion_matrix(spark, sf):
    return ops.confusion_matrix(vector_predictions(spark, sf))


@query(f"""SELECT label, support, predicted, hits, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1
           FROM ({class_sql(EVENT_GUESSES)})""")
def class_metrics(spark, sf):
    out = ops.class_metrics(ops.confusion_matrix(event_predictions(spark, sf)))
    return out.select("label", "support", "predicted", "hits", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query(f"SELECT metric, round(value, 6) AS value FROM ({metric_sql(EVENT_GUESSES)})")
def multiclass_metrics(spark, sf):
    matrix = ops.confusion_matrix(event_predictions(spark, sf))
    return ops.multiclass_metrics(matrix).select("metric", F.round("value", 6).alias("value"))


# The baseline's guesses are right four times in five, so the current ones fall below it in every metric.
_FLOOR_SIDE = f"(SELECT vec_id, truth, CASE WHEN vec_id % 5 <> 0 THEN truth ELSE prediction END AS prediction FROM {VECTORS})"


@query(f"""
  SELECT c.metric, round(c.value, 6) AS value, round(b.value, 6) AS floor
  FROM ({metric_sql(VECTORS)}) c JOIN ({metric_sql(_FLOOR_SIDE)}) b ON c.metric = b.metric WHERE c.value < b.value
""")
def model_quality_check(spark, sf):
    now = vector_predictions(spark, sf)
    before = now.withColumn("prediction", F.when(F.col("vec_id") % 5 != 0, F.col("truth")).otherwise(F.col("prediction")))
    both = now.withColumn("current", F.lit(True)).unionByName(before.withColumn("current", F.lit(False)))
    metrics = ops.multiclass_metrics(ops.confusion_matrix(both, by="current"), "current")
    floors = ops.suggest_model_constraints(metrics.filter("not current"))
    found = ops.check_model_quality(metrics.filter("current"), floors)
    return found.select("metric", F.round("value", 6).alias("value"), F.round("floor", 6).alias("floor"))


@query(f"SELECT metric, round(value, 6) AS floor FROM ({metric_sql(VECTORS)})")
def suggest_model_constraints(spark, sf):
    metrics = ops.multiclass_metrics(ops.confusion_matrix(vector_predictions(spark, sf)))
    return ops.suggest_model_constraints(metrics).select("metric", F.round("floor", 6).alias("floor"))
