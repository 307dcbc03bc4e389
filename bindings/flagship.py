"""The whole story in one query: split, fit on train, score test, confusion matrix, metrics, gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from bindings.catalog import LINE_KEY_SQL, query, split_sql
from bindings.splits import lines
from rowsentry.operators import evaluate, features, rows, split

_KEEP = "line_key, l_returnflag, l_quantity, l_extendedprice"
_SPLIT = split_sql(f"SELECT *, {LINE_KEY_SQL} AS line_key FROM lineitem", "l_returnflag", "line_key", "'42'", keep=_KEEP)


def _z(c: str) -> str:
    return f"(s.{c} - p.{c}_m) / p.{c}_s"


@query(f"""
  WITH s AS ({_SPLIT}),
       p AS (SELECT avg(l_quantity) AS l_quantity_m, stddev_pop(l_quantity) AS l_quantity_s,
                    avg(l_extendedprice) AS l_extendedprice_m, stddev_pop(l_extendedprice) AS l_extendedprice_s FROM s WHERE split = 'train'),
       g AS (SELECT l_returnflag AS truth, CASE WHEN {_z("l_quantity")} > 0.5 THEN 'A' WHEN {_z("l_extendedprice")} > 0 THEN 'N' ELSE 'R' END AS prediction
             FROM s, p WHERE split = 'test'),
       a AS (SELECT avg(CAST(truth = prediction AS DOUBLE)) AS v, count(*) AS n FROM g)
  SELECT n AS test_rows, round(v, 6) AS metric, CAST(0.3 AS DOUBLE) AS threshold, v >= 0.3 AS passed,
         CASE WHEN v >= 0.3 THEN NULL ELSE 'Model''s accuracy is less than accuracy threshold 0.3' END AS message FROM a
""")
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = ["l_quantity", "l_extendedprice"]
    parts = split.stratified_split(lines(spark, sf_dir).select(*_KEEP.split(", ")), "l_returnflag", "line_key")
    params = features.fit_scaler(parts.filter("split = 'train'"), numbers)
    test = features.apply_scaler(parts.filter("split = 'test'"), params, numbers)
    guess = F.when(F.col("l_quantity") > 0.5, "A").when(F.col("l_extendedprice") > 0, "N").otherwise("R")
    matrix = evaluate.confusion_matrix(test.withColumn("prediction", guess), "l_returnflag")
    metrics = evaluate.multiclass_metrics(matrix).filter("metric = 'accuracy'")
    size = matrix.agg(F.sum("n")).scalar()
    accuracy = metrics.select(F.lit("model_1").alias("model"), F.col("value").alias("accuracy"))
    gated = rows.quality_gate(evaluate.eval_report(accuracy), threshold=0.3)
    return gated.select(size.alias("test_rows"), F.round("metric", 6).alias("metric"), "threshold", "passed", "message")
