"""What the readers and writers of files give back, on tables written below ``spark.checkpoint.dir``."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from bindings.catalog import query, scratch, split_sql, table
from bindings.features import NUMBERS, SPLIT_LINES, split_lines
from rowsentry.fixed_values import NULL_MARKERS
from rowsentry.operators import features, split
from rowsentry.sources import captures, fitted as fits, reports, tables
from rowsentry.streaming import events as event_streams

_ORDER_DDL = "o_orderkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderpriority STRING"
#: Orders whose price and status are left out, under every spelling of a missing value in turn.
_NO_PRICE, _NO_STATUS = "o_orderkey % 5 = 2", "o_orderkey % 7 = 3"


def _spelled(spark, sf):
    """The orders as text, with spellings of missing values and blanks around them."""
    marks = F.array(*[F.lit(m) for m in NULL_MARKERS])
    mark = F.element_at(marks, (F.col("o_orderkey") % len(NULL_MARKERS) + 1).cast("int"))
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.when(F.expr(_NO_STATUS), F.concat(mark, F.lit(" "))).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(F.expr(_NO_PRICE), mark).otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"), "o_orderpriority")


_READ_SQL = f"""
  SELECT o_orderkey, CASE WHEN NOT ({_NO_STATUS}) THEN o_orderstatus END AS o_orderstatus,
         CASE WHEN NOT ({_NO_PRICE}) THEN o_totalprice END AS o_totalprice, o_orderpriority FROM orders
"""


@query(_READ_SQL)
def read_labelled_csv(spark, sf):
    """Several files with a header, one folder, one table."""
    path = scratch(spark)
    _spelled(spark, sf).write.option("header", True).csv(path)
    return tables.read_labelled_csv(spark, path, _ORDER_DDL)


@query(_READ_SQL)
def read_headerless_csv(spark, sf):
    path = scratch(spark)
    _spelled(spark, sf).write.csv(path)
    return tables.read_headerless_csv(spark, path, _ORDER_DDL)


def _folded_orders(spark, sf):
    return split.stratified_folds(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", "o_orderkey")


_FOLDED = "SELECT o_orderkey, o_orderstatus, fold FROM orders, (SELECT unnest([1, 2, 3]) AS fold) f"
_FOLD_SQL = split_sql(_FOLDED, "o_orderstatus", "o_orderkey", "concat_ws('|', '41', r.fold_)", fold="fold",
                      keep="o_orderkey, o_orderstatus, fold", other="validation")


@query(f"""
  SELECT o_orderkey, o_orderstatus, fold, split FROM ({_FOLD_SQL}) WHERE split = 'validation'
  UNION ALL SELECT o_orderkey, o_orderstatus, fold, split FROM ({_FOLD_SQL}) WHERE split = 'train' AND fold = 2
""")
def write_splits(spark, sf):
    """The folds as a table by split and fold, of which all validation parts and one training part are read."""
    path = scratch(spark)
    tables.write_splits(_folded_orders(spark, sf), path)
    held = tables.read_split(spark, path, "validation")
    return held.unionByName(tables.read_split(spark, path, "train", 2)).select("o_orderkey", "o_orderstatus", "fold", "split")


@query(_FOLD_SQL)
def append_folds(spark, sf):
    """The folds, written one by one and put under each other; each has its columns in another order."""
    path = scratch(spark)
    tables.write_splits(_folded_orders(spark, sf), path)
    parts = [tables.read_split(spark, path, s, f).select(*columns)
             for f, columns in ((1, ("o_orderkey", "o_orderstatus", "fold", "split")), (2, ("split", "fold", "o_orderstatus", "o_orderkey")),
                                (3, ("fold", "o_orderkey", "split", "o_orderstatus")))
             for s in ("train", "validation")]
    return split.append_folds(*parts)


@query("""
  SELECT CAST(event_id AS VARCHAR) AS inference_id, event_type AS truth, CAST(date_trunc('week', ts) AS TIMESTAMP) + INTERVAL 7 DAY + INTERVAL 754 SECOND AS gt_ts
  FROM events
""")
def read_ground_truth(spark, sf):
    """The labels of a week are dropped together after it, at a time that only the path tells; one drop is sent twice."""
    path = scratch(spark)
    labels = table(spark, sf, "events").select(F.col("event_id").alias("inference_id"), F.col("event_type").alias("truth"),
                                               F.date_trunc("week", "ts").cast("string").alias("week"))
    weeks = sorted(r["week"] for r in labels.select("week").distinct().collect())  # a row a week
    for week in [*weeks, weeks[-1]]:
        at = datetime.fromisoformat(week) + timedelta(days=7, seconds=754)
        captures.write_ground_truth(labels.filter(F.col("week") == week), path, at)
    return captures.read_ground_truth(spark, path)


_TYPES = "CASE WHEN event_id % 4 = 0 THEN 'application/json' WHEN event_id % 4 = 1 THEN 'image/png' ELSE 'text/csv' END"


@query(f"""
  SELECT CAST(event_id AS VARCHAR) AS inference_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS window_start, {_TYPES} AS content_type FROM events
  WHERE {_TYPES} <> 'image/png' AND CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 60
""")
def capture_inferences(spark, sf):
    """Sampled requests of the two known types, appended in two runs and read back."""
    path = scratch(spark)
    sent = table(spark, sf, "events").select(F.col("event_id").cast("string").alias("inference_id"), F.col("ts").cast("timestamp").alias("ts"),
                                             F.expr(_TYPES).alias("content_type"), F.col("props").alias("input"))
    for early in (True, False):
        captures.capture_inferences(sent.filter((F.dayofmonth("ts") < 15) == early), path, percent=60)
    return captures.read_captures(spark, path).select("inference_id", F.date_trunc("hour", "ts").alias("window_start"), "content_type")


@query(f"""
  WITH s AS ({SPLIT_LINES}),
       p AS (SELECT {", ".join(f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in NUMBERS)} FROM s WHERE split = 'train')
  SELECT line_key, {", ".join(f"round((s.{c} - p.{c}_m) / p.{c}_s, 4) AS {c}" for c in NUMBERS)},
         CAST(l_linestatus = 'F' AS DOUBLE) AS "l_linestatus_F", CAST(l_linestatus = 'O' AS DOUBLE) AS "l_linestatus_O"
  FROM s, p WHERE split = 'test'
""")
def load_fitted(spark, sf):
    """Values fitted on the train part, saved, loaded and applied to the test part."""
    path, stored = scratch(spark), scratch(spark)
    tables.write_splits(split_lines(spark, sf).withColumn("fold", F.lit(0)), stored)
    train, test = (tables.read_split(spark, stored, s).drop("split", "fold") for s in ("train", "test"))
    fits.save_fitted(spark, features.fit_columns(train, "l_returnflag", numeric=NUMBERS, categorical=["l_linestatus"]), path)
    done = features.transform_with(test, fits.load_fitted(spark, path), keep=["line_key"])
    return done.select("line_key", *[F.round(c, 4).alias(c) for c in NUMBERS], "l_linestatus_F", "l_linestatus_O")


@query("""
  SELECT 'run-' || user_id % 3 AS run_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS window_start, event_type AS "column", 'too_many' AS "check",
         CAST(count(*) AS VARCHAR) || ' rows' AS detail, CAST(count(*) AS DOUBLE) AS value, CAST(1 AS DOUBLE) AS floor
  FROM events GROUP BY ALL HAVING count(*) > 1
""")
def read_violations(spark, sf):
    """Violations written as one document per run and hour, and read back as rows."""
    path = scratch(spark)
    found = table(spark, sf, "events").groupBy(
        F.concat(F.lit("run-"), F.col("user_id") % 3).alias("run_id"), F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("window_start"),
        F.col("event_type").alias("column")).agg(F.count("*").alias("n")).filter("n > 1")
    rows = found.select("run_id", "window_start", "column", F.lit("too_many").alias("check"), F.concat(F.col("n"), F.lit(" rows")).alias("detail"),
                        F.col("n").cast("double").alias("value"), F.lit(1.0).alias("floor"))
    reports.write_violations(rows, path)
    return reports.read_violations(spark, path)


@query("""
  SELECT event_id, event_type FROM events
  WHERE event_type IN ('purchase', 'signup') AND regexp_extract(props, '([0-9]+)', 1) IN ('1', '2', '3', '5', '8', '13')
""")
def stream_events_filter(spark, sf):
    """A running query over the events hands on those of a pattern; each micro-batch has its folder and may be repeated."""
    out = scratch(spark)
    arriving = spark.readStream.schema(table(spark, sf, "events").schema).parquet(f"{sf}/[e]vents.parquet")

    def act(batch, batch_id: int) -> None:
        batch.select("event_id", "event_type").write.mode("overwrite").parquet(f"{out}/rows/batch={batch_id}")

    running = event_streams.start_events(arriving, {"event_type": ["purchase", "signup"], "k": [1, 2, 3, 5, 8, 13]}, act, f"{out}/progress", "props")
    running.awaitTermination()
    return spark.read.schema("event_id BIGINT, event_type STRING, batch INT").parquet(f"{out}/rows").drop("batch")
