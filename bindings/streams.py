"""Running queries over the driver's events, and tables written by repeated and overlapping runs."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from bindings.catalog import query, scratch, table
from bindings.evaluation import EVENT_GUESSES, event_predictions, metric_sql
from bindings.merging import K_SQL, number
from rowsentry.operators import registry
from rowsentry.sources import commits, reports
from rowsentry.streaming import hourly

_CLOSED = "(SELECT max(ts) - INTERVAL 4 HOUR FROM events)"
#: A label of each event k minutes after it, and a correction five minutes later for every other one: the first counts.
_IN_TIME = f"""(SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS window_start, truth, prediction
  FROM {EVENT_GUESSES} JOIN (SELECT event_id, {K_SQL} AS k FROM events) USING (event_id)
  WHERE k <= 60 AND date_trunc('hour', ts) < {_CLOSED})"""


def _streams(spark, sf):
    """The events as two streams, predictions and labels; corrections lie before the labels they follow.

    The path is a pattern, as a stream of files takes a folder or a pattern.
    """
    kind = table(spark, sf, "events").schema

    def arriving():
        return spark.readStream.schema(kind).parquet(f"{sf}/[e]vents.parquet").withColumn("ts", F.col("ts").cast("timestamp"))

    k = number()
    guess = F.when(k < 20, "click").when(k < 40, "error").when(k < 60, "purchase").when(k < 80, "signup").otherwise("view")
    sent = arriving().select(F.col("event_id").alias("inference_id"), "ts", guess.alias("prediction"))
    first = F.struct((F.col("ts") + F.make_dt_interval(mins=k)).alias("gt_ts"), F.col("event_type").alias("truth"))
    later = F.struct((F.col("ts") + F.make_dt_interval(mins=k + 5)).alias("gt_ts"), F.lit("corrected").alias("truth"))
    both = F.when(F.col("event_id") % 2 == 0, F.array(later, first)).otherwise(F.array(first))
    told = arriving().select(F.col("event_id").alias("inference_id"), F.explode(both).alias("l")).select("inference_id", "l.gt_ts", "l.truth")
    return sent, told


@query(f"SELECT window_start, metric, round(value, 6) AS value FROM ({metric_sql(_IN_TIME, 'window_start')})")
def followed_model_quality(spark, sf):
    """Hourly metrics by one running query over predictions and labels, of the hours that are surely closed at its end."""
    out = scratch(spark)
    floors = spark.createDataFrame([("accuracy", 0.0)], "metric STRING, floor DOUBLE")
    running = hourly.follow_model_quality(*_streams(spark, sf), floors, out, f"{out}/progress")
    running.awaitTermination()
    last = table(spark, sf, "events").agg((F.max("ts") - F.expr("INTERVAL 4 HOURS")).cast("timestamp").alias("closed"))
    rows = reports.read_metrics(spark, f"{out}/metrics").join(F.broadcast(last), F.col("window_start") < F.col("closed"))
    return rows.select("window_start", "metric", F.round("value", 6).alias("value"))


_DAYS = "(SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, truth, prediction FROM {})".format(EVENT_GUESSES)


@query(f"""
  SELECT 'model_quality' AS source, 'daily' AS run_id, window_start, metric, round(value, 6) AS value FROM ({metric_sql(_DAYS, 'window_start')})
  UNION ALL SELECT 'model_quality', 'whole', NULL, metric, round(value, 6) FROM ({metric_sql(EVENT_GUESSES)})
""")
def replayed_metrics(spark, sf):
    """Two runs of one monitor, each written twice, in the long metrics table."""
    path = scratch(spark)
    rows = event_predictions(spark, sf).withColumn("ts", F.date_trunc("day", F.col("ts").cast("timestamp")))
    for _ in range(2):
        daily = hourly.hourly_model_metrics(hourly.hourly_confusion(rows))
        reports.write_metrics(daily, path, "model_quality", "window_start", "daily")
        whole = rows.groupBy("truth", "prediction").agg(F.count("*").alias("n"))
        reports.write_metrics(hourly.multiclass_metrics(whole), path, "model_quality", run_id="whole")
    return reports.read_metrics(spark, path).select("source", "run_id", "window_start", "metric", F.round("value", 6).alias("value"))


@query("""
  SELECT user_id AS model_group, count(*) AS entries, CAST(1 AS BIGINT) AS first, count(*) AS last, count(*) AS versions FROM events GROUP BY user_id
""")
def overlapping_versions(spark, sf):
    """Three writers register the events of a user at once: numbers without a gap, none of them twice."""
    path = scratch(spark)
    entries = table(spark, sf, "events").select(F.col("user_id").alias("model_group"), "event_id", "ts")

    def write(k: int) -> int:
        mine = entries.filter(F.col("event_id") % 3 == k)
        return commits.commit(spark, path, lambda known: registry.register_version(known, mine, "model_group", ["ts", "event_id"], F.to_date("ts")))

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(write, range(3)))
    return commits.read_committed(spark, path).groupBy("model_group").agg(
        F.count("*").alias("entries"), F.min("version").alias("first"), F.max("version").alias("last"), F.count_distinct("version").alias("versions"))
