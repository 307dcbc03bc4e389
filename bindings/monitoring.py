"""The hourly monitors, in their table form, on the driver's event stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.catalog import query, table
from bindings.evaluation import EVENT_GUESSES, event_predictions, metric_sql
from rowsentry.operators import evaluate, quality
from rowsentry.plans import monitoring_run
from rowsentry.sources import reports
from rowsentry.streaming import hourly

COLUMNS = ["value", "event_type"]
_BASE = "TIMESTAMP '2024-01-08'"


def _base(df):
    return df.filter(F.col("ts") < F.lit("2024-01-08").cast("timestamp_ntz"))


@query("""
  SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS window_start, 'value' AS "column", 'Fractional' AS kind, count(*) AS n, count(*) - count(value) AS n_null,
         round(count(value) / count(*), 6) AS completeness, round(avg(value), 4) AS mean, round(sum(value), 4) AS sum, round(stddev_pop(value), 4) AS std,
         min(value) AS min, max(value) AS max FROM events GROUP BY 1
  UNION ALL
  SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP), 'event_type', 'String', count(*), count(*) - count(event_type), round(count(event_type) / count(*), 6),
         NULL, NULL, NULL, NULL, NULL FROM events GROUP BY 1
""")
def hourly_data_quality(spark, sf):
    profile = hourly.hourly_profile(table(spark, sf, "events").select("ts", *COLUMNS), COLUMNS)
    digits = {"completeness": 6, "mean": 4, "sum": 4, "std": 4}
    kept = [c for c in profile.columns if c not in ("n_distinct", "n_unseen")]
    return profile.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in kept])


@query("""
  WITH e AS (SELECT date_trunc('hour', ts) AS h, ts, CASE WHEN ts >= TIMESTAMP '2024-01-20' AND value < 1 THEN -value ELSE value END AS value,
                    CASE WHEN ts >= TIMESTAMP '2024-01-25' AND event_type = 'view' THEN 'scroll' ELSE event_type END AS event_type FROM events)
  SELECT CAST(h AS TIMESTAMP) AS window_start, 'value' AS "column", 'non_negative' AS "check", 'negative values' AS detail FROM e GROUP BY h HAVING min(value) < 0
  UNION ALL
  SELECT CAST(h AS TIMESTAMP), 'event_type', 'unseen_category', count(*) || ' rows outside the domain' FROM e WHERE event_type = 'scroll' GROUP BY h
""")
def hourly_violations(spark, sf):
    e = table(spark, sf, "events").select("ts", *COLUMNS)
    base = _base(e).select(*COLUMNS)
    constraints = quality.suggest_constraints(quality.profile_columns_exact(base), quality.value_histogram(base, ["event_type"]))

    def since(day: str):
        return F.col("ts") >= F.lit(day).cast("timestamp_ntz")

    changed = e.select(
        "ts", F.when(since("2024-01-20") & (F.col("value") < 1), -F.col("value")).otherwise(F.col("value")).alias("value"),
        F.when(since("2024-01-25") & (F.col("event_type") == "view"), "scroll").otherwise(F.col("event_type")).alias("event_type"))
    profile = hourly.hourly_profile(changed, COLUMNS, domains=quality.constraint_domains(constraints))
    return hourly.hourly_violations(profile, constraints)


_HOURS = f"(SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS window_start, truth, prediction FROM {EVENT_GUESSES})"


@query(f"SELECT window_start, truth, prediction, count(*) AS n FROM {_HOURS} GROUP BY ALL")
def hourly_confusion(spark, sf):
    return hourly.hourly_confusion(event_predictions(spark, sf))


@query(f"SELECT window_start, metric, round(value, 6) AS value FROM ({metric_sql(_HOURS, 'window_start')})")
def hourly_model_quality(spark, sf):
    metrics = hourly.hourly_model_metrics(hourly.hourly_confusion(event_predictions(spark, sf)))
    return metrics.select("window_start", "metric", F.round("value", 6).alias("value"))


@query(f"""
  SELECT window_start, c.metric, round(c.value, 6) AS value, round(b.value, 6) AS floor
  FROM ({metric_sql(_HOURS, 'window_start')}) c
  JOIN ({metric_sql(f"(SELECT * FROM {EVENT_GUESSES} WHERE ts < {_BASE})")}) b ON c.metric = b.metric
  WHERE c.value < b.value
""")
def hourly_model_violations(spark, sf):
    rows = event_predictions(spark, sf)
    floors = evaluate.suggest_model_constraints(evaluate.multiclass_metrics(evaluate.confusion_matrix(_base(rows))))
    metrics = hourly.hourly_model_metrics(hourly.hourly_confusion(rows))
    found = hourly.hourly_model_violations(metrics, floors)
    return found.select("window_start", "metric", F.round("value", 6).alias("value"), F.round("floor", 6).alias("floor"))


@query(f"""
  WITH c AS ({metric_sql(_HOURS, 'window_start')}), b AS ({metric_sql(f"(SELECT * FROM {EVENT_GUESSES} WHERE ts < {_BASE})")})
  SELECT 'run' AS run_id, window_start, c.metric AS "column", 'below_floor' AS "check", round(c.value, 6) AS value, round(b.value, 6) AS floor
  FROM c JOIN b ON c.metric = b.metric WHERE c.value < b.value
  UNION ALL
  SELECT 'run', CAST(date_trunc('hour', ts) AS TIMESTAMP), '*', 'unreadable', NULL, NULL FROM events WHERE event_type = 'error' GROUP BY ALL
""")
def monitor_run_log(spark, sf):
    """What a run of either monitor writes down: every hour's violations with their values."""
    rows = event_predictions(spark, sf)
    floors = evaluate.suggest_model_constraints(evaluate.multiclass_metrics(evaluate.confusion_matrix(_base(rows))))
    low = hourly.hourly_model_violations(hourly.hourly_model_metrics(hourly.hourly_confusion(rows)), floors)
    bad = monitoring_run.unreadable_violations(table(spark, sf, "events").filter("event_type = 'error'"))
    both = reports.violation_rows(low.withColumn("run_id", F.lit("run")), ("run_id",)).unionByName(
        reports.violation_rows(bad.withColumn("run_id", F.lit("run")), ("run_id",)))
    return both.select("run_id", "window_start", "column", "check", F.round("value", 6).alias("value"), F.round("floor", 6).alias("floor"))
