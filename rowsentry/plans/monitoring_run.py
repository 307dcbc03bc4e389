"""One batch run of the monitors over captured traffic and late labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowsentry.fixed_values import FEATURE_DDL, VIOLATED_STATUS
from rowsentry.operators import merge, quality
from rowsentry.sources import reports
from rowsentry.sources.requests import parse_requests, split_errors
from rowsentry.streaming import hourly


def captured_features(captures: DataFrame, schema: str = FEATURE_DDL) -> tuple[DataFrame, DataFrame]:
    """Captured inputs as typed feature rows with ``ts``, and the unreadable ones."""
    sent = captures.select("inference_id", "ts", "content_type", F.col("input").alias("body"))
    return split_errors(parse_requests(sent, schema))


UNREADABLE = "unreadable"


def unreadable_violations(bad: DataFrame) -> DataFrame:
    """One violation per hour in which captured inputs could not be read, with their number."""
    hours = bad.withColumn("ts", F.col("ts").cast("timestamp")).groupBy(F.window("ts", "1 hour")).agg(F.count("*").alias("n"))
    return hours.select(F.col("window.start").alias("window_start"), F.lit("*").alias("column"), F.lit(UNREADABLE).alias("check"),
                        F.concat(F.col("n").cast("string"), F.lit(" inputs could not be read")).alias("detail"))


def data_quality_run(captures: DataFrame, constraints: DataFrame, schema: str = FEATURE_DDL) -> tuple[DataFrame, DataFrame]:
    """Hourly profile of captured inputs and its violations of the baseline; unreadable inputs are a violation, too."""
    good, bad = captured_features(captures, schema)
    columns = [c for c in good.columns if c not in ("inference_id", "ts", "content_type", "row_no", "n_rows")]
    profile = hourly.hourly_profile(good, columns, domains=quality.constraint_domains(constraints))
    found = hourly.hourly_violations(profile, constraints)
    return profile, found.unionByName(unreadable_violations(bad))


def model_quality_run(captures: DataFrame, ground_truth: DataFrame, floors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Hourly metrics of captured predictions against late labels, and those below the floor.

    Of several labels of one id the earliest counts, as it does when the same data come as streams.
    """
    sent = captures.select("inference_id", "ts", F.get_json_object("output", "$.0").alias("prediction"))
    merged = merge.merge_ground_truth(sent, ground_truth.select("inference_id", "truth", "gt_ts"), order="gt_ts", earliest=True)
    metrics = hourly.hourly_model_metrics(hourly.hourly_confusion(merged))
    return metrics, hourly.hourly_model_violations(metrics, floors)


def record_run(spark: SparkSession, folder: str, run_id: str, endpoint: str, kind: str, violations: DataFrame) -> int:
    """Write all violations of a run, of either monitor type, and its line in the run log.

    Returns their number, counted in what was written, so that the monitor's plan runs once. A run that is recorded again
    replaces its violations and its line.
    """
    path = f"{folder}/violations/{run_id}"
    reports.write_violations(violations.withColumn("run_id", F.lit(run_id)), path)
    written = reports.read_violations(spark, path).count()
    status = VIOLATED_STATUS if written else "Completed"
    line = spark.createDataFrame([(endpoint, f"{endpoint}-{kind}", kind, status, run_id, written)],
                                 "endpoint STRING, name STRING, type STRING, last_status STRING, run_id STRING, n_violations LONG")
    reports.replace_parts(line.withColumn("last_ts", F.current_timestamp()), f"{folder}/runs", ["run_id"])
    return written
