"""Hourly data and model quality, in one form for tables and streams."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from rowsentry.operators.evaluate import (
    check_model_quality, multiclass_metrics,
)
from rowsentry.operators.quality import check_constraints, constraint_domains, profile_columns
from rowsentry.sources import reports
from rowsentry.streaming.merging import stream_merge_earliest

HOUR = "1 hour"
LATENESS = "1 hour"


def timed(df: DataFrame, ts: str = "ts", lateness: str = LATENESS) -> DataFrame:
    """A stream with its event time as TIMESTAMP under a watermark; a table as it is."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness) if df.isStreaming else df


def hourly_profile(df: DataFrame, columns: Sequence[str], ts: str = "ts", lateness: str = LATENESS,
                   domains: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """One profile row per hour (``window_start``) and column: a single windowed aggregation."""
    wide = profile_columns(timed(df, ts, lateness), [F.window(ts, HOUR)], columns, domains)
    return wide.select(F.col("window.start").alias("window_start"), *[c for c in wide.columns if c != "window"])


def hourly_violations(profile: DataFrame, constraints: DataFrame) -> DataFrame:
    """Constraint violations of each hour of a (batch) profile."""
    return check_constraints(profile, constraints, ["window_start"])


def hourly_confusion(merged: DataFrame, ts: str = "ts", truth: str = "truth", prediction: str = "prediction",
                     lateness: str = LATENESS) -> DataFrame:
    """Confusion counts per hour. ``merged`` may carry a watermark already (see stream merging)."""
    rows = merged if merged.isStreaming else timed(merged, ts, lateness)
    # Text columns first: the window must stay the bare event time for the watermark to hold.
    rows = rows.select(ts, F.col(truth).cast("string").alias("truth"), F.col(prediction).cast("string").alias("prediction"))
    counts = rows.groupBy(F.window(ts, HOUR), "truth", "prediction").agg(F.count("*").alias("n"))
    return counts.select(F.col("window.start").alias("window_start"), "truth", "prediction", "n")


def hourly_model_metrics(confusion: DataFrame) -> DataFrame:
    """Accuracy and weighted metrics per hour from the hourly confusion counts."""
    return multiclass_metrics(confusion, ["window_start"])


def hourly_model_violations(metrics: DataFrame, floors: DataFrame) -> DataFrame:
    return check_model_quality(metrics, floors, ["window_start"])


def start_data_quality(stream: DataFrame, columns: Sequence[str], constraints: DataFrame, out: str, checkpoint: str,
                       ts: str = "ts", lateness: str = LATENESS):
    """Profile and check each closed hour of a stream; returns the started query.

    Writes ``<out>/profile`` and ``<out>/violations``, one folder per micro-batch and overwritten
    when a batch is retried, so a restart repeats nothing.
    """
    profile = hourly_profile(stream, columns, ts, lateness, constraint_domains(constraints))

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            kept.write.mode("overwrite").parquet(f"{out}/profile/batch={batch_id}")
            hourly_violations(kept, constraints).write.mode("overwrite").parquet(f"{out}/violations/batch={batch_id}")
        finally:
            kept.unpersist()

    return (profile.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
            .foreachBatch(write).trigger(availableNow=True).start())


def start_model_quality(merged: DataFrame, floors: DataFrame, out: str, checkpoint: str, ts: str = "ts", source: str = "model_quality",
                        run_id: str = "stream"):
    """Metrics and violations of each closed hour of merged predictions; returns the query.

    Metrics go to the long metrics table ``<out>/metrics`` under ``source`` and ``run_id``; an hour that is written again replaces itself.
    """
    counts = hourly_confusion(merged, ts)

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            metrics = hourly_model_metrics(kept)
            reports.write_metrics(metrics, f"{out}/metrics", source, "window_start", run_id)
            hourly_model_violations(metrics, floors).write.mode("overwrite").parquet(f"{out}/violations/batch={batch_id}")
        finally:
            kept.unpersist()

    return (counts.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
            .foreachBatch(write).trigger(availableNow=True).start())


def follow_model_quality(captured: DataFrame, ground_truth: DataFrame, floors: DataFrame, out: str, checkpoint: str,
                         delay: str = "1 hour", lateness: str = LATENESS, source: str = "model_quality", run_id: str = "stream"):
    """One running query from two streams, predictions and labels, to hourly metrics and violations.

    The interval join, the choice of the earliest label and the hourly counts are stateful steps of one query; an hour is
    written when no label of it can arrive any more. Returns the started query.
    """
    merged = stream_merge_earliest(captured, ground_truth, delay=delay, lateness=lateness)
    return start_model_quality(merged, floors, out, checkpoint, source=source, run_id=run_id)
