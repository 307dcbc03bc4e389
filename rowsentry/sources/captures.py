"""Ground-truth drops and captured inferences."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowsentry.fixed_values import CSV_TYPE, GROUND_TRUTH_DDL, JSON_TYPE
from rowsentry.operators.split import sample_percent

_PATH_TIME = r"([0-9]{4})/([0-9]{2})/([0-9]{2})/([0-9]{2})/([0-9]{2})([0-9]{2})"


def ground_truth_event(key: Column, label: Column) -> Column:
    """One label as the nested event text that :func:`read_ground_truth` reads."""
    return F.to_json(F.struct(
        F.struct(label.cast("string").alias("data"), F.lit("CSV").alias("encoding")).alias("groundTruthData"),
        F.struct(key.cast("string").alias("eventId")).alias("eventMetadata"),
        F.lit("0").alias("eventVersion"),
    ))


def write_ground_truth(labels: DataFrame, path: str, at: datetime, key: str = "inference_id", truth: str = "truth") -> None:
    """One drop of labels, in the folder that names its time (UTC) to the second; a repeated drop replaces itself."""
    events = labels.select(ground_truth_event(F.col(key), F.col(truth)).alias("value"))
    events.write.mode("overwrite").text(f"{path.rstrip('/')}/{at:%Y/%m/%d/%H/%M%S}")


def _labels(raw: DataFrame) -> DataFrame:
    path = F.col("_metadata.file_path")
    parts = [F.regexp_extract(path, _PATH_TIME, i) for i in range(1, 7)]
    named = F.concat(parts[0], F.lit("-"), parts[1], F.lit("-"), parts[2], F.lit(" "),
                     parts[3], F.lit(":"), parts[4], F.lit(":"), parts[5])
    dropped = F.when(path.rlike(_PATH_TIME), F.to_timestamp(named, "yyyy-MM-dd HH:mm:ss"))
    return raw.select(
        F.col("eventMetadata.eventId").alias("inference_id"),
        F.col("groundTruthData.data").alias("truth"),
        F.coalesce(dropped, F.col("_metadata.file_modification_time")).alias("gt_ts"),
    )


def read_ground_truth(spark: SparkSession, path: str) -> DataFrame:
    """``inference_id, truth, gt_ts`` from JSONL files; the time comes from the file's path."""
    return _labels(spark.read.schema(GROUND_TRUTH_DDL).option("recursiveFileLookup", True).json(path))


def stream_ground_truth(spark: SparkSession, path: str) -> DataFrame:
    """The same as a stream of newly dropped files."""
    return _labels(spark.readStream.schema(GROUND_TRUTH_DDL).option("recursiveFileLookup", True).json(path))


def captured(df: DataFrame, percent: int = 100, key: str = "inference_id", content_type: str = "content_type") -> DataFrame:
    """The requests to record: CSV and JSON ones, sampled by key."""
    return sample_percent(df.filter(F.col(content_type).isin(CSV_TYPE, JSON_TYPE)), percent, key)


def _by_hour(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn("date", F.to_date(ts)).withColumn("hour", F.hour(ts))


def capture_inferences(df: DataFrame, path: str, ts: str = "ts", percent: int = 100) -> None:
    """Append captured inputs and outputs, laid out by date and hour.

    Rows of an hour are brought together, so that tasks do not each write a file an hour; hours that are too full stay split.
    """
    _by_hour(captured(df, percent), ts).hint("rebalance", "date", "hour").write.mode("append").partitionBy("date", "hour").parquet(path)


def stream_captures(df: DataFrame, path: str, checkpoint: str, ts: str = "ts", percent: int = 100):
    """The streaming form of :func:`capture_inferences`; returns the started query."""
    return (
        _by_hour(captured(df, percent), ts).writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .partitionBy("date", "hour").trigger(availableNow=True).start()
    )


def read_captures(spark: SparkSession, path: str, date: str | None = None, hour: int | None = None) -> DataFrame:
    """Captured rows, of one date and hour when given (other folders are not read)."""
    out = spark.read.parquet(path)
    if date is not None:
        out = out.filter(F.col("date") == F.lit(date).cast("date"))
    return out if hour is None else out.filter(F.col("hour") == hour)
