"""State-change events of model packages, as JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# --- fixed values: layout of a model-package event ----------------------------
PACKAGE_EVENT_DDL = (
    "`detail-type` STRING, source ARRAY<STRING>, account STRING, time STRING, region STRING, resources ARRAY<STRING>, "
    "detail STRUCT<ModelPackageGroupName: STRING, ModelPackageVersion: INT, ModelPackageArn: STRING, "
    "CreationTime: STRING, ModelPackageStatus: STRING, ModelApprovalStatus: STRING, LastModifiedTime: STRING, "
    "ModelMetrics: STRUCT<ModelQuality: STRUCT<Statistics: STRUCT<ContentType: STRING, S3Uri: STRING>>>>"
)


def read_package_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PACKAGE_EVENT_DDL).json(path)


def stream_package_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(PACKAGE_EVENT_DDL).json(path)


def flatten_package_events(events: DataFrame) -> DataFrame:
    """``model_group, version, artifact, status, ts``; events without a detail are left out."""
    return events.filter("detail IS NOT NULL").select(
        F.col("detail.ModelPackageGroupName").alias("model_group"),
        F.col("detail.ModelPackageVersion").alias("version"),
        F.col("detail.ModelPackageArn").alias("artifact"),
        F.col("detail.ModelApprovalStatus").alias("status"),
        F.to_timestamp("time").alias("ts"),
    )
