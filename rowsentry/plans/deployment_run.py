"""Deployments and monitors kept as tables, brought forward by approval events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowsentry.fixed_values import APPROVED_STATUS, MONITOR_TYPES
from rowsentry.operators import monitors, registry
from rowsentry.sources.events import flatten_package_events
from rowsentry.sources.tables import read_if_present
from rowsentry.streaming.events import start_events

DEPLOYMENT_DDL = "endpoint STRING, artifact STRING, config STRING, action STRING"
MONITORS_DDL = "endpoint STRING, type STRING"


def current_deployments(spark: SparkSession, folder: str, before: int | None = None) -> DataFrame:
    """The state the last batch (before ``before``) left; empty when there is none."""
    states = read_if_present(spark, f"{folder}/deployments", f"{DEPLOYMENT_DDL}, batch BIGINT")
    if states is None:
        return spark.createDataFrame([], DEPLOYMENT_DDL)
    if before is not None:
        states = states.filter(F.col("batch") < before)
    newest = states.agg(F.max("batch")).scalar()
    return states.filter(F.col("batch") == newest).drop("batch")


def deploy_approved(spark: SparkSession, events: DataFrame, folder: str, batch_id: int, prefix: str = "") -> None:
    """Write the deployments after one batch of package events.

    The endpoint of a model group is ``<prefix><group>``. A retried batch starts from the state
    before it and overwrites its own result.
    """
    approved = registry.latest_approved(flatten_package_events(events), "model_group", "artifact", ["ts", "artifact"])
    named = approved.select(F.concat(F.lit(prefix), F.col("model_group")).alias("endpoint"), "artifact", "ts")
    after = registry.deployment_upsert(current_deployments(spark, folder, batch_id), named)
    after.write.mode("overwrite").parquet(f"{folder}/deployments/batch={batch_id}")


def start_deployments(spark: SparkSession, events: DataFrame, folder: str, checkpoint: str, groups: Sequence[str],
                      prefix: str = ""):
    """Follow a stream of package events; only approvals of ``groups`` change anything."""
    pattern = {"detail": {"ModelPackageGroupName": list(groups), "ModelApprovalStatus": [APPROVED_STATUS]}}

    def act(batch: DataFrame, batch_id: int) -> None:
        deploy_approved(batch.sparkSession, batch, folder, batch_id, prefix)

    return start_events(events, pattern, act, checkpoint)


def create_missing_monitors(spark: SparkSession, deployments: DataFrame, folder: str,
                            types: Sequence[str] = MONITOR_TYPES) -> DataFrame:
    """Append the monitors that deployed endpoints lack, and return all monitors."""
    path = f"{folder}/monitors"
    existing = read_if_present(spark, path, MONITORS_DDL)
    if existing is None:
        existing = spark.createDataFrame([], MONITORS_DDL)
    monitors.missing_monitors(monitors.required_monitors(deployments, types), existing).write.mode("append").parquet(path)
    return spark.read.schema(MONITORS_DDL).parquet(path)
