"""Monitor runs: status, reports, and monitors still to be created."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rowsentry.fixed_values import MONITOR_TYPES, VIOLATED_STATUS
from rowsentry.functions.names import as_list

MONITOR = ("endpoint", "type")


def monitor_status(runs: DataFrame, time: str = "last_ts", status: str = "last_status", tie: str = "run_id") -> DataFrame:
    """Per endpoint and type the last run: ``run_id, last_status, last_ts, n_runs``."""
    last = F.max_by(F.struct(tie, status, time), F.struct(time, tie)).alias("l")
    grouped = runs.groupBy(*MONITOR).agg(last, F.count("*").alias("n_runs"))
    return grouped.select(*MONITOR, F.col(f"l.{tie}").alias("run_id"), F.col(f"l.{status}").alias("last_status"),
                          F.col(f"l.{time}").alias("last_ts"), "n_runs")


def monitor_report(runs: DataFrame, violations: DataFrame, endpoint: str | None = None,
                   types: str | Sequence[str] | None = None) -> DataFrame:
    """Runs with their violations, which are attached only to runs that completed with some.

    One row per violation, or one with nulls; nothing is gathered into lists.
    """
    chosen = runs
    if endpoint is not None:
        chosen = chosen.filter(F.col("endpoint") == endpoint)
    if types is not None:
        chosen = chosen.filter(F.col("type").isin(as_list(types)))
    violated = F.coalesce(F.col("last_status") == VIOLATED_STATUS, F.lit(False))
    # Only violated runs enter the join; the others would all meet under one null key.
    found = chosen.filter(violated).join(violations, "run_id", "left")
    return found.unionByName(chosen.filter(~violated), allowMissingColumns=True).select(*chosen.columns, *[
        c for c in violations.columns if c != "run_id"])


def required_monitors(endpoints: DataFrame, types: Sequence[str] = MONITOR_TYPES) -> DataFrame:
    """Every endpoint with every monitor type it must have."""
    return endpoints.select("endpoint").distinct().select("endpoint", F.explode(F.array(*[F.lit(t) for t in types])).alias("type"))


def missing_monitors(required: DataFrame, existing: DataFrame) -> DataFrame:
    """Required (endpoint, type) pairs for which no monitor exists."""
    return required.join(existing.select(*MONITOR).distinct(), list(MONITOR), "left_anti")


def found_monitors(required: DataFrame, existing: DataFrame) -> DataFrame:
    """Required pairs with ``found``."""
    have = existing.select(*MONITOR).distinct().withColumn("_have", F.lit(True))
    return required.join(have, list(MONITOR), "left").select(*MONITOR, F.col("_have").isNotNull().alias("found"))
