"""Model versions, approvals, deployments and drift baselines as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rowsentry.fixed_values import (
    APPROVED_STATUS, MODEL_DOMAIN, MODEL_TASK, PENDING_STATUS, REPORT_TYPES,
)
from rowsentry.functions.names import as_list
from rowsentry.functions.times import version_name
from rowsentry.operators.ranking import bucketed_rank
from rowsentry.operators.rows import event_pattern_filter
from rowsentry.operators.sizing import join_unique


def register_version(registry: DataFrame | None, entries: DataFrame, group: str, order: Sequence[str],
                     bucket: Column | None = None, status: str = PENDING_STATUS) -> DataFrame:
    """``entries`` with ``version`` (max + 1, + 2, … of their group in ``order``) and ``status``.

    ``order`` must be total within a group. ``bucket`` is an expression that never decreases
    along it (the day of a timestamp, say); with it even one huge group is numbered in parallel.
    """
    fresh = bucketed_rank(entries, [group], F.lit(0) if bucket is None else bucket, list(order), "_no")
    if registry is None:
        numbered = fresh.withColumn("version", F.col("_no"))
    else:
        top = registry.groupBy(group).agg(F.max("version").alias("_top"))
        numbered = join_unique(fresh, top, group, "left").withColumn(
            "version", F.coalesce("_top", F.lit(0)) + F.col("_no")).drop("_top")
    return numbered.drop("_no").withColumn("status", F.lit(status))


def describe_version(entries: DataFrame, description: str, links: dict[str, str] | None = None) -> DataFrame:
    """The attributes a registered version carries: content types, task, metric links, text."""
    out = (
        entries.withColumn("content_types", F.array(*[F.lit(t) for t in REPORT_TYPES]))
        .withColumn("response_types", F.array(*[F.lit(t) for t in REPORT_TYPES]))
        .withColumn("domain", F.lit(MODEL_DOMAIN)).withColumn("task", F.lit(MODEL_TASK))
        .withColumn("description", F.lit(description))
    )
    for name, link in (links or {}).items():
        out = out.withColumn(name, F.lit(link))
    return out


def latest_approved(events: DataFrame, group: str, artifact: str, order: Sequence[str],
                    status: str = "status", approved: str = APPROVED_STATUS,
                    groups: Sequence[str] | None = None) -> DataFrame:
    """The last approved artifact per group."""
    pattern: dict = {status: [approved]}
    if groups is not None:
        pattern[group] = list(groups)
    kept = event_pattern_filter(events, pattern)
    last = F.max_by(F.struct(artifact, *[c for c in order if c != artifact]), F.struct(*order)).alias("l")
    picked = kept.groupBy(group).agg(last)
    return picked.select(group, *[F.col(f"l.{c}").alias(c) for c in dict.fromkeys([artifact, *order])])


def deployment_upsert(current: DataFrame, approved: DataFrame, endpoint: str = "endpoint",
                      artifact: str = "artifact", ts: str = "ts") -> DataFrame:
    """Next state of the deployments: ``endpoint, artifact, config, action``.

    An endpoint of that exact name is ``updated``, an absent one ``created``; one without a new
    artifact stays ``unchanged``. Both sides hold one row per endpoint.
    """
    old = current.select(endpoint, F.col(artifact).alias("_old"), F.col("config").alias("_config"))
    new = approved.select(endpoint, F.col(artifact).alias("_new"), F.col(ts).alias("_ts"))
    config = version_name(F.col(endpoint).cast("string"), "config", "_ts")
    action = (
        F.when(F.col("_new").isNull(), "unchanged").when(F.col("_old").isNull(), "created").otherwise("updated")
    )
    return old.join(new, endpoint, "full").select(
        endpoint,
        F.coalesce("_new", "_old").alias(artifact),
        F.when(F.col("_new").isNotNull(), config).otherwise(F.col("_config")).alias("config"),
        action.alias("action"),
    )


def latest_version(table: DataFrame, group: str | Sequence[str], version: str = "version") -> DataFrame:
    """The whole row with the highest version per group."""
    keys = as_list(group)
    rest = [c for c in table.columns if c not in keys]
    picked = table.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(version, *[c for c in rest if c != version])).alias("l"))
    return picked.select(*keys, *[F.col(f"l.{c}").alias(c) for c in rest])


def drift_check_baselines(registered: DataFrame, calculated: DataFrame, group: str, payload: str,
                          register_new: bool = True) -> DataFrame:
    """Which baseline drift is measured against: ``group, payload, source``.

    With ``register_new`` the newly calculated one replaces the registered one; otherwise the
    registered one of the highest version stays, and a calculated one only fills a gap.
    """
    old = latest_version(registered.select(group, "version", payload), group).select(group, F.col(payload).alias("_old"))
    new = calculated.select(group, F.col(payload).alias("_new"))
    first, second = ("_new", "_old") if register_new else ("_old", "_new")
    source = F.when(F.col(first).isNotNull(), "calculated" if register_new else "registered").otherwise(
        "registered" if register_new else "calculated")
    return old.join(new, group, "full").select(group, F.coalesce(first, second).alias(payload), source.alias("source"))
