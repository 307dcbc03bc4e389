"""Predictions and the labels that arrive later."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rowsentry.operators.sizing import join_unique


def latest_labels(ground_truth: DataFrame, key: str = "inference_id", order: str | None = None, earliest: bool = False) -> DataFrame:
    """One row per key: the last (or ``earliest``) by ``order``, the whole row deciding among equals.

    An aggregation, so copies of one key collapse before the shuffle.
    """
    rest = [c for c in ground_truth.columns if c != key]
    whole = F.struct(*rest)
    rank = F.struct(order, whole) if order else whole
    picked = ground_truth.filter(F.col(key).isNotNull()).groupBy(key).agg((F.min_by if earliest else F.max_by)(whole, rank).alias("_last"))
    return picked.select(key, *[F.col(f"_last.{c}").alias(c) for c in rest])


def merge_ground_truth(captured: DataFrame, ground_truth: DataFrame, key: str = "inference_id",
                       order: str | None = None, earliest: bool = False) -> DataFrame:
    """Captured predictions with the latest (or ``earliest``) label of the same id."""
    return join_unique(captured, latest_labels(ground_truth, key, order, earliest), key, "inner")


def unmatched_predictions(captured: DataFrame, ground_truth: DataFrame, key: str = "inference_id") -> DataFrame:
    """Captured predictions that no label has reached yet."""
    known = ground_truth.select(key).filter(F.col(key).isNotNull()).distinct()
    return join_unique(captured, known, key, "left_anti")


def label_coverage(captured: DataFrame, ground_truth: DataFrame, key: str = "inference_id") -> DataFrame:
    """``captured, labelled, coverage`` of the captured rows."""
    known = ground_truth.select(key).filter(F.col(key).isNotNull()).distinct().withColumn("_hit", F.lit(1))
    joined = join_unique(captured.select(key), known, key, "left")
    return joined.agg(
        F.count("*").alias("captured"), F.count("_hit").alias("labelled"),
        (F.count("_hit") / F.count("*")).alias("coverage"))


def late_records(merged: DataFrame, emitted: DataFrame, key: str = "inference_id") -> DataFrame:
    """Pairs a full batch merge finds that the stream did not emit."""
    return join_unique(merged, emitted.select(key).distinct(), key, "left_anti")
