"""Joining two streams: predictions and the labels that follow within a time limit."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rowsentry.operators.merge import latest_labels


def stream_merge_ground_truth(captured: DataFrame, ground_truth: DataFrame, key: str = "inference_id",
                              ts: str = "ts", gt_ts: str = "gt_ts", delay: str = "1 hour",
                              lateness: str = "1 hour") -> DataFrame:
    """Predictions with the labels that arrive from their time until ``delay`` later.

    Both sides are watermarked and the interval bounds the state. Rows without a key cannot match
    and are left out before the shuffle. Of several labels of one id the first counts: on streams the first to arrive while
    the watermark remembers it, so that a pair is out at once (:func:`stream_merge_earliest` waits for the earliest), on
    tables the earliest. Otherwise tables take the same interval join.
    """
    left, right = _timed(captured, ground_truth, key, ts, gt_ts, lateness)
    if ground_truth.isStreaming:
        right = right.dropDuplicatesWithinWatermark([key])
    else:
        right = latest_labels(right, key, gt_ts, earliest=True)
    inside = F.col(gt_ts).between(F.col(ts), F.col(ts) + F.expr(f"INTERVAL {delay}"))
    return left.join(right.withColumnRenamed(key, "_key"), (F.col(key) == F.col("_key")) & inside, "inner").drop("_key")


def stream_merge_earliest(captured: DataFrame, ground_truth: DataFrame, key: str = "inference_id", ts: str = "ts", gt_ts: str = "gt_ts",
                          delay: str = "1 hour", lateness: str = "1 hour", before: str | None = None) -> DataFrame:
    """The merge in which the earliest label of an id by event time counts, in whatever order labels arrive.

    A later label does not step in when the earliest lies outside the limit. On two streams the interval join also takes the labels
    from ``before`` (by default ``delay``) ahead of the prediction, and a watermarked aggregation per prediction picks the
    earliest of them once no earlier one can arrive; both states are bounded by the intervals and ``lateness``. The result
    equals that of tables for rows that are at most ``lateness`` out of order and ids whose labels begin at most ``before``
    ahead of the prediction. An id identifies its prediction: identical repeats are one row.
    """
    if not (captured.isStreaming and ground_truth.isStreaming):
        if captured.isStreaming or ground_truth.isStreaming:
            raise ValueError("both sides must be streams, or both tables")
        return stream_merge_ground_truth(captured, ground_truth, key, ts, gt_ts, delay, lateness)
    left, right = _timed(captured, ground_truth, key, ts, gt_ts, lateness)
    near = F.col(gt_ts).between(F.col(ts) - F.expr(f"INTERVAL {before or delay}"), F.col(ts) + F.expr(f"INTERVAL {delay}"))
    pairs = left.join(right.withColumnRenamed(key, "_key"), (F.col(key) == F.col("_key")) & near, "inner")
    return _earliest(pairs, left, right, key, ts, gt_ts)


def _timed(captured: DataFrame, ground_truth: DataFrame, key: str, ts: str, gt_ts: str, lateness: str) -> tuple[DataFrame, DataFrame]:
    """Both sides without rows that lack a key, event times as TIMESTAMP, streams under a watermark."""
    out = []
    for df, when in ((captured, ts), (ground_truth, gt_ts)):
        rows = df.filter(F.col(key).isNotNull()).withColumn(when, F.col(when).cast("timestamp"))
        out.append(rows.withWatermark(when, lateness) if df.isStreaming else rows)
    return out[0], out[1]


def _earliest(pairs: DataFrame, left: DataFrame, right: DataFrame, key: str, ts: str, gt_ts: str) -> DataFrame:
    """One row per prediction: its earliest label (among equal times the least row), if that does not lie before it."""
    sent = [c for c in left.columns if c not in (key, ts)]
    told = [c for c in right.columns if c != key]
    first = pairs.groupBy(key, ts).agg(
        F.min(F.struct(gt_ts, F.struct(*told).alias("label"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(sent)])).alias("_first"))
    return first.filter(F.col(f"_first.{gt_ts}") >= F.col(ts)).select(
        *[F.col(c) if c in (key, ts) else F.col(f"_first._{sent.index(c)}").alias(c) for c in left.columns],
        *[F.col(f"_first.label.{c}").alias(c) for c in told])
