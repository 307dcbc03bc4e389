"""Distance between the value distributions of a baseline and of current data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from rowsentry.operators.quality import unpivot_numbers, unpivot_text
from rowsentry.operators.ranking import nested_buckets, running_total, value_cuts

_SIDES = ("_a", "_b")


def _both(baseline: DataFrame, current: DataFrame, columns: Sequence[str], unpivot) -> DataFrame:
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    a = unpivot(baseline, columns).withColumn("_a", one).withColumn("_b", none)
    b = unpivot(current, columns).withColumn("_a", none).withColumn("_b", one)
    return a.unionByName(b)


def _totals(rows: DataFrame) -> DataFrame:
    """Rows per side and column: a table with one row per column, hence broadcast."""
    return F.broadcast(rows.groupBy("column").agg(*[F.sum(s).alias(f"{s}_n") for s in _SIDES]))


def _gap(a: str, b: str):
    return F.max(F.abs(F.col(a) / F.nullif(F.col("_a_n"), F.lit(0)) - F.col(b) / F.nullif(F.col("_b_n"), F.lit(0))))


def drift_numeric(baseline: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact two-sample Kolmogorov-Smirnov distance: ``column, distance``.

    Equal values are counted together before the shuffle and ranked bucket by bucket.
    """
    sides = baseline.select(*columns).unionByName(current.select(*columns))
    found = value_cuts(sides, columns)
    counts = _both(baseline, current, columns, unpivot_numbers).groupBy("column", "value").agg(*[F.sum(s).alias(s) for s in _SIDES])
    counts, bucket = nested_buckets(counts, found)
    placed = running_total(counts, ["column"], bucket, ["value"], list(_SIDES))
    return placed.join(_totals(counts), "column").groupBy("column").agg(_gap("_a_run", "_b_run").alias("distance"))


def drift_numeric_binned(baseline: DataFrame, current: DataFrame, columns: Sequence[str], bins: int = 1000) -> DataFrame:
    """Lower bound of :func:`drift_numeric` over equal-width bins; only bin counts are shuffled."""
    rows = _both(baseline, current, columns, unpivot_numbers)
    # One row per column.
    spans = F.broadcast(rows.groupBy("column").agg(F.min("value").alias("_lo"), F.max("value").alias("_hi")))
    width = (F.col("_hi") - F.col("_lo")) / bins
    place = F.when(width > 0, F.least(F.floor((F.col("value") - F.col("_lo")) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    counts = rows.join(spans, "column").groupBy("column", place.alias("bin")).agg(*[F.sum(s).alias(s) for s in _SIDES])
    along = Window.partitionBy("column").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    runs = counts.select("column", *[F.sum(s).over(along).alias(f"{s}_run") for s in _SIDES])
    return runs.join(_totals(counts), "column").groupBy("column").agg(_gap("_a_run", "_b_run").alias("distance"))


def drift_categorical(baseline: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Largest difference between the shares of any one value: ``column, distance``."""
    rows = _both(baseline, current, columns, unpivot_text)
    counts = rows.groupBy("column", "value").agg(*[F.sum(s).alias(s) for s in _SIDES])
    return counts.join(_totals(counts), "column").groupBy("column").agg(_gap("_a", "_b").alias("distance"))
