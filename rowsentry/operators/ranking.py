"""Exact running totals and ranks without one task per group.

A window over a whole group puts the group into one task. Here the rows first fall into
buckets that follow the order; each task ranks one bucket, and the total of the earlier
buckets (a table with one row per bucket) is added. Buckets that are too full are cut again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowsentry.operators.sizing import kept, settle_small

BUCKET_HEX = 3
MAX_PARTS, MIN_PARTS, LEAVES = 1024, 16, 64
ROWS_PER_PART = 1_000_000
SKETCH_SIZE = 5000


def hash_bucket(hash_col: str, digits: int = BUCKET_HEX, start: int = 1) -> Column:
    """The next ``digits`` hex digits of a hash: buckets of equal share that keep its order."""
    return F.substring(F.col(hash_col), start, digits)


def running_total(df: DataFrame, by: Sequence[str], bucket: Column, order: Sequence[str],
                  weights: Sequence[str]) -> DataFrame:
    """Add ``<weight>_run``: the inclusive running sum of each weight in ``order`` within ``by``.

    ``bucket`` must not decrease along ``order``; ``order`` must be total.
    """
    # As structs group and bucket are never null themselves, and equal when their parts are equal
    # or both null, so the join loses no row; it shares the window's partitioning of the rows.
    group = F.struct(*by) if by else F.struct(F.lit(0))
    keys = ["_group", "_bucket"]
    rows = df.withColumn("_group", group).withColumn("_bucket", F.struct(bucket.alias("b")))
    earlier = Window.partitionBy("_group").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    sums = rows.groupBy(*keys).agg(*[F.sum(w).alias(f"_{w}_sum") for w in weights])
    offsets = sums.select(*keys, *[F.coalesce(F.sum(f"_{w}_sum").over(earlier), F.lit(0)).alias(f"_{w}_before") for w in weights])
    placed = rows.select("*", *[F.sum(w).over(inside).alias(f"_{w}_in") for w in weights])
    return placed.join(offsets, keys).select(
        *df.columns, *[(F.col(f"_{w}_before") + F.col(f"_{w}_in")).alias(f"{w}_run") for w in weights])


def bucketed_rank(df: DataFrame, by: Sequence[str], bucket: Column, order: Sequence[str],
                  name: str = "rank") -> DataFrame:
    """Row numbers 1, 2, … in ``order`` within ``by``, exact for any group size."""
    ones = df.withColumn("_one", F.lit(1).cast("bigint"))
    ranked = running_total(ones, by, bucket, order, ["_one"])
    return ranked.withColumnRenamed("_one_run", name).drop("_one")


def value_cuts(df: DataFrame, columns: Sequence[str], parts: int = MAX_PARTS) -> dict[str, tuple[list[float], int]]:
    """Per column up to ``parts - 1`` rising cut values and the number of values, in one pass.

    The cuts come from a quantile sketch and only balance the buckets; there are as many as
    give each bucket about ``ROWS_PER_PART`` values.
    """
    shares = ", ".join(f"{i / parts}D" for i in range(1, parts))
    stats = [
        F.struct(F.expr(f"approx_percentile(cast(`{c}` as double), array({shares}), {SKETCH_SIZE})").alias("cuts"),
                 F.count(c).alias("n")).alias(f"_{i}")
        for i, c in enumerate(columns)
    ]
    row = df.agg(*stats).first()
    out = {}
    for i, c in enumerate(columns):
        n = row[i]["n"]
        step = max(1, parts // max(MIN_PARTS, min(parts, n // ROWS_PER_PART)))
        out[c] = (sorted(set((row[i]["cuts"] or [])[step - 1::step])), n)
    return out


def range_bucket(value: Column, cuts: Sequence[float]) -> Column:
    """How many of the rising ``cuts`` are at or below ``value``.

    A binary search as nested conditions; beyond ``LEAVES`` cuts its leaves count a short array.
    """
    leaf = max(1, -(-len(cuts) // LEAVES))

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        if leaf > 1 and high - low <= leaf:
            some = F.array(*[F.lit(c) for c in cuts[low:high]])
            return F.lit(low) + F.size(F.filter(some, lambda c: c <= value))
        middle = (low + high) // 2
        return F.when(value < F.lit(cuts[middle]), search(low, middle)).otherwise(search(middle + 1, high))

    return search(0, len(cuts))


def column_range_bucket(column: str, value: str, cuts: dict[str, Sequence[float]]) -> Column:
    """:func:`range_bucket` on long ``(column, value)`` rows, with the cuts of each column."""
    out = None
    for name, points in cuts.items():
        test = F.col(column) == name
        found = range_bucket(F.col(value), points)
        out = F.when(test, found) if out is None else out.when(test, found)
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def nested_buckets(counts: DataFrame, found: dict[str, tuple[list[float], int]]) -> tuple[DataFrame, Column]:
    """Distinct ``column, value`` rows with a bucket for :func:`running_total`, given :func:`value_cuts` of the columns.

    Columns too long for ``MAX_PARTS`` buckets of ``ROWS_PER_PART`` values have those buckets cut again that hold more, by
    quantiles of their own, until none does. Only these few are looked at; the others stay as they are.
    """
    bucket = column_range_bucket("column", "value", {c: cuts for c, (cuts, _) in found.items()})
    if all(n <= MAX_PARTS * ROWS_PER_PART for _, n in found.values()):
        return counts, bucket
    rows, keys, largest = kept(counts.withColumn("_b0", bucket)), ["column", "_b0"], None
    shares = ", ".join(f"{i / MAX_PARTS}D" for i in range(1, MAX_PARTS))
    while True:
        sizes = rows.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > ROWS_PER_PART)
        full, size = settle_small(sizes)
        if size == 0:
            break
        most = full.agg(F.max("_n")).first()[0]
        if largest is not None and most >= largest:
            break  # values that the sketch cannot tell apart
        largest = most
        held = F.broadcast(full) if size is not None else full
        # Of the finest cuts as many are kept as give each part about ROWS_PER_PART values.
        step = F.greatest(F.lit(1), F.floor(F.lit(MAX_PARTS) / F.ceil(2 * F.first("_n") / ROWS_PER_PART)))
        fine = F.expr(f"approx_percentile(value, array({shares}), {SKETCH_SIZE})")
        cuts, few = settle_small(
            rows.join(held, keys).groupBy(*keys).agg(fine.alias("_fine"), step.alias("_step"))
            .select(*keys, F.filter("_fine", lambda c, i: (i + 1) % F.col("_step") == 0).alias("_cuts")))
        name = f"_b{len(keys) - 1}"
        inner = F.size(F.filter("_cuts", lambda c: c <= F.col("value")))
        met = rows.join(F.broadcast(cuts) if few is not None else cuts, keys, "left")
        rows = kept(met.withColumn(name, F.when(F.col("_cuts").isNull(), -1).otherwise(inner)).drop("_cuts"))
        keys = [*keys, name]
    return rows, F.struct(*keys[1:])


def literal_of(column: str, values: dict[str, int]) -> Column:
    """The entry of ``values`` for the name in ``column``."""
    pairs = [F.lit(x) for name, n in values.items() for x in (name, n)]
    return F.create_map(*pairs)[F.col(column)]
