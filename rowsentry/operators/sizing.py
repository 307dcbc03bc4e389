"""Joins that broadcast only what has been measured, and stay exact beyond that; tables written to cut lineage."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rowsentry.functions.names import as_list

SMALL_ROWS = 20_000
HOT_SHARE = 0.01
HOT_TRACKED = 10_000


def written(df: DataFrame) -> DataFrame | None:
    """``df`` as a table below ``spark.checkpoint.dir``, or None where no such folder is named."""
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        return None
    path = f"{folder.rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def kept(df: DataFrame) -> DataFrame:
    """The written table, or ``df`` itself where there is no folder to write to."""
    out = written(df)
    return df if out is None else out


def settle_small(df: DataFrame, max_rows: int = SMALL_ROWS) -> tuple[DataFrame, int | None]:
    """Run ``df`` once and keep its rows as a local table when it has at most ``max_rows``.

    Returns the table and its number of rows. Of a larger result at most ``max_rows + 1`` rows
    are brought to the driver; then the lazy ``df`` comes back, with None for its size.
    """
    head = df.limit(max_rows + 1).toArrow()
    if head.num_rows > max_rows:
        return df, None
    return df.sparkSession.createDataFrame(head, df.schema), head.num_rows


def lookup(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner",
           max_rows: int = SMALL_ROWS) -> DataFrame:
    """Join to a table with one row per key that is expected to be small.

    A measured small table is broadcast, a larger one joined by :func:`join_unique`.
    """
    settled, size = settle_small(right, max_rows)
    if size is not None:
        return left.join(F.broadcast(settled), as_list(on), how)
    return join_unique(left, right, on, how)


def heavy_keys(df: DataFrame, key: Column, share: float = HOT_SHARE) -> list[str]:
    """Key texts that may hold more than ``share`` of the rows; at most ``1 / share`` of them.

    One pass over the key column with a mergeable sketch of fixed size. The list steers the
    physical plan only: a key missed or listed in error never changes a result.
    """
    top = max(1, int(1 / share))
    counted = df.select(key.cast("string").alias("k"))
    row = counted.agg(
        F.count("*").alias("n"),
        F.expr(f"approx_top_k(k, {top}, {HOT_TRACKED})").alias("top"),
    ).first()
    return [e["item"] for e in row["top"] or [] if e["item"] is not None and e["count"] > row["n"] * share]


def join_unique(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner",
                hot: Sequence[str] | None = None) -> DataFrame:
    """Equi-join of a possibly skewed ``left`` to a ``right`` with one row per key.

    ``how`` is ``inner``, ``left``, ``left_anti`` or ``left_semi``. Keys that hold a large share
    of ``left`` meet their right row (at most one each, so the broadcast has a proven bound)
    without a shuffle; the others take the ordinary shuffled join. Rows with a null key never
    match and do not enter a join at all, so they cannot pile up in one partition.
    """
    if how not in ("inner", "left", "left_anti", "left_semi"):
        raise ValueError(f"join type {how} is not supported here")
    keys = as_list(on)

    def text(df: DataFrame) -> Column:
        parts = [df[k].cast("string") for k in keys]
        return parts[0] if len(parts) == 1 else F.concat_ws("\x1f", *parts)

    def no_null(df: DataFrame) -> Column:
        out = F.lit(True)
        for k in keys:
            out = out & df[k].isNotNull()
        return out

    keyed = left.filter(no_null(left))
    hot = heavy_keys(keyed, text(keyed)) if hot is None else list(hot)
    if hot:
        warm = keyed.filter(~text(keyed).isin(hot)).join(right, keys, how)
        few = F.broadcast(right.filter(text(right).isin(hot)))
        joined = warm.unionByName(keyed.filter(text(keyed).isin(hot)).join(few, keys, how))
    else:
        joined = keyed.join(right, keys, how)
    if how in ("inner", "left_semi"):
        return joined
    loose = left.filter(~no_null(left))
    return joined.unionByName(loose, allowMissingColumns=True).select(*joined.columns)
