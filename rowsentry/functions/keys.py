"""Deterministic keys, hashes and sampling buckets."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from rowsentry.functions.names import as_col


def row_key(*cols: str | Column) -> Column:
    """The key columns as one text; use integers, strings and dates, and no nulls."""
    return F.concat_ws("|", *[as_col(c).cast("string") for c in cols])


def seeded_hash(seed: int | str | Column, key: str | Column) -> Column:
    """md5 text of ``seed|key``: a uniform, engine-independent order of the rows."""
    seed = seed if isinstance(seed, Column) else F.lit(str(seed))
    return F.md5(F.concat_ws("|", seed.cast("string"), as_col(key)))


def hash_percent(key: str | Column) -> Column:
    """A bucket from 0 to 99 taken from the first 32 bits of the key's md5."""
    head = F.conv(F.substring(F.md5(as_col(key).cast("string")), 1, 8), 16, 10)
    return F.pmod(head.cast("bigint"), F.lit(100))
