"""Small helpers around column names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_list(names: str | Iterable[str] | None) -> list[str]:
    if names is None:
        return []
    return [names] if isinstance(names, str) else list(names)


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    """Raise, naming the absent columns, when ``df`` lacks any of ``names``."""
    present = set(df.columns)
    absent = [n for n in names if n not in present]
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
