"""Hours and time-named paths."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from rowsentry.fixed_values import GROUND_TRUTH_PATH_FORMAT, VERSION_SUFFIX_FORMAT
from rowsentry.functions.names import as_col


def ground_truth_path(ts: str | Column, root: str = "") -> Column:
    """``<root>/yyyy/MM/dd/HH/mmss.jsonl`` of the event time (session zone UTC)."""
    prefix = f"{root.rstrip('/')}/" if root else ""
    return F.concat(F.lit(prefix), F.date_format(as_col(ts), GROUND_TRUTH_PATH_FORMAT), F.lit(".jsonl"))


def version_name(base: str | Column, kind: str, ts: str | Column) -> Column:
    """``<base>-<kind>-MMddHHmmss``."""
    return F.concat_ws("-", as_col(base), F.lit(kind), F.date_format(as_col(ts), VERSION_SUFFIX_FORMAT))


def hour_of(ts: str | Column) -> Column:
    """Start of the hour, keeping the column's timestamp type."""
    return F.date_trunc("hour", as_col(ts))
