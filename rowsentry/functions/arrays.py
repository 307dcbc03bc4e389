"""Argmax, confidence and label codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from rowsentry.functions.names import as_col


def argmax(probabilities: str | Column) -> Column:
    """Zero-based position of the largest value; the first one wins a tie."""
    p = as_col(probabilities)
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def confidence(probabilities: str | Column) -> Column:
    return F.array_max(as_col(probabilities))


def _domain(domain: Sequence[str]) -> Column:
    return F.array(*[F.lit(d) for d in domain])


def encode_label(label: str | Column, domain: Sequence[str]) -> Column:
    """Zero-based code of the label in ``domain``; null when it is not in there."""
    position = F.array_position(_domain(domain), as_col(label))
    return F.when(position > 0, (position - 1).cast("int"))


def decode_label(code: str | Column, domain: Sequence[str]) -> Column:
    """The label of a zero-based code; null outside the domain."""
    code = as_col(code).cast("int")
    inside = (code >= 0) & (code < len(domain))
    return F.when(inside, F.element_at(_domain(domain), code + 1))
