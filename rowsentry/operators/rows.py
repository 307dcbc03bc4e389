"""Cleaning, projections and row filters."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rowsentry.fixed_values import (
    ACCURACY_PATH, ACCURACY_THRESHOLD, GATE_MESSAGE, LABEL_COLUMN, NULL_MARKERS,
)
from rowsentry.functions.names import as_list, require_columns
from rowsentry.functions.text import record_to_map


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def clean_rows(df: DataFrame, sentinels: Sequence[str] = NULL_MARKERS,
               domains: Mapping[str, Sequence[str]] | None = None,
               numeric: Sequence[str] | None = None) -> DataFrame:
    """Complete rows only: sentinels become null, numbers double, foreign values go.

    ``numeric`` names text columns that hold numbers; numeric columns are cast in any case.
    A value outside its ``domains`` entry drops the row, as does any null.
    """
    numbers = set(numeric_columns(df)) | set(numeric or [])
    marks = list(sentinels)
    projected = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            c = F.when(~F.trim(c).isin(marks), c)
        if field.name in numbers:
            c = c.cast("double")
        projected.append(c.alias(field.name))
    out = df.select(*projected).dropna("any")
    for name, values in (domains or {}).items():
        out = out.filter(F.col(name).isin(list(values)))
    return out


def split_features_label(df: DataFrame, label: str = LABEL_COLUMN) -> tuple[DataFrame, DataFrame]:
    """The features without the label, and the label alone."""
    require_columns(df, [label])
    return df.drop(label), df.select(label)


def rename_by_position(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Give the columns new names in order; their number must agree."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def select_by_dtype(df: DataFrame, kind: str, exclude: str | Sequence[str] = ()) -> DataFrame:
    """The ``numeric`` (as double) or ``categorical`` (string) columns, in schema order."""
    skip = set(as_list(exclude))
    if kind == "numeric":
        return df.select(*[F.col(c).cast("double").alias(c) for c in numeric_columns(df) if c not in skip])
    if kind == "categorical":
        return df.select(*[c for c in string_columns(df) if c not in skip])
    raise ValueError(f"unknown kind {kind}")


def tail_columns(df: DataFrame, n: int, rest: bool = False) -> DataFrame:
    """The last ``n`` columns, or with ``rest`` all but those."""
    return df.select(*(df.columns[:-n] if rest else df.columns[-n:]))


def event_pattern(df: DataFrame, pattern: Mapping, json_column: str | None = None) -> Column:
    """Conjunction of memberships from a nested pattern ``{key: [values] | {...}}``.

    Keys are columns and struct fields of ``df``, or JSON paths inside ``json_column``. An
    array column matches when any element is listed.
    """

    def kind_of(path: Sequence[str]) -> T.DataType:
        kind: T.DataType = df.schema
        for step in path:
            kind = kind[step].dataType
        return kind

    def walk(node: Mapping, path: tuple[str, ...]) -> Column:
        out = F.lit(True)
        for key, wanted in node.items():
            here = (*path, key)
            if isinstance(wanted, Mapping):
                out = out & walk(wanted, here)
                continue
            values = list(wanted)
            if json_column is not None and here[0] not in df.columns:
                at = "$" + "".join(f"['{step}']" for step in here)
                hit = F.get_json_object(F.col(json_column), at).isin([str(v) for v in values])
            else:
                c = F.col(".".join(f"`{step}`" for step in here))
                if isinstance(kind_of(here), T.ArrayType):
                    hit = F.arrays_overlap(c, F.array(*[F.lit(v) for v in values]))
                else:
                    hit = c.isin(values)
            out = out & F.coalesce(hit, F.lit(False))
        return out

    return walk(pattern, ())


def event_pattern_filter(df: DataFrame, pattern: Mapping, json_column: str | None = None) -> DataFrame:
    """Rows whose event matches ``pattern`` (see :func:`event_pattern`)."""
    return df.filter(event_pattern(df, pattern, json_column))


def quality_gate(reports: DataFrame, report: str = "report", path: str = ACCURACY_PATH,
                 threshold: float = ACCURACY_THRESHOLD, strict: bool = False) -> DataFrame:
    """Whether the metric at ``path`` of each JSON report reaches ``threshold`` (inclusive).

    Adds ``metric``, ``threshold``, ``passed`` and, on failure, ``message``. With ``strict`` a
    failing report raises when the row is evaluated.
    """
    metric = F.get_json_object(F.col(report), f"$.{path}").cast("double")
    passed = F.coalesce(metric >= F.lit(float(threshold)), F.lit(False))
    text = f"{GATE_MESSAGE} {threshold}"
    message = F.when(~passed, F.raise_error(F.lit(text)) if strict else F.lit(text))
    if strict:
        passed = F.when(passed, F.lit(True)).otherwise(F.raise_error(F.lit(text)).cast("boolean"))
    return (
        reports.withColumn("metric", metric)
        .withColumn("threshold", F.lit(float(threshold)))
        .withColumn("passed", passed)
        .withColumn("message", message)
    )


def with_record_hook(df: DataFrame, hook: Callable[[DataFrame], DataFrame] | None = None,
                     line: str = "input") -> DataFrame:
    """Apply a user's hook to captured records; by default ``record`` is the positional map."""
    if hook is not None:
        return df.transform(hook)
    return df.withColumn("record", record_to_map(line))


def record_columns(df: DataFrame, schema: str | T.StructType, record: str = "record") -> DataFrame:
    """Positional map values (``"00"``, ``"01"``, …) as the named, typed columns of ``schema``."""
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    values = [
        F.expr(f"try_cast(`{record}`['{i:02d}'] as {f.dataType.simpleString()})").alias(f.name) for i, f in enumerate(fields)
    ]
    return df.select(*[c for c in df.columns if c != record], *values)


def concat_columns(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Columns of two tables side by side, row by row on their common unique key."""
    return left.join(right, as_list(key), "inner")
