"""Scoring requests: text bodies to typed feature rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rowsentry.fixed_values import CSV_TYPE, FEATURE_DDL, JSON_TYPE, NO_INPUT, NULL_MARKERS
from rowsentry.functions.names import as_list
from rowsentry.functions.text import body_lines, field_count, quoted

_BAD = "_malformed"
_UNREADABLE = "The input could not be read."


def _fields(schema: str | T.StructType) -> list[T.StructField]:
    return (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields


def _ddl(fields: list[T.StructField], *more: str) -> str:
    parts = [f"`{f.name}` {f.dataType.simpleString()}" for f in fields]
    return ", ".join([*parts, *more])


def _csv_options() -> dict[str, str]:
    return {"ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true",
            "escape": "\"", "columnNameOfCorruptRecord": _BAD}


def _unsupported(content_type: Column) -> Column:
    return F.concat(F.lit("Content type "), F.coalesce(content_type, F.lit("null")), F.lit(" is not supported."))


def _fail_or_keep(df: DataFrame, strict: bool) -> DataFrame:
    if not strict:
        return df
    checked = F.when(F.col("error").isNotNull(), F.raise_error(F.col("error")).cast("string"))
    return df.withColumn("error", checked)


def _parse(df: DataFrame, fields: list[T.StructField], body: str, route: Column) -> DataFrame:
    """One row per CSV line or JSON object, in a single pass over the requests.

    Adds ``row_no`` from 0, ``n_rows`` of the request, the feature columns, and ``error``.
    The parsers run inside a generator, which Spark evaluates once per row: in a projection, every
    filter on ``error`` and every feature column would repeat them.
    """
    n = len(fields)
    is_csv, is_json = route == "csv", route == "json"
    others = [c for c in df.columns if c != body]
    pieces = F.when(is_csv, body_lines(body)).otherwise(F.array(F.col(body)))
    counted = F.transform(pieces, lambda x: F.struct(x.alias("line"), F.when(is_csv, field_count(x)).alias("n")))
    lines = df.select(*others, counted.alias("_pieces")).select(
        *others, F.greatest(F.size("_pieces"), F.lit(1)).alias("n_rows"), F.posexplode_outer("_pieces").alias("row_no", "_piece"),
    ).select(*others, "n_rows", "row_no", F.col("_piece.line").alias("_line"), F.col("_piece.n").alias("_n"))
    count = F.col("_n")
    # A line without the trailing label gets an empty one, so that one schema reads both kinds.
    full = F.concat(F.col("_line"), F.when(count == n, ",").otherwise(""))
    # Fields are read as text first: every spelling of a missing value is null, in a number as well as in a text.
    texts = [T.StructField(f.name, T.StringType()) for f in fields]
    read_csv = F.from_csv(full, _ddl(texts, "_label STRING", f"{_BAD} STRING"), _csv_options())
    read_json = F.from_json("_line", _ddl(fields, f"{_BAD} STRING"), {"columnNameOfCorruptRecord": _BAD})
    names = F.array(*[F.lit(f.name) for f in fields])
    parsed = lines.select(*others, "n_rows", "row_no", F.inline(F.array(F.struct(
        F.col("_line").isNull().alias("_empty"), count.alias("_n"),
        F.when(is_csv & count.isin(n, n + 1), read_csv).alias("_csv"),
        F.when(is_json, read_json).alias("_json"),
        F.when(is_json, F.array_except(names, F.json_object_keys(F.col("_line")))).alias("_absent"),
    ))))
    given = {f.name: F.when(~F.trim(F.col(f"_csv.`{f.name}`")).isin(*NULL_MARKERS), F.col(f"_csv.`{f.name}`")) for f in fields}
    typed = {f.name: given[f.name] if isinstance(f.dataType, T.StringType) else given[f.name].try_cast(f.dataType) for f in fields}
    broken = F.coalesce(F.col(f"_csv.{_BAD}"), F.col(f"_json.{_BAD}")).isNotNull() | (is_json & F.col("_absent").isNull())
    for f in fields:
        if not isinstance(f.dataType, T.StringType):
            broken = broken | (given[f.name].isNotNull() & typed[f.name].isNull())
    arity = F.concat(F.lit(f"Expected {n} values, got "), F.col("_n").cast("string"), F.lit("."))
    error = (
        F.when(~is_csv & ~is_json, _unsupported(F.col("content_type")) if "content_type" in others else F.lit(_UNREADABLE))
        .when(F.col("_empty"), F.lit(NO_INPUT))
        .when(~F.col("_n").isin(n, n + 1), arity)
        .when(broken, F.lit(_UNREADABLE))
        .when(F.size("_absent") > 0, F.concat(F.lit("Missing values: "), F.concat_ws(", ", "_absent")))
    )
    values = [F.coalesce(typed[f.name], F.col(f"_json.`{f.name}`")) for f in fields]
    return parsed.withColumn("error", error).select(
        *others, F.coalesce("row_no", F.lit(0)).alias("row_no"), "n_rows",
        *[F.when(F.col("error").isNull(), v).alias(f.name) for f, v in zip(fields, values)], "error")


def parse_csv_requests(df: DataFrame, schema: str | T.StructType = FEATURE_DDL, body: str = "body",
                       strict: bool = False) -> DataFrame:
    """One feature row per non-blank line of each CSV body, numbered by ``row_no`` from 0.

    A null or blank body, a wrong number of values, or an unreadable number gives ``error`` and
    null features; with ``strict`` it raises. One value too many is a trailing label, ignored.
    """
    return _fail_or_keep(_parse(df, _fields(schema), body, F.lit("csv")), strict)


def parse_json_requests(df: DataFrame, schema: str | T.StructType = FEATURE_DDL, body: str = "body",
                        strict: bool = False) -> DataFrame:
    """One feature row per JSON object, bound by name; further keys are ignored."""
    return _fail_or_keep(_parse(df, _fields(schema), body, F.lit("json")), strict)


def _route(content_type: Column) -> Column:
    return F.when(content_type == CSV_TYPE, "csv").when(content_type == JSON_TYPE, "json").otherwise("rejected")


def route_by_content_type(df: DataFrame, content_type: str = "content_type", strict: bool = False) -> DataFrame:
    """Add ``route`` (``csv``, ``json`` or ``rejected``) and, for the last, ``error``."""
    ct = F.col(content_type)
    known = F.coalesce(ct.isin(CSV_TYPE, JSON_TYPE), F.lit(False))
    routed = df.withColumn("route", _route(ct)).withColumn("error", F.when(~known, _unsupported(ct)))
    return _fail_or_keep(routed, strict)


def parse_requests(df: DataFrame, schema: str | T.StructType = FEATURE_DDL, body: str = "body",
                   strict: bool = False) -> DataFrame:
    """Parse each request by its ``content_type``; rejected ones keep a row with an ``error``."""
    return _fail_or_keep(_parse(df, _fields(schema), body, _route(F.col("content_type"))), strict)


def split_errors(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readable rows without the ``error`` column, and the rows that carry one."""
    return parsed.filter("error IS NULL").drop("error"), parsed.filter("error IS NOT NULL")


def to_request_lines(df: DataFrame, key: str, features: str | list[str]) -> DataFrame:
    """Rows as CSV request bodies with their key as ``inference_id``; a null is ``nan``, as :func:`parse_csv_requests` reads it."""
    line = F.concat_ws(",", *[F.coalesce(quoted(F.col(c).cast("string")), F.lit("nan")) for c in as_list(features)])
    return df.select(F.col(key).cast("string").alias("inference_id"), line.alias("body"))
