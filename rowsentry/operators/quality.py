"""Column profiles, value histograms, constraints and their violations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rowsentry.functions.names import as_list
from rowsentry.operators.ranking import literal_of, nested_buckets, running_total, value_cuts

COLUMNS_PER_PASS = 100
MAX_DOMAIN = 20
INTEGRAL, FRACTIONAL, TEXT = "Integral", "Fractional", "String"
_INTEGER_TEXT = r"^[+-]?[0-9]+$"
_NUMBER_TEXT = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def column_kind(data_type: T.DataType) -> str:
    if isinstance(data_type, T.IntegralType):
        return INTEGRAL
    return FRACTIONAL if isinstance(data_type, T.NumericType) else TEXT


def unpivot_text(df: DataFrame, cols: Sequence[str], keep: Sequence[str | Column] = ()) -> DataFrame:
    """Long ``column, value`` rows with the values as text."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols]
    return df.select(*keep, F.inline(F.array(*pairs)))


def unpivot_numbers(df: DataFrame, cols: Sequence[str], keep: Sequence[str | Column] = ()) -> DataFrame:
    """Long ``column, value`` rows with the values as double, nulls left out."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols]
    return df.select(*keep, F.inline(F.array(*pairs))).filter("value IS NOT NULL")


def profile_columns(df: DataFrame, by: Sequence[str | Column] = (), columns: Sequence[str] | None = None,
                    domains: Mapping[str, Sequence[str]] | None = None, sketch: bool = True) -> DataFrame:
    """One row per column (and ``by``) from a single aggregation over the table.

    ``column, kind, n, n_null, completeness, n_distinct, mean, sum, std, min, max, n_unseen``.
    ``n_distinct`` is an estimate, null without ``sketch`` (:func:`exact_distinct` counts). ``n_unseen``
    counts the rows outside the column's entry in ``domains``. Runs on streams too, with a
    window as ``by``.
    """
    by = [F.col(b) if isinstance(b, str) else b for b in by]
    skip = {b for b in by if isinstance(b, str)}
    names = [c for c in df.columns if c not in skip] if columns is None else list(columns)
    kinds = {c: column_kind(df.schema[c].dataType) for c in names}
    out = None
    for start in range(0, len(names), COLUMNS_PER_PASS):
        stats = [_column_stats(c, kinds[c], (domains or {}).get(c), sketch) for c in names[start:start + COLUMNS_PER_PASS]]
        grouped = df.groupBy(*by).agg(F.array(*stats).alias("_stats"))
        group_names = [c for c in grouped.columns if c != "_stats"]
        part = grouped.select(*group_names, F.inline("_stats"))
        out = part if out is None else out.unionByName(part)
    return out


def _text(value: str) -> str:
    """A SQL string literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _column_stats(name: str, kind: str, domain: Sequence[str] | None, sketch: bool) -> Column:
    """All statistics of one column as one SQL expression: tables of hundreds of columns plan fast."""
    c = "`" + name.replace("`", "``") + "`"
    x = f"cast({c} as double)"
    numbers = {"mean": f"avg({x})", "sum": f"sum({x})", "std": f"stddev_pop({x})", "min": f"min({x})", "max": f"max({x})"}
    # The sketch takes integers; other values enter it by a 64-bit hash.
    item = f"cast({c} as bigint)" if kind == INTEGRAL else f"if({c} is null, null, xxhash64({c}))"
    unseen = "cast(null as bigint)"
    if domain is not None:
        listed = ", ".join(_text(v) for v in domain)
        unseen = f"count_if({c} is not null and cast({c} as string) not in ({listed}))" if domain else f"count({c})"
    parts = {
        "column": _text(name), "kind": _text(kind), "n": "count(1)", "n_null": f"count(1) - count({c})",
        "completeness": f"count({c}) / count(1)", "n_distinct": f"coalesce(hll_sketch_estimate(hll_sketch_agg({item})), 0)" if sketch else "cast(null as bigint)",
        **{k: v if kind != TEXT else "cast(null as double)" for k, v in numbers.items()}, "n_unseen": unseen,
    }
    return F.expr("named_struct(" + ", ".join(f"'{k}', {v}" for k, v in parts.items()) + ")")


def exact_distinct(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``column, n_distinct`` by grouping the values themselves: exact, one shuffle for all columns.

    Rows collapse to distinct values before the shuffle, so hot values cost nothing.
    """
    by = as_list(by)
    # Each value stays in the lane of its type, so numbers are neither printed nor rounded.
    lanes = {"i": "bigint", "d": "double", "s": "string"}

    def value(c: str) -> Column:
        kind = df.schema[c].dataType
        lane = "i" if isinstance(kind, T.IntegralType) else "d" if isinstance(kind, (T.FloatType, T.DoubleType)) else "s"
        return F.struct(F.lit(c).alias("column"),
                        *[(F.col(c) if k == lane else F.lit(None)).cast(t).alias(k) for k, t in lanes.items()])

    values = df.select(*by, F.inline(F.array(*[value(c) for c in columns]))).filter("i IS NOT NULL OR d IS NOT NULL OR s IS NOT NULL").distinct()
    return values.groupBy(*by, "column").agg(F.count("*").alias("n_distinct"))


def profile_columns_exact(df: DataFrame, by: Sequence[str] = (), columns: Sequence[str] | None = None,
                          domains: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """:func:`profile_columns` with exact distinct counts."""
    by = as_list(by)
    names = [c for c in df.columns if c not in by] if columns is None else list(columns)
    profile = profile_columns(df, by, names, domains, sketch=False)
    order = profile.columns
    exact = exact_distinct(df, names, by)
    joined = profile.drop("n_distinct").join(exact, [*by, "column"], "left")
    return joined.withColumn("n_distinct", F.coalesce("n_distinct", F.lit(0))).select(*order)


def value_histogram(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, value, n, share`` of every value, nulls included."""
    counts = unpivot_text(df, columns).groupBy("column", "value").agg(F.count("*").alias("n"))
    # Each column has every row once, so its counts add up to them: one row per column, hence the broadcast.
    rows = F.broadcast(counts.groupBy("column").agg(F.sum("n").alias("_rows")))
    return counts.join(rows, "column").select("column", "value", "n", (F.col("n") / F.col("_rows")).alias("share"))


def infer_column_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The narrowest type that all non-null texts of each column have: ``column, kind``."""
    stats = []
    for c in columns or df.columns:
        text = F.trim(F.col(c).cast("string"))
        filled = F.count(text)
        kind = (
            F.when(filled == 0, TEXT)
            .when(F.count_if(text.rlike(_INTEGER_TEXT)) == filled, INTEGRAL)
            .when(F.count_if(text.rlike(_NUMBER_TEXT)) == filled, FRACTIONAL)
            .otherwise(TEXT)
        )
        stats.append(F.struct(F.lit(c).alias("column"), kind.alias("kind"), filled.alias("n_filled")))
    return df.agg(F.array(*stats).alias("s")).select(F.inline("s"))


def profile_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """Exact interpolated quantiles: ``column, p, value``.

    Values are counted first, then ranked bucket by bucket along cut points from a sketch, so
    neither a hot value nor a long column ends up in one task.
    """
    found = value_cuts(df, columns)
    counts = unpivot_numbers(df, columns).groupBy("column", "value").agg(F.count("*").alias("n"))
    counts, bucket = nested_buckets(counts, found)
    placed = running_total(counts, ["column"], bucket, ["value"], ["n"])
    top = literal_of("column", {c: n - 1 for c, (_, n) in found.items()})
    # A value covers the places [n_run - n, n_run - 1]; keep the (value, p) pairs it decides.
    rows = placed.select("column", "value", top.alias("_top"), (F.col("n_run") - F.col("n")).alias("_first"),
                         (F.col("n_run") - 1).alias("_last"))
    wanted = F.array(*[F.lit(float(p)) for p in probabilities])
    hits = F.filter(wanted, lambda p: (F.ceil(p * F.col("_top")) >= F.col("_first")) & (F.floor(p * F.col("_top")) <= F.col("_last")))
    near = rows.withColumn("p", F.explode(hits))
    at = F.col("p") * F.col("_top")
    low = F.max(F.when(F.floor(at).between(F.col("_first"), F.col("_last")), F.col("value")))
    high = F.max(F.when(F.ceil(at).between(F.col("_first"), F.col("_last")), F.col("value")))
    return near.groupBy("column", "p").agg((low + (high - low) * F.max(at - F.floor(at))).alias("value"))


def quantile_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str | Column] = ()) -> DataFrame:
    """A mergeable quantile sketch per column: ``column, sketch`` (runs on streams too)."""
    each = [F.struct(F.lit(c).alias("column"), F.kll_sketch_agg_double(F.col(c).cast("double")).alias("sketch"))
            for c in columns]
    grouped = df.groupBy(*by).agg(F.array(*each).alias("_s"))
    return grouped.select(*[c for c in grouped.columns if c != "_s"], F.inline("_s"))


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Combine the sketches of several hours or files."""
    return sketches.groupBy(*by, "column").agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def sketch_quantiles(sketches: DataFrame, probabilities: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Approximate quantiles read from sketches: ``column, p, value``."""
    wanted = [F.struct(F.lit(float(p)).alias("p"),
                       F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("value")) for p in probabilities]
    return sketches.select(*by, "column", F.inline(F.array(*wanted)))


def suggest_constraints(profile: DataFrame, histogram: DataFrame | None = None, max_domain: int = MAX_DOMAIN) -> DataFrame:
    """Constraints a baseline satisfies: ``column, kind, min_completeness, non_negative, domain``.

    ``domain`` is set for text columns with at most ``max_domain`` distinct values.
    """
    basis = profile.select(
        "column", "kind", F.col("completeness").alias("min_completeness"),
        F.when(F.col("kind") != TEXT, F.coalesce(F.col("min") >= 0, F.lit(False))).alias("non_negative"),
        ((F.col("kind") == TEXT) & (F.col("n_distinct") <= max_domain)).alias("_closed"),
    )
    if histogram is None:
        return basis.withColumn("domain", F.lit(None).cast("array<string>")).drop("_closed")
    # Only columns with few distinct values get here, so a set holds at most max_domain texts
    # (an estimated distinct count may be off by a few).
    # ``closed`` has one row per column of the table at most, hence the broadcast.
    closed = F.broadcast(basis.filter("_closed").select("column"))
    domains = (
        histogram.filter("value IS NOT NULL").join(closed, "column")
        .groupBy("column").agg(F.array_sort(F.collect_set("value")).alias("domain"))
    )
    return basis.drop("_closed").join(domains, "column", "left")


CONSTRAINTS_DDL = ("column STRING, kind STRING, min_completeness DOUBLE, non_negative BOOLEAN, "
                   "domain ARRAY<STRING>")


def constraint_domains(constraints: DataFrame) -> dict[str, list[str]]:
    """The closed domains of a constraints table, which has one row per column."""
    return {r["column"]: list(r["domain"]) for r in constraints.filter("domain IS NOT NULL").collect()}


def join_constraints(profile: DataFrame, constraints: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Profile and constraints side by side on ``column``, each kept when the other lacks it.

    With ``by`` (an hour, say) every group of the profile meets all constraints.
    """
    by = as_list(by)
    wanted = constraints.select(
        "column", F.struct("kind", "min_completeness", "non_negative", "domain").alias("expected"))
    current = profile.select(*by, "column", F.struct(*[c for c in profile.columns if c not in {*by, "column"}]).alias("current"))
    if not by:
        return current.join(wanted, "column", "full")
    # The constraints, one per column of the baseline, reach each group as one array value.
    held = wanted.agg(F.collect_list(F.struct("column", "expected"))).scalar()
    groups = current.select(*by).distinct().withColumn("_w", held).select(*by, F.inline("_w"))
    return groups.join(current, [*by, "column"], "full")


def check_constraints(profile: DataFrame, constraints: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Violations ``column, check, detail`` of a current profile (per ``by``).

    Checks: missing column, extra column, type wider than the baseline's, completeness, sign,
    values outside the domain (``n_unseen`` of the profile).
    """
    by = as_list(by)
    joined = join_constraints(profile, constraints, by)
    cur, exp = F.col("current"), F.col("expected")
    both = cur.isNotNull() & exp.isNotNull()
    width = F.create_map(*[F.lit(x) for pair in ((INTEGRAL, 1), (FRACTIONAL, 2), (TEXT, 3)) for x in pair])

    def found(condition: Column, check: str, detail: Column) -> Column:
        return F.when(F.coalesce(condition, F.lit(False)), F.struct(F.lit(check).alias("check"), detail.alias("detail")))

    share = F.format_string("%.6f", cur["completeness"])
    checks = [
        found(cur.isNull(), "missing_column", F.lit("the column is not in the data")),
        found(exp.isNull(), "extra_column", F.lit("the column is not in the baseline")),
        found(both & (width[cur["kind"]] > width[exp["kind"]]), "data_type",
              F.concat(cur["kind"], F.lit(" where the baseline has "), exp["kind"])),
        found(both & (cur["completeness"] < exp["min_completeness"]), "completeness", F.concat(F.lit("completeness "), share)),
        found(both & exp["non_negative"] & (cur["min"] < 0), "non_negative", F.lit("negative values")),
        found(both & exp["domain"].isNotNull() & (cur["n_unseen"] > 0), "unseen_category",
              F.concat(cur["n_unseen"].cast("string"), F.lit(" rows outside the domain"))),
    ]
    return joined.select(*by, "column", F.inline(F.array_compact(F.array(*checks))))
