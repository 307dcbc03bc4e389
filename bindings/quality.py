"""Profiles, constraints and drift on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.catalog import query, table
from rowsentry.operators import drift, quality as ops

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
TEXTS = ["l_returnflag", "l_linestatus"]
PROBABILITIES = [0.05, 0.25, 0.5, 0.75, 0.95]


def _number_profile(table_name: str, c: str, kind: str) -> str:
    return f"""SELECT '{c}' AS "column", '{kind}' AS kind, count(*) AS n, count(*) - count({c}) AS n_null,
      round(count({c}) / count(*), 6) AS completeness, count(DISTINCT {c}) AS n_distinct, round(avg({c}), 4) AS mean,
      round(CAST(sum({c}) AS DOUBLE), 2) AS sum, round(stddev_pop({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max
      FROM {table_name}"""


def _text_profile(table_name: str, c: str) -> str:
    return f"""SELECT '{c}', 'String', count(*), count(*) - count({c}), round(count({c}) / count(*), 6), count(DISTINCT {c}),
      NULL, NULL, NULL, NULL, NULL FROM {table_name}"""


def _rounded(profile):
    digits = {"completeness": 6, "mean": 4, "sum": 2, "std": 4}
    return profile.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in profile.columns if c != "n_unseen"])


@query(" UNION ALL ".join([_number_profile("lineitem", "l_linenumber", "Integral"),
                           *[_number_profile("lineitem", c, "Fractional") for c in NUMBERS],
                           *[_text_profile("lineitem", c) for c in TEXTS]]))
def profile_columns(spark, sf):
    return _rounded(ops.profile_columns_exact(table(spark, sf, "lineitem"), columns=["l_linenumber", *NUMBERS, *TEXTS]))


@query()
def profile_columns_sketch(spark, sf):
    return ops.profile_columns(table(spark, sf, "lineitem"), columns=["l_linenumber", *NUMBERS, *TEXTS])


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({p} AS DOUBLE) AS p, round(quantile_cont({c}, {p}), 6) AS value FROM lineitem"
    for c in NUMBERS for p in PROBABILITIES))
def profile_quantiles(spark, sf):
    out = ops.profile_quantiles(table(spark, sf, "lineitem"), NUMBERS, PROBABILITIES)
    return out.select("column", "p", F.round("value", 6).alias("value"))


@query()
def profile_quantiles_sketch(spark, sf):
    """Sketches per ship year, merged: what an hourly job would keep and combine."""
    years = ops.quantile_sketches(table(spark, sf, "lineitem").withColumn("year", F.year("l_shipdate")), NUMBERS, ["year"])
    return ops.sketch_quantiles(ops.merge_sketches(years), PROBABILITIES)


@query(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {c} AS value, count(*) AS n, round(count(*) / (SELECT count(*) FROM orders), 6) AS share
        FROM orders GROUP BY {c}""" for c in ("o_orderstatus", "o_orderpriority")))
def value_histogram(spark, sf):
    out = ops.value_histogram(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])
    return out.select("column", "value", "n", F.round("share", 6).alias("share"))


_INT, _NUM = r"^[+-]?[0-9]+$", r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"


@query(" UNION ALL ".join(f"""
  SELECT '{c}' AS "column", CASE WHEN count(v) = 0 THEN 'String'
           WHEN count(*) FILTER (regexp_matches(v, '{_INT}')) = count(v) THEN 'Integral'
           WHEN count(*) FILTER (regexp_matches(v, '{_NUM}')) = count(v) THEN 'Fractional' ELSE 'String' END AS kind,
         count(v) AS n_filled FROM (SELECT CAST({c} AS VARCHAR) AS v FROM part)"""
                          for c in ("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")))
def infer_column_types(spark, sf):
    names = ["p_partkey", "p_name", "p_brand", "p_size", "p_retailprice"]
    text = table(spark, sf, "part").select(*[F.col(c).cast("string").alias(c) for c in names])
    return ops.infer_column_types(text)


_COLUMNS = ["o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority"]


def _baseline(spark, sf):
    return table(spark, sf, "orders").filter("o_orderdate < timestamp_ntz '1998-01-01'").select(*_COLUMNS)


def baseline_constraints(spark, sf):
    base = _baseline(spark, sf)
    profile = ops.profile_columns_exact(base)
    return ops.suggest_constraints(profile, ops.value_histogram(base, ["o_orderstatus", "o_orderpriority"]))


def _closed(c: str) -> str:
    return f"""SELECT '{c}' AS "column", 'String' AS kind, round(count({c}) / count(*), 6) AS min_completeness, CAST(NULL AS BOOLEAN) AS non_negative,
      string_agg(DISTINCT {c}, ',' ORDER BY {c}) AS domain FROM b"""


@query(f"""
  WITH b AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01')
  SELECT 'o_custkey' AS "column", 'Integral' AS kind, round(count(o_custkey) / count(*), 6) AS min_completeness,
         min(o_custkey) >= 0 AS non_negative, CAST(NULL AS VARCHAR) AS domain FROM b
  UNION ALL SELECT 'o_totalprice', 'Fractional', round(count(o_totalprice) / count(*), 6), min(o_totalprice) >= 0, NULL FROM b
  UNION ALL {_closed("o_orderstatus")} UNION ALL {_closed("o_orderpriority")}
""")
def suggest_constraints(spark, sf):
    out = baseline_constraints(spark, sf)
    return out.select("column", "kind", F.round("min_completeness", 6).alias("min_completeness"), "non_negative",
                      F.array_join("domain", ",").alias("domain"))


@query("""
  WITH c AS (SELECT CASE WHEN o_orderpriority = '5-LOW' THEN -o_totalprice ELSE o_totalprice END AS o_totalprice,
                    CASE WHEN o_orderstatus = 'O' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
                    CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderpriority END AS o_orderpriority
             FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')
  SELECT 'o_custkey' AS "column", 'missing_column' AS "check", 'the column is not in the data' AS detail
  UNION ALL SELECT 'o_clerk', 'extra_column', 'the column is not in the baseline'
  UNION ALL SELECT 'o_totalprice', 'non_negative', 'negative values' FROM c HAVING min(o_totalprice) < 0
  UNION ALL SELECT 'o_orderstatus', 'unseen_category', count(*) || ' rows outside the domain' FROM c WHERE o_orderstatus = 'X' HAVING count(*) > 0
  UNION ALL SELECT 'o_orderpriority', 'completeness', 'completeness ' || printf('%.6f', count(o_orderpriority) / count(*)) FROM c
            HAVING count(o_orderpriority) < count(*)
""")
def check_constraints(spark, sf):
    price = F.when(F.col("o_orderpriority") == "5-LOW", -F.col("o_totalprice")).otherwise(F.col("o_totalprice"))
    status = F.when(F.col("o_orderstatus") == "O", "X").otherwise(F.col("o_orderstatus"))
    priority = F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderpriority"))
    current = table(spark, sf, "orders").filter("o_orderdate >= timestamp_ntz '1998-01-01'").select(
        price.alias("o_totalprice"), status.alias("o_orderstatus"), priority.alias("o_orderpriority"),
        F.col("o_custkey").alias("o_clerk"))
    constraints = baseline_constraints(spark, sf)
    domains = ops.constraint_domains(constraints)
    return ops.check_constraints(ops.profile_columns(current, domains=domains), constraints)


def halves(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_shipdate", *NUMBERS, *TEXTS)
    early = F.col("l_shipdate") < F.lit("1998-06-01").cast("timestamp_ntz")
    return rows.filter(early), rows.filter(~early)


_A, _B = "l_shipdate < TIMESTAMP '1998-06-01'", "l_shipdate >= TIMESTAMP '1998-06-01'"


@query(" UNION ALL ".join(f"""
  SELECT '{c}' AS "column", round(max(abs(fa - fb)), 6) AS distance FROM (
    SELECT sum(a) OVER (ORDER BY v) / (SELECT count({c}) FROM lineitem WHERE {_A}) AS fa,
           sum(b) OVER (ORDER BY v) / (SELECT count({c}) FROM lineitem WHERE {_B}) AS fb
    FROM (SELECT {c} AS v, count(*) FILTER ({_A}) AS a, count(*) FILTER ({_B}) AS b FROM lineitem WHERE {c} IS NOT NULL GROUP BY {c}))"""
                          for c in ("l_extendedprice", "l_quantity", "l_discount")))
def drift_numeric(spark, sf):
    out = drift.drift_numeric(*halves(spark, sf), ["l_extendedprice", "l_quantity", "l_discount"])
    return out.select("column", F.round("distance", 6).alias("distance"))


@query(" UNION ALL ".join(f"""
  SELECT '{c}' AS "column", round(max(abs(fa - fb)), 6) AS distance FROM (
    SELECT sum(a) OVER (ORDER BY bin) / (SELECT count(*) FROM lineitem WHERE {_A}) AS fa,
           sum(b) OVER (ORDER BY bin) / (SELECT count(*) FROM lineitem WHERE {_B}) AS fb
    FROM (SELECT least(floor((v - lo) / ((hi - lo) / 1000)), 999) AS bin, count(*) FILTER (early) AS a, count(*) FILTER (NOT early) AS b
          FROM (SELECT {c} AS v, {_A} AS early FROM lineitem), (SELECT min({c}) AS lo, max({c}) AS hi FROM lineitem) GROUP BY 1))"""
                          for c in ("l_extendedprice", "l_quantity")))
def drift_numeric_binned(spark, sf):
    out = drift.drift_numeric_binned(*halves(spark, sf), ["l_extendedprice", "l_quantity"])
    return out.select("column", F.round("distance", 6).alias("distance"))


@query(" UNION ALL ".join(f"""
  SELECT '{c}' AS "column", round(max(abs(a / (SELECT count(*) FROM lineitem WHERE {_A}) - b / (SELECT count(*) FROM lineitem WHERE {_B}))), 6) AS distance
  FROM (SELECT {c} AS v, count(*) FILTER ({_A}) AS a, count(*) FILTER ({_B}) AS b FROM lineitem GROUP BY {c})"""
                          for c in TEXTS))
def drift_categorical(spark, sf):
    out = drift.drift_categorical(*halves(spark, sf), TEXTS)
    return out.select("column", F.round("distance", 6).alias("distance"))
