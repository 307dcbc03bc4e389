"""Scaling, indicators and label codes on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.catalog import query, split_sql, table
from bindings.splits import LINES, lines
from rowsentry.functions import arrays
from rowsentry.operators import features as ops, split

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_KEEP = "line_key, l_returnflag, l_linestatus, l_quantity, l_extendedprice, l_discount, l_tax"
SPLIT_LINES = split_sql(LINES, "l_returnflag", "line_key", "'42'", keep=_KEEP)


def kept_lines(spark, sf):
    return lines(spark, sf).select(*_KEEP.split(", "))


def split_lines(spark, sf):
    return split.stratified_split(kept_lines(spark, sf), "l_returnflag", "line_key")


@query(f"""
  WITH s AS ({SPLIT_LINES}), t AS (SELECT * FROM s WHERE split = 'train')
  SELECT c AS "column", round(m, 4) AS mean, round(d, 4) AS std FROM (
    {" UNION ALL ".join(f"SELECT '{c}' AS c, avg({c}) AS m, stddev_pop({c}) AS d FROM t" for c in NUMBERS)})
""")
def fit_scaler(spark, sf):
    train = split_lines(spark, sf).filter("split = 'train'")
    return ops.fit_scaler(train, NUMBERS).select("column", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"))


@query(f"""
  WITH s AS ({SPLIT_LINES}),
       p AS (SELECT {", ".join(f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in NUMBERS)} FROM s WHERE split = 'train')
  SELECT line_key, {", ".join(f"round((s.{c} - p.{c}_m) / p.{c}_s, 4) AS {c}" for c in NUMBERS)}
  FROM s, p WHERE split = 'test'
""")
def apply_scaler(spark, sf):
    parts = split_lines(spark, sf)
    params = ops.fit_scaler(parts.filter("split = 'train'"), NUMBERS)
    done = ops.apply_scaler(parts.filter("split = 'test'"), params, NUMBERS)
    return done.select("line_key", *[F.round(c, 4).alias(c) for c in NUMBERS])


@query("""
  SELECT 'o_orderpriority' AS "column", CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS idx, v AS category
  FROM (SELECT DISTINCT o_orderpriority AS v FROM orders)
  UNION ALL
  SELECT 'o_orderstatus', CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER), v FROM (SELECT DISTINCT o_orderstatus AS v FROM orders)
""")
def fit_one_hot(spark, sf):
    return ops.fit_one_hot(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


_STATUS = ["F", "O", "P"]
_PRIORITY = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(f"""
  SELECT o_orderkey,
    {", ".join(f"CAST(o_orderstatus = '{v}' AS DOUBLE) AS " + chr(34) + f"o_orderstatus_{v}" + chr(34) for v in _STATUS)},
    {", ".join(f"CAST(o_orderpriority = '{v}' AS DOUBLE) AS " + chr(34) + f"o_orderpriority_{v}" + chr(34) for v in _PRIORITY)}
  FROM orders
""")
def apply_one_hot(spark, sf):
    orders = table(spark, sf, "orders")
    fitted = ops.fit_columns(orders, numeric=[], categorical=["o_orderstatus", "o_orderpriority"])
    return ops.apply_one_hot(orders, fitted, keep=["o_orderkey"])


@query("""SELECT c_custkey, c_name AS category, CAST(1.0 AS DOUBLE) AS value FROM customer""")
def indicator_map(spark, sf):
    c = table(spark, sf, "customer")
    hot = ops.indicator_map(c, ops.distinct_categories(c, "c_name"), "c_name")
    return hot.select("c_custkey", F.explode("c_name_hot").alias("category", "value"))


_TYPES = ["click", "error", "purchase", "signup", "view"]


@query(f"""
  SELECT event_id, CAST(list_position({_TYPES!r}, event_type) - 1 AS INTEGER) AS code, event_type AS label FROM events
""")
def encode_label(spark, sf):
    coded = table(spark, sf, "events").select("event_id", arrays.encode_label("event_type", _TYPES).alias("code"))
    return coded.select("event_id", "code", arrays.decode_label("code", _TYPES).alias("label"))


_INDICATORS = ["l_linestatus_F", "l_linestatus_O", "l_returnflag_A", "l_returnflag_N", "l_returnflag_R"]
_FOLDS = f"SELECT {_KEEP}, fold FROM (SELECT * FROM ({SPLIT_LINES}) z WHERE split = 'train') a, (SELECT unnest([1, 2, 3]) AS fold) f"
_FOLD_SQL = split_sql(_FOLDS, "l_returnflag", "line_key",
                      "concat_ws('|', '41', r.fold_)", fold="fold", keep="fold, " + _KEEP, other="validation")


def _folded(spark, sf):
    parts = split.split_and_fold(kept_lines(spark, sf), "l_returnflag", "line_key")
    return parts.filter("split <> 'test'")


@query(f"""
  WITH v AS ({_FOLD_SQL}),
       p AS (SELECT fold, {", ".join(f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in NUMBERS)}
             FROM v WHERE split = 'train' GROUP BY fold)
  SELECT v.fold, v.split, l_linestatus, l_returnflag, count(*) AS n,
         {", ".join(f"round(avg((v.{c} - p.{c}_m) / p.{c}_s), 4) AS {c}" for c in NUMBERS)},
         {", ".join(f"round(max((v.{c} - p.{c}_m) / p.{c}_s), 4) AS {c}_max" for c in NUMBERS)},
         CAST(sum(CAST(l_linestatus = 'F' AS DOUBLE)) AS DOUBLE) AS "l_linestatus_F",
         CAST(sum(CAST(l_linestatus = 'O' AS DOUBLE)) AS DOUBLE) AS "l_linestatus_O",
         CAST(sum(CAST(l_returnflag = 'A' AS DOUBLE)) AS DOUBLE) AS "l_returnflag_A",
         CAST(sum(CAST(l_returnflag = 'N' AS DOUBLE)) AS DOUBLE) AS "l_returnflag_N",
         CAST(sum(CAST(l_returnflag = 'R' AS DOUBLE)) AS DOUBLE) AS "l_returnflag_R"
  FROM v JOIN p ON v.fold = p.fold GROUP BY v.fold, v.split, l_linestatus, l_returnflag
""")
def column_transform(spark, sf):
    rows = _folded(spark, sf).withColumn("_status", F.col("l_linestatus")).withColumn("_flag", F.col("l_returnflag"))
    done, _ = ops.fit_transform_columns(rows, "l_returnflag", keep=["line_key", "_status", "_flag"])
    return done.groupBy("fold", "split", F.col("_status").alias("l_linestatus"), F.col("_flag").alias("l_returnflag")).agg(
        F.count("*").alias("n"),
        *[F.round(F.avg(c), 4).alias(c) for c in NUMBERS],
        *[F.round(F.max(c), 4).alias(f"{c}_max") for c in NUMBERS],
        *[F.sum(c).alias(c) for c in _INDICATORS])


@query(f"""
  WITH s AS ({SPLIT_LINES}),
       p AS (SELECT {", ".join(f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in NUMBERS)} FROM s WHERE split = 'train')
  SELECT line_key, {", ".join(f"round((s.{c} - p.{c}_m) / p.{c}_s, 4) AS {c}" for c in NUMBERS)},
         CAST(l_linestatus = 'F' AS DOUBLE) AS "l_linestatus_F", CAST(l_linestatus = 'O' AS DOUBLE) AS "l_linestatus_O"
  FROM s, p WHERE split = 'test'
""")
def transform_with(spark, sf):
    parts = split_lines(spark, sf)
    fitted = ops.fit_columns(parts.filter("split = 'train'").drop("split"), "l_returnflag", numeric=NUMBERS, categorical=["l_linestatus"])
    done = ops.transform_with(parts.filter("split = 'test'"), fitted, keep=["line_key"])
    return done.select("line_key", *[F.round(c, 4).alias(c) for c in NUMBERS], "l_linestatus_F", "l_linestatus_O")
