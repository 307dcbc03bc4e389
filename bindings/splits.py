"""Shuffles, samples, splits and folds on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.catalog import LINE_KEY_SQL, query, split_sql, table
from rowsentry.functions.keys import row_key
from rowsentry.operators import split as ops

LINES = f"SELECT *, {LINE_KEY_SQL} AS line_key FROM lineitem"


def lines(spark, sf):
    """lineitem with its text key."""
    key = row_key("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_shipdate").cast("date"))
    return table(spark, sf, "lineitem").withColumn("line_key", key)


@query("""
  SELECT o_orderkey, row_number() OVER (ORDER BY md5('42|' || o_orderkey), CAST(o_orderkey AS VARCHAR)) AS rank FROM orders
""")
def shuffle_rows(spark, sf):
    return ops.shuffle_rank(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


@query("""
  SELECT o_orderkey, o_orderstatus FROM orders
  WHERE CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 30
""")
def sample_percent(spark, sf):
    return ops.sample_percent(table(spark, sf, "orders"), 30, "o_orderkey").select("o_orderkey", "o_orderstatus")


@query(split_sql(LINES, "l_returnflag", "line_key", "'42'", keep="line_key, l_returnflag"))
def stratified_split(spark, sf):
    return ops.stratified_split(lines(spark, sf).select("line_key", "l_returnflag"), "l_returnflag", "line_key")


@query(split_sql("SELECT * FROM labels", "quality", "doc_id", "'42'", keep="doc_id, quality, toxic"))
def stratified_split_imbalanced(spark, sf):
    return ops.stratified_split(table(spark, sf, "labels"), "quality", "doc_id")


_FOLDED = "SELECT o_orderkey, o_orderstatus, fold FROM orders, (SELECT unnest([1, 2, 3]) AS fold) f"


@query(split_sql(_FOLDED, "o_orderstatus", "o_orderkey", "concat_ws('|', '41', r.fold_)", fold="fold",
                 keep="o_orderkey, o_orderstatus, fold", other="validation"))
def stratified_folds(spark, sf):
    return ops.stratified_folds(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", "o_orderkey")


_REST = f"""
  SELECT line_key, l_returnflag, l_orderkey, fold FROM ({split_sql(
      LINES, "l_returnflag", "line_key", "'42'", keep="line_key, l_returnflag, l_orderkey")}) a,
  (SELECT unnest([1, 2, 3]) AS fold) f WHERE a.split = 'train'"""


@query(f"""
  SELECT fold, split, l_returnflag, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS key_sum FROM (
    SELECT 0 AS fold, split, l_returnflag, l_orderkey FROM ({split_sql(
        LINES, "l_returnflag", "line_key", "'42'", keep="l_returnflag, l_orderkey")}) t WHERE split = 'test'
    UNION ALL
    SELECT fold, split, l_returnflag, l_orderkey FROM ({split_sql(
        _REST, "l_returnflag", "line_key", "concat_ws('|', '41', r.fold_)", fold="fold",
        keep="fold, l_returnflag, l_orderkey", other="validation")}) v
  ) GROUP BY fold, split, l_returnflag
""")
def split_and_fold(spark, sf):
    parts = ops.split_and_fold(lines(spark, sf).select("line_key", "l_returnflag", "l_orderkey"), "l_returnflag", "line_key")
    return parts.groupBy("fold", "split", "l_returnflag").agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("key_sum"))
