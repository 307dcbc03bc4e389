"""Dictionaries of thousands of categories on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.catalog import query, table
from rowsentry.operators import dictionary, features as ops

_PRICES = "(SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS s FROM customer)"


@query(f"""
  SELECT c_custkey, CAST(1 + names + segments AS INTEGER) AS size,
         concat('0,', 1 + n.place, ',', 1 + names + s.place) AS indices, round((c_acctbal - p.m) / p.s, 4) AS scaled,
         CAST(2 AS BIGINT) AS ones
  FROM customer
  JOIN (SELECT c_name, row_number() OVER (ORDER BY c_name) - 1 AS place FROM (SELECT DISTINCT c_name FROM customer)) n USING (c_name)
  JOIN (SELECT c_mktsegment, row_number() OVER (ORDER BY c_mktsegment) - 1 AS place FROM (SELECT DISTINCT c_mktsegment FROM customer)) s USING (c_mktsegment),
  {_PRICES} p, (SELECT count(DISTINCT c_name) AS names, count(DISTINCT c_mktsegment) AS segments FROM customer)
""")
def sparse_customers(spark, sf):
    """A name of its own for every customer, one-hot: a place in a sparse row, no column and no list of names."""
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    fitted = ops.fit_columns(rows, numeric=["c_acctbal"], categorical=["c_name", "c_mktsegment"])
    cells = ops.sparse_cells(rows, fitted, keep=["c_custkey"])
    ones = F.size(F.filter("values", lambda v: v == 1.0)).cast("bigint")
    return cells.select("c_custkey", "size", F.array_join(F.col("indices").cast("array<string>"), ",").alias("indices"),
                        F.round(F.element_at("values", 1), 4).alias("scaled"), (ones - (F.element_at("values", 1) == 1.0).cast("bigint")).alias("ones"))


_KIND = "p_brand || '/' || p_size"


@query(f"""
  SELECT p_partkey, CAST(place AS INTEGER) AS place, CAST(1.0 AS DOUBLE) AS total
  FROM part JOIN (SELECT k, row_number() OVER (ORDER BY k) AS place FROM (SELECT DISTINCT {_KIND} AS k FROM part)) d ON {_KIND} = d.k
""")
def dense_parts(spark, sf):
    """Hundreds of indicator columns, filled by one join of the values to their places."""
    rows = table(spark, sf, "part").select("p_partkey", F.concat_ws("/", "p_brand", "p_size").alias("kind"))
    fitted = ops.fit_columns(rows, numeric=[], categorical=["kind"])
    wide = ops.transform_with(rows, fitted, keep=["p_partkey"])
    hot = F.array(*[F.col(f"`{n}`") for n in fitted.feature_names])
    return wide.select("p_partkey", hot.alias("hot")).select(
        "p_partkey", F.array_position("hot", 1.0).cast("int").alias("place"), F.aggregate("hot", F.lit(0.0), lambda a, x: a + x).alias("total"))


@query("""
  SELECT c_nationkey AS nation, c_name AS category,
         CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_name) - 1 AS INTEGER) AS place FROM customer
""")
def numbered_names(spark, sf):
    """Names numbered within each nation, in ranges of their order."""
    found = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_name").alias("category")).distinct()
    return dictionary.numbered(found, ["nation"])
