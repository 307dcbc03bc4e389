"""Thousands of event rules matched at once on the driver's events, in a table and in a running query."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.catalog import query, scratch, table
from rowsentry.operators import rules as ops
from rowsentry.streaming import events as event_streams

_TYPES = ["click", "error", "purchase", "signup", "view"]


def _rules(spark, sf):
    """A rule for each user (some types of events, and for every third user some numbers) and one for each number and type."""
    users = table(spark, sf, "events").select("user_id").distinct()
    types = F.array(*[F.lit(t) for t in _TYPES])
    u = F.col("user_id")
    name = F.concat(F.lit("user-"), u)

    def rows(source, rule, path, values):
        return source.select(rule.alias("rule"), F.lit(path).alias("path"), F.explode(values).alias("value"))

    kinds = F.array(F.element_at(types, (u % 5 + 1).cast("int")), F.element_at(types, ((u + 1) % 5 + 1).cast("int")))
    numbers = F.transform(F.sequence(F.lit(0), F.lit(39)), lambda i: ((u + i) % 100).cast("string"))
    grid = spark.range(100).select(F.col("id").cast("string").alias("k")).withColumn("type", F.explode(types))
    both = F.concat_ws("-", F.lit("number"), "k", "type")
    return (rows(users, name, "user_id", F.array(u.cast("string")))
            .unionByName(rows(users, name, "event_type", kinds))
            .unionByName(rows(users.filter("user_id % 3 = 0"), name, "k", numbers))
            .unionByName(rows(grid, both, "k", F.array("k"))).unionByName(rows(grid, both, "event_type", F.array("type"))))


_MATCHES = f"""
  WITH e AS (SELECT event_id, user_id, event_type, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events)
  SELECT event_id, 'user-' || user_id AS rule FROM e
  WHERE event_type IN ({_TYPES!r}[user_id % 5 + 1], {_TYPES!r}[(user_id + 1) % 5 + 1])
    AND (user_id % 3 <> 0 OR (k < 100 AND (k - user_id % 100 + 100) % 100 < 40))
  UNION ALL SELECT event_id, 'number-' || k || '-' || event_type FROM e WHERE k < 100
"""


@query(_MATCHES)
def match_rules(spark, sf):
    return ops.match_rules(table(spark, sf, "events"), _rules(spark, sf), "props").select("event_id", "rule")


@query(_MATCHES)
def stream_match_rules(spark, sf):
    """The same matches handed on by a running query."""
    out = scratch(spark)
    arriving = spark.readStream.schema(table(spark, sf, "events").schema).parquet(f"{sf}/[e]vents.parquet")

    def act(batch, batch_id: int) -> None:
        batch.select("event_id", "rule").write.mode("overwrite").parquet(f"{out}/rows/batch={batch_id}")

    event_streams.start_rules(arriving, _rules(spark, sf), act, f"{out}/progress", "props").awaitTermination()
    return spark.read.schema("event_id BIGINT, rule STRING, batch INT").parquet(f"{out}/rows").drop("batch")
