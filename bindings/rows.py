"""Sources, projections and filters on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.catalog import query, table
from rowsentry.functions.text import csv_line, drop_trailing_label as cut_label
from rowsentry.functions.times import ground_truth_path as path_of
from rowsentry.operators import rows as ops
from rowsentry.operators.scoring import answer_requests
from rowsentry.sources import requests as req, responses as res
from rowsentry.sources.captures import ground_truth_event


@query("""
  SELECT CAST(o_orderkey AS DOUBLE) AS o_orderkey, CAST(o_custkey AS DOUBLE) AS o_custkey,
         o_orderstatus, o_orderpriority, o_totalprice
  FROM orders
  WHERE o_orderstatus <> 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AND o_totalprice IS NOT NULL
""")
def clean_rows(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    return ops.clean_rows(orders, ["P"], {"o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM"]})


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def split_features_label(spark, sf):
    return ops.split_features_label(table(spark, sf, "customer"), "c_mktsegment")[0]


@query("SELECT c_mktsegment FROM customer")
def split_label_only(spark, sf):
    return ops.split_features_label(table(spark, sf, "customer"), "c_mktsegment")[1]


@query("SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def concat_columns(spark, sf):
    c = table(spark, sf, "customer")
    return ops.concat_columns(c.select("c_custkey", "c_name", "c_acctbal"), c.select("c_custkey", "c_mktsegment"), "c_custkey")


@query("SELECT p_partkey AS id, p_name AS a, p_brand AS b, p_type AS c, p_size AS d, p_retailprice AS e FROM part")
def rename_by_position(spark, sf):
    return ops.rename_by_position(table(spark, sf, "part"), ["id", "a", "b", "c", "d", "e"])


@query("SELECT p_type, p_size, p_retailprice FROM part")
def tail_columns(spark, sf):
    return ops.tail_columns(table(spark, sf, "part"), 3)


@query("SELECT p_partkey, p_name, p_brand FROM part")
def head_columns(spark, sf):
    return ops.tail_columns(table(spark, sf, "part"), 3, rest=True)


@query("""SELECT CAST(p_partkey AS DOUBLE) AS p_partkey, CAST(p_size AS DOUBLE) AS p_size, p_retailprice FROM part""")
def select_by_dtype(spark, sf):
    return ops.select_by_dtype(table(spark, sf, "part"), "numeric")


@query("SELECT p_name, p_brand, p_type FROM part")
def select_by_dtype_text(spark, sf):
    return ops.select_by_dtype(table(spark, sf, "part"), "categorical")


def _csv_bodies(spark, sf):
    """Two lines per order, the second one with a trailing label, blanks and blank lines around."""
    o = table(spark, sf, "orders")
    first = csv_line("o_orderkey", "o_orderstatus", "o_custkey", "o_orderpriority")
    second = F.concat(F.lit("  "), csv_line("o_custkey", "o_orderpriority", "o_orderkey", "o_orderstatus"), F.lit(", label"))
    body = F.concat(F.lit("\n "), first, F.lit("\n\n"), second, F.lit("\n"))
    return o.select(F.col("o_orderkey").cast("string").alias("inference_id"), body.alias("body"))


_REQUEST_DDL = "a BIGINT, b STRING, c BIGINT, d STRING"


@query("""
  SELECT CAST(o_orderkey AS VARCHAR) AS inference_id, 0 AS row_no, 2 AS n_rows, o_orderkey AS a, o_orderstatus AS b,
         o_custkey AS c, o_orderpriority AS d, CAST(NULL AS VARCHAR) AS error FROM orders
  UNION ALL
  SELECT CAST(o_orderkey AS VARCHAR), 1, 2, o_custkey, o_orderpriority, o_orderkey, o_orderstatus, NULL FROM orders
""")
def csv_requests(spark, sf):
    return req.parse_csv_requests(_csv_bodies(spark, sf), _REQUEST_DDL)


@query("""
  SELECT error, count(*) AS n FROM (
    SELECT CASE WHEN event_type = 'click' THEN 'No input data received.'
                WHEN event_type = 'view' THEN 'Expected 4 values, got 2.'
                WHEN event_type = 'error' THEN 'The input could not be read.'
                ELSE NULL END AS error FROM events)
  GROUP BY error
""")
def csv_request_errors(spark, sf):
    e = table(spark, sf, "events")
    kind = F.col("event_type")
    body = (
        F.when(kind == "click", F.lit(None).cast("string"))
        .when(kind == "view", csv_line("event_id", "user_id"))
        .when(kind == "error", csv_line("event_type", "event_type", "user_id", "event_type"))
        .otherwise(csv_line("event_id", "event_type", "user_id", "event_type"))
    )
    parsed = req.parse_csv_requests(e.select("event_id", body.alias("body")), _REQUEST_DDL)
    return parsed.groupBy("error").agg(F.count("*").alias("n"))


@query("""
  SELECT event_id, 0 AS row_no, 1 AS n_rows, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS error
  FROM events
""")
def json_requests(spark, sf):
    return req.parse_json_requests(table(spark, sf, "events").select("event_id", "props"), "k BIGINT", body="props")


@query("""
  SELECT route, error, count(*) AS n FROM (
    SELECT CASE event_type WHEN 'click' THEN 'csv' WHEN 'view' THEN 'json' ELSE 'rejected' END AS route,
           CASE WHEN event_type IN ('click', 'view') THEN NULL
                ELSE 'Content type ' || event_type || ' is not supported.' END AS error
    FROM events)
  GROUP BY route, error
""")
def content_type_routing(spark, sf):
    kind = F.col("event_type")
    ct = F.when(kind == "click", "text/csv").when(kind == "view", "application/json").otherwise(kind)
    routed = req.route_by_content_type(table(spark, sf, "events").select("event_id", ct.alias("content_type")))
    return routed.groupBy("route", "error").agg(F.count("*").alias("n"))


@query("""
  SELECT event_id, 0 AS row_no, 1 AS n_rows,
         CASE WHEN event_type IN ('click', 'view') THEN CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) END AS k,
         CASE WHEN event_type IN ('click', 'view') THEN NULL
              ELSE 'Content type ' || event_type || ' is not supported.' END AS error
  FROM events
""")
def parse_requests(spark, sf):
    kind = F.col("event_type")
    ct = F.when(kind == "click", "text/csv").when(kind == "view", "application/json").otherwise(kind)
    number = F.get_json_object("props", "$.k")
    body = F.when(kind == "click", number).otherwise(F.col("props"))
    mixed = table(spark, sf, "events").select("event_id", ct.alias("content_type"), body.alias("body"))
    return req.parse_requests(mixed, "k BIGINT").drop("content_type")


@query("""
  SELECT c_custkey, concat_ws(',', c_custkey, c_name, c_nationkey) AS line FROM customer
""")
def drop_trailing_label(spark, sf):
    c = table(spark, sf, "customer")
    labelled = F.when(F.col("c_nationkey") > 12, csv_line("c_custkey", "c_name", "c_nationkey", "c_mktsegment"))
    line = F.coalesce(labelled, csv_line("c_custkey", "c_name", "c_nationkey"))
    return c.select("c_custkey", F.array_join(cut_label(F.split(line, ","), 3), ",").alias("line"))


@query("""
  SELECT c_custkey, '00' AS key, CAST(c_custkey AS VARCHAR) AS value FROM customer
  UNION ALL SELECT c_custkey, '01', c_name FROM customer
  UNION ALL SELECT c_custkey, '02', CAST(c_nationkey AS VARCHAR) FROM customer
  UNION ALL SELECT c_custkey, '03', c_mktsegment FROM customer
""")
def record_to_map(spark, sf):
    c = table(spark, sf, "customer")
    lines = c.select("c_custkey", csv_line("c_custkey", "c_name", "c_nationkey", "c_mktsegment").alias("input"))
    return ops.with_record_hook(lines).select("c_custkey", F.explode("record").alias("key", "value"))


@query("SELECT c_custkey AS a, c_name AS b, CAST(c_nationkey AS DOUBLE) AS c FROM customer")
def record_columns(spark, sf):
    lines = table(spark, sf, "customer").select(csv_line("c_custkey", "c_name", "c_nationkey").alias("input"))
    return ops.record_columns(ops.with_record_hook(lines), "a BIGINT, b STRING, c DOUBLE").select("a", "b", "c")


@query("""
  SELECT event_id, event_type FROM events
  WHERE event_type IN ('purchase', 'signup') AND regexp_extract(props, '([0-9]+)', 1) IN ('1', '2', '3', '5', '8', '13')
""")
def event_pattern_filter(spark, sf):
    pattern = {"event_type": ["purchase", "signup"], "k": [1, 2, 3, 5, 8, 13]}
    return ops.event_pattern_filter(table(spark, sf, "events"), pattern, "props").select("event_id", "event_type")


@query("""
  SELECT CAST(o_orderkey AS VARCHAR) AS inference_id,
         concat_ws(',', o_custkey, o_orderstatus, o_orderpriority) AS body FROM orders
""")
def request_lines(spark, sf):
    return req.to_request_lines(table(spark, sf, "orders"), "o_orderkey", ["o_custkey", "o_orderstatus", "o_orderpriority"])


@query("""SELECT event_id, 'labels/' || strftime(ts, '%Y/%m/%d/%H/%M%S') || '.jsonl' AS path FROM events""")
def ground_truth_path(spark, sf):
    return table(spark, sf, "events").select("event_id", path_of("ts", "labels").alias("path"))


@query("""
  SELECT '{"groundTruthData":{"data":"' || quality || '","encoding":"CSV"},"eventMetadata":{"eventId":"' || doc_id
         || '"},"eventVersion":"0"}' AS event FROM labels
""")
def ground_truth_events(spark, sf):
    return table(spark, sf, "labels").select(ground_truth_event(F.col("doc_id"), F.col("quality")).alias("event"))


@query("""
  SELECT vec_id, 0 AS row_no, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS code,
         CAST(len(embedding) AS INTEGER) AS width, CAST(NULL AS VARCHAR) AS error FROM embeddings
""")
def model_responses(spark, sf):
    from rowsentry.functions.arrays import argmax

    vectors = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    body = F.to_json(F.struct(F.array("v").alias("predictions")))
    sent = vectors.select("vec_id", body.alias("body"), F.lit("application/json").alias("content_type"))
    parsed = res.parse_model_response(sent)
    return parsed.select("vec_id", "row_no", argmax("probabilities").alias("code"), F.size("probabilities").alias("width"), "error")


@query("""
  SELECT CAST(o_custkey AS VARCHAR) AS request,
         '{"instances":[' || string_agg('[' || o_orderkey || '.0,' || o_custkey || '.0]', ',' ORDER BY o_orderkey) || ']}' AS body
  FROM orders GROUP BY o_custkey
""")
def render_instances(spark, sf):
    o = table(spark, sf, "orders").withColumn("request", F.col("o_custkey").cast("string"))
    return res.render_instances(o, ["o_orderkey", "o_custkey"], "request", "o_orderkey")


@query("""
  SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'text/csv' ELSE 'application/json' END AS accept,
         CASE WHEN event_id % 2 = 0 THEN event_type || ',' || (CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) / 4)
              ELSE '{"0":"' || event_type || '","1":' || (CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) / 4) || '}'
         END AS response, CAST(NULL AS VARCHAR) AS error
  FROM events
""")
def render_predictions(spark, sf):
    e = table(spark, sf, "events")
    even = F.col("event_id") % 2 == 0
    rows = e.select(
        "event_id", F.when(even, "text/csv").otherwise("application/json").alias("accept"), F.lit(0).alias("row_no"), F.lit(1).alias("n_rows"),
        F.col("event_type").alias("prediction"), (F.get_json_object("props", "$.k").cast("int") / 4).alias("confidence"))
    return res.render_predictions(rows, "event_id")


@query("""
  SELECT o_custkey, 'application/json' AS accept,
         CASE WHEN count(*) = 1 THEN '' ELSE '[' END
         || string_agg('{"0":"' || o_orderstatus || '","1":' || o_orderkey || '}', ',' ORDER BY o_orderkey)
         || CASE WHEN count(*) = 1 THEN '' ELSE ']' END AS response, CAST(NULL AS VARCHAR) AS error
  FROM orders GROUP BY o_custkey
""")
def render_prediction_lists(spark, sf):
    o = table(spark, sf, "orders").withColumn("accept", F.lit("application/json"))
    return res.render_predictions(o, "o_custkey", prediction="o_orderstatus", conf="o_orderkey", position="o_orderkey")


@query("""
  SELECT CAST(o_orderkey AS VARCHAR) AS inference_id, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority || ', "as is"' END AS note,
         CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey END AS customer FROM orders
""")
def request_nulls_round_trip(spark, sf):
    """Nulls, commas and quotes written as request lines and read back."""
    k = F.col("o_orderkey")
    o = table(spark, sf, "orders").select(
        k, F.when(k % 3 != 0, F.concat("o_orderpriority", F.lit(', "as is"'))).alias("note"), F.when(k % 5 != 0, F.col("o_custkey")).alias("customer"))
    back = req.parse_csv_requests(req.to_request_lines(o, "o_orderkey", ["note", "customer"]), "note STRING, customer BIGINT")
    return back.filter("error IS NULL").select("inference_id", "note", "customer")


@query("""
  SELECT CAST(event_id AS VARCHAR) AS inference_id,
         CASE WHEN event_type = 'view' THEN NULL WHEN event_type = 'click' THEN 'n' || k % 3 || ',' || k / 4 || chr(10) || 'n' || (k + 1) % 3 || ',' || (k + 1) / 4
              ELSE 'n' || k % 3 || ',' || k / 4 END AS response,
         CASE WHEN event_type = 'view' THEN 'The input could not be read.' END AS error
  FROM (SELECT event_id, event_type, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events)
""")
def request_answers_mixed(spark, sf):
    """Requests of one row, of two rows, and of two rows one of which cannot be read: each is answered once."""
    kind, k = F.col("event_type"), F.get_json_object("props", "$.k")
    second = F.when(kind == "click", (k.cast("bigint") + 1).cast("string")).when(kind == "view", F.lit("x"))
    sent = table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("inference_id"), F.lit("text/csv").alias("content_type"), F.lit("text/csv").alias("accept"),
        F.concat_ws("\n", k, second).alias("body"))
    good, bad = req.split_errors(req.parse_requests(sent, "k BIGINT"))
    scored = good.withColumn("prediction", F.concat(F.lit("n"), (F.col("k") % 3).cast("string"))).withColumn("confidence", F.col("k") / 4)
    answers = answer_requests(scored.drop("k", "content_type"), bad.drop("k", "content_type"))
    return answers.select("inference_id", "response", "error")
