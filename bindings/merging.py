"""Predictions and late labels, monitors, registry and deployments on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.catalog import query, table
from rowsentry.operators import merge, monitors, registry, train
from rowsentry.streaming.merging import stream_merge_ground_truth


def number():
    """The number ``k`` in the props of an event."""
    return F.get_json_object("props", "$.k").cast("int")


K_SQL = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER)"


def _documents(spark, sf):
    return table(spark, sf, "documents").select(F.col("doc_id").alias("inference_id"), "lang", "n_chars")


def _labels(spark, sf):
    return table(spark, sf, "labels").select(F.col("doc_id").alias("inference_id"), F.col("quality").alias("truth"))


@query("""SELECT d.doc_id AS inference_id, lang, n_chars, quality AS truth FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def merge_ground_truth(spark, sf):
    return merge.merge_ground_truth(_documents(spark, sf), _labels(spark, sf))


@query("""SELECT doc_id AS inference_id, lang, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def unmatched_predictions(spark, sf):
    return merge.unmatched_predictions(_documents(spark, sf), _labels(spark, sf))


@query("""
  SELECT count(*) AS captured, count(l.doc_id) AS labelled, round(count(l.doc_id) / count(*), 6) AS coverage
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def label_coverage(spark, sf):
    out = merge.label_coverage(_documents(spark, sf), _labels(spark, sf))
    return out.select("captured", "labelled", F.round("coverage", 6).alias("coverage"))


@query("""
  SELECT user_id AS inference_id, ts, event_id, event_type AS truth
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1
""")
def latest_labels(spark, sf):
    sent = table(spark, sf, "events").select(F.col("user_id").alias("inference_id"), "ts", "event_id", F.col("event_type").alias("truth"))
    return merge.latest_labels(sent, order="ts")


@query("""
  SELECT o_orderkey, o_custkey AS inference_id, event_type AS truth
  FROM orders o JOIN (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) e
    ON o.o_custkey = e.user_id AND r = 1
""")
def merge_repeated_ids(spark, sf):
    """Ids repeat on both sides: the last event of a user labels all orders of the same number."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("inference_id"))
    sent = table(spark, sf, "events").select(F.col("user_id").alias("inference_id"), "ts", "event_id", F.col("event_type").alias("truth"))
    return merge.merge_ground_truth(orders, sent, order="ts").select("o_orderkey", "inference_id", "truth")


def _delayed(spark, sf):
    """Every event as a capture, and its label k minutes later."""
    e = table(spark, sf, "events")
    captured = e.select(F.col("event_id").alias("inference_id"), F.col("ts").cast("timestamp").alias("ts"))
    sent = (F.col("ts").cast("timestamp") + F.make_dt_interval(mins=number())).alias("gt_ts")
    labels = e.select(F.col("event_id").alias("inference_id"), sent, F.col("event_type").alias("truth"))
    return captured, labels


@query(f"""SELECT event_id AS inference_id, event_type AS truth FROM events WHERE {K_SQL} <= 60""")
def merge_within_delay(spark, sf):
    return stream_merge_ground_truth(*_delayed(spark, sf)).select("inference_id", "truth")


@query(f"""SELECT event_id AS inference_id, event_type AS truth FROM events WHERE {K_SQL} > 60""")
def late_records(spark, sf):
    captured, labels = _delayed(spark, sf)
    emitted = stream_merge_ground_truth(captured, labels)
    return merge.late_records(merge.merge_ground_truth(captured, labels), emitted).select("inference_id", "truth")


def _runs(spark, sf):
    status = F.when(F.col("event_type") == "error", "CompletedWithViolations").when(number() < 50, "Completed").otherwise("Failed")
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("endpoint"), F.col("event_type").alias("type"),
        F.col("event_id").alias("run_id"), status.alias("last_status"), F.col("ts").alias("last_ts"), number().alias("k"))


_STATUS = f"""CASE WHEN event_type = 'error' THEN 'CompletedWithViolations' WHEN {K_SQL} < 50 THEN 'Completed' ELSE 'Failed' END"""


@query(f"""
  SELECT endpoint, type, run_id, last_status, last_ts, n_runs FROM (
    SELECT CAST(user_id AS VARCHAR) AS endpoint, event_type AS type, event_id AS run_id, {_STATUS} AS last_status, ts AS last_ts,
           count(*) OVER (PARTITION BY user_id, event_type) AS n_runs,
           row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1
""")
def monitor_status(spark, sf):
    return monitors.monitor_status(_runs(spark, sf))


@query(f"""
  SELECT CAST(user_id AS VARCHAR) AS endpoint, event_type AS type, e.event_id AS run_id, {_STATUS} AS last_status, v.name AS violation, v.detail
  FROM events e LEFT JOIN (SELECT event_id, 'value' AS name, 'k ' || {K_SQL} AS detail FROM events WHERE {K_SQL} > 10
                           UNION ALL SELECT event_id, 'props', 'k ' || {K_SQL} FROM events WHERE {K_SQL} > 70) v
    ON e.event_id = v.event_id AND e.event_type = 'error'
  WHERE event_type IN ('error', 'purchase')
""")
def monitor_report(spark, sf):
    runs = _runs(spark, sf)
    detail = F.concat(F.lit("k "), F.col("k").cast("string"))
    names = F.filter(F.array(F.when(F.col("k") > 10, F.lit("value")), F.when(F.col("k") > 70, F.lit("props"))), lambda x: x.isNotNull())
    found = runs.select("run_id", F.explode(names).alias("violation"), detail.alias("detail"))
    report = monitors.monitor_report(runs, found, types=["error", "purchase"])
    return report.select("endpoint", "type", "run_id", "last_status", "violation", "detail")


_WANTED = ["purchase", "signup", "audit"]


@query(f"""
  SELECT endpoint, type FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS endpoint FROM events), (SELECT unnest({_WANTED!r}) AS type)
  WHERE (endpoint, type) NOT IN (SELECT (CAST(user_id AS VARCHAR), event_type) FROM events WHERE value > 100)
""")
def missing_monitors(spark, sf):
    existing = table(spark, sf, "events").filter("value > 100").select(
        F.col("user_id").cast("string").alias("endpoint"), F.col("event_type").alias("type"))
    return monitors.missing_monitors(monitors.required_monitors(_runs(spark, sf), _WANTED), existing)


@query(f"""
  SELECT endpoint, type, (endpoint, type) IN (SELECT (CAST(user_id AS VARCHAR), event_type) FROM events WHERE value > 100) AS found
  FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS endpoint FROM events), (SELECT unnest({_WANTED!r}) AS type)
""")
def found_monitors(spark, sf):
    existing = table(spark, sf, "events").filter("value > 100").select(
        F.col("user_id").cast("string").alias("endpoint"), F.col("event_type").alias("type"))
    return monitors.found_monitors(monitors.required_monitors(_runs(spark, sf), _WANTED), existing)


@query("""
  SELECT user_id AS model_group, event_id, ts,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS version, 'PendingManualApproval' AS status FROM events
""")
def register_version(spark, sf):
    entries = table(spark, sf, "events").select(F.col("user_id").alias("model_group"), "event_id", "ts")
    return registry.register_version(None, entries, "model_group", ["ts", "event_id"], F.to_date("ts"))


@query("""
  SELECT n.user_id AS model_group, n.event_id, coalesce(top, 0) + row_number() OVER (PARTITION BY n.user_id ORDER BY n.ts, n.event_id) AS version,
         'PendingManualApproval' AS status
  FROM events n LEFT JOIN (SELECT user_id, count(*) AS top FROM events WHERE ts < TIMESTAMP '2024-01-10' GROUP BY user_id) o ON n.user_id = o.user_id
  WHERE n.ts >= TIMESTAMP '2024-01-10'
""")
def register_next_versions(spark, sf):
    entries = table(spark, sf, "events").select(F.col("user_id").alias("model_group"), "event_id", "ts")
    cut = F.lit("2024-01-10").cast("timestamp_ntz")
    known = registry.register_version(None, entries.filter(F.col("ts") < cut), "model_group", ["ts", "event_id"], F.to_date("ts"))
    fresh = entries.filter(F.col("ts") >= cut)
    return registry.register_version(known, fresh, "model_group", ["ts", "event_id"], F.to_date("ts")).drop("ts")


def _approvals(spark, sf):
    """Purchases approve artifact ``event_id`` for the endpoint of their user."""
    return table(spark, sf, "events").select(F.col("user_id").alias("endpoint"), F.col("event_id").alias("artifact"), "ts",
                                             F.col("event_type").alias("status"))


_APPROVED = """
  SELECT endpoint, artifact, ts FROM (
    SELECT user_id AS endpoint, event_id AS artifact, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r
    FROM events WHERE event_type = 'purchase') WHERE r = 1"""


@query(_APPROVED)
def latest_approved(spark, sf):
    return registry.latest_approved(_approvals(spark, sf), "endpoint", "artifact", ["ts", "artifact"], approved="purchase")


_CURRENT = "SELECT user_id AS endpoint, min(event_id) AS artifact, 'first' AS config FROM events WHERE event_type = 'signup' GROUP BY user_id"


@query(f"""
  SELECT coalesce(c.endpoint, a.endpoint) AS endpoint, coalesce(a.artifact, c.artifact) AS artifact,
         CASE WHEN a.endpoint IS NULL THEN c.config ELSE a.endpoint || '-config-' || strftime(a.ts, '%m%d%H%M%S') END AS config,
         CASE WHEN a.endpoint IS NULL THEN 'unchanged' WHEN c.endpoint IS NULL THEN 'created' ELSE 'updated' END AS action
  FROM ({_CURRENT}) c FULL JOIN ({_APPROVED}) a ON c.endpoint = a.endpoint
""")
def deployment_upsert(spark, sf):
    approved = registry.latest_approved(_approvals(spark, sf), "endpoint", "artifact", ["ts", "artifact"], approved="purchase")
    current = (
        _approvals(spark, sf).filter("status = 'signup'").groupBy("endpoint")
        .agg(F.min("artifact").alias("artifact")).withColumn("config", F.lit("first"))
    )
    return registry.deployment_upsert(current, approved)


def _baselines(spark, sf):
    e = table(spark, sf, "events")
    registered = e.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("version"), F.col("value").alias("floor"))
    calculated = e.filter("event_type = 'click'").groupBy("user_id").agg(F.max("value").alias("floor"))
    return registered, calculated


def _baseline_sql(first: str, second: str, a: str, b: str) -> str:
    return f"""
      SELECT coalesce(o.user_id, n.user_id) AS user_id, coalesce({first}.floor, {second}.floor) AS floor,
             CASE WHEN {first}.floor IS NOT NULL THEN '{a}' ELSE '{b}' END AS source
      FROM (SELECT user_id, arg_max(value, event_id) AS floor FROM events WHERE event_type = 'view' GROUP BY user_id) o
      FULL JOIN (SELECT user_id, max(value) AS floor FROM events WHERE event_type = 'click' GROUP BY user_id) n ON o.user_id = n.user_id"""


@query(_baseline_sql("n", "o", "calculated", "registered"))
def baseline_version(spark, sf):
    return registry.drift_check_baselines(*_baselines(spark, sf), "user_id", "floor")


@query(_baseline_sql("o", "n", "registered", "calculated"))
def baseline_version_kept(spark, sf):
    return registry.drift_check_baselines(*_baselines(spark, sf), "user_id", "floor", register_new=False)


@query("""
  SELECT nation, trial, val_accuracy, rank FROM (
    SELECT s_nationkey AS nation, s_suppkey AS trial, s_acctbal AS val_accuracy,
           CAST(row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) - 1 AS INTEGER) AS rank FROM supplier) WHERE rank <= 2
""")
def top_models(spark, sf):
    trials = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("trial"),
                                                 F.col("s_acctbal").alias("val_accuracy"))
    return train.top_models(trials, 2, by="nation")


@query("""
  SELECT s_suppkey AS trial, s_acctbal AS val_accuracy, CAST(0 AS INTEGER) AS rank FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 1
""")
def best_model(spark, sf):
    trials = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("trial"), F.col("s_acctbal").alias("val_accuracy"))
    return train.top_models(trials)


def _log_lines(spark, sf):
    parts = [F.lit("Epoch 1 - loss: "), F.col("event_id").cast("string"), F.lit(".5 - accuracy: 0."), number().cast("string"),
             F.lit(" - val_loss: 1."), number().cast("string"), F.lit(" - val_accuracy: 0."), F.col("user_id").cast("string")]
    return table(spark, sf, "events").select("event_id", F.concat(*parts).alias("line"))


_LOG_ROWS = f"""(SELECT event_id, '1.' || {K_SQL} AS vl, '0.' || {K_SQL} AS a, '0.' || user_id AS va, event_id || '.5' AS l FROM events)"""


@query(f"""
  SELECT event_id, name, CAST(position AS INTEGER) AS position, CAST(v AS DOUBLE) AS value FROM (
    SELECT event_id, 'loss' AS name, 0 AS position, l AS v FROM {_LOG_ROWS} UNION ALL
    SELECT event_id, 'loss', 1, vl FROM {_LOG_ROWS} UNION ALL
    SELECT event_id, 'accuracy', 0, a FROM {_LOG_ROWS} UNION ALL
    SELECT event_id, 'accuracy', 1, va FROM {_LOG_ROWS} UNION ALL
    SELECT event_id, 'val_accuracy', 0, va FROM {_LOG_ROWS})
""")
def extract_log_metrics(spark, sf):
    return train.extract_log_metrics(_log_lines(spark, sf))


@query(f"""
  SELECT event_id, name, CAST(0 AS INTEGER) AS position, CAST(v AS DOUBLE) AS value FROM (
    SELECT event_id, 'loss' AS name, l AS v FROM {_LOG_ROWS} UNION ALL
    SELECT event_id, 'accuracy', a FROM {_LOG_ROWS} UNION ALL
    SELECT event_id, 'val_accuracy', va FROM {_LOG_ROWS})
""")
def extract_log_metrics_words(spark, sf):
    return train.extract_log_metrics(_log_lines(spark, sf), word_boundary=True)
