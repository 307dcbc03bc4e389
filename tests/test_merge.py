import pytest
from pyspark.sql import functions as F

from rowsentry.operators import merge, monitors, registry, sizing


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one id, and some without any."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id").cast("string"))
    return spark.range(3000).select("id", key.alias("k"))


@pytest.fixture(scope="module")
def right(spark):
    rows = [("hot", 1.0)] + [(str(i), float(i)) for i in range(0, 3000, 2)]
    return spark.createDataFrame(rows, "k STRING, v DOUBLE")


def brute(skewed, right, how):
    known = {r["k"]: r["v"] for r in right.collect()}
    rows = [(r["id"], r["k"]) for r in skewed.collect()]
    if how == "inner":
        return {(i, k, known[k]) for i, k in rows if k in known}
    if how == "left":
        return {(i, k, known.get(k)) for i, k in rows}
    if how == "left_semi":
        return {(i, k) for i, k in rows if k in known}
    return {(i, k) for i, k in rows if k not in known}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_join_unique_with_a_hot_key(skewed, right, how):
    hot = sizing.heavy_keys(skewed, F.col("k"))
    assert hot == ["hot"]
    for keys in (None, [], ["hot", "4", "none such"]):
        out = sizing.join_unique(skewed, right, "k", how, keys)
        names = ["id", "k"] + (["v"] if how in ("inner", "left") else [])
        got = [tuple(r) for r in out.select(*names).collect()]
        assert len(got) == len(set(got)) and set(got) == brute(skewed, right, how)


def test_hot_rows_are_not_shuffled_to_one_task(skewed, right):
    out = sizing.join_unique(skewed, right, "k", "inner")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "strategy=broadcast" in plan


def test_other_join_types_are_refused(skewed, right):
    with pytest.raises(ValueError):
        sizing.join_unique(skewed, right, "k", "full")


def test_settle_small_and_lookup(spark, skewed, right):
    table, size = sizing.settle_small(right, 5000)
    assert size == 1501 and {tuple(r) for r in table.collect()} == {tuple(r) for r in right.collect()}
    lazy, size = sizing.settle_small(right, 10)
    assert size is None and lazy is right
    assert sizing.lookup(skewed, right, "k").count() == sizing.lookup(skewed, right, "k", max_rows=10).count() == len(brute(skewed, right, "inner"))


def test_two_part_keys(spark):
    left = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (None, 1, "z")], "p STRING, q INT, v STRING")
    right = spark.createDataFrame([("a", 1, 10)], "p STRING, q INT, w INT")
    for hot in ([], ["a\x1f1"]):
        got = {(r["v"], r["w"]) for r in sizing.join_unique(left, right, ["p", "q"], "left", hot).collect()}
        assert got == {("x", 10), ("y", None), ("z", None)}


@pytest.fixture(scope="module")
def captured(spark):
    return spark.createDataFrame([("1", "Adelie"), ("2", "Gentoo"), ("3", "Gentoo"), (None, "Adelie")], "inference_id STRING, prediction STRING")


@pytest.fixture(scope="module")
def labels(spark):
    rows = [("1", "Adelie", 1), ("2", "Adelie", 1), ("2", "Gentoo", 2), ("9", "Gentoo", 1), (None, "Adelie", 5)]
    return spark.createDataFrame(rows, "inference_id STRING, truth STRING, seen INT")


def test_ground_truth_takes_the_latest_label(captured, labels):
    out = merge.merge_ground_truth(captured, labels, order="seen")
    assert {(r["inference_id"], r["truth"]) for r in out.collect()} == {("1", "Adelie"), ("2", "Gentoo")}


def test_unmatched_and_coverage(captured, labels):
    assert {r["inference_id"] for r in merge.unmatched_predictions(captured, labels).collect()} == {"3", None}
    assert tuple(merge.label_coverage(captured, labels).first()) == (4, 2, 0.5)


def test_late_records(captured, labels):
    merged = merge.merge_ground_truth(captured, labels, order="seen")
    assert [r["inference_id"] for r in merge.late_records(merged, merged.filter("inference_id = '1'")).collect()] == ["2"]


RUNS = [("e1", "DataQuality", "Completed", 1, "r1"), ("e1", "DataQuality", "CompletedWithViolations", 2, "r2"),
        ("e1", "ModelQuality", "Completed", 1, "r3"), ("e2", "DataQuality", "CompletedWithViolations", 1, "r4")]


@pytest.fixture(scope="module")
def runs(spark):
    return spark.createDataFrame(RUNS, "endpoint STRING, type STRING, last_status STRING, last_ts INT, run_id STRING")


def test_monitor_status_and_report(spark, runs):
    last = monitors.monitor_status(runs)
    assert {(r["endpoint"], r["type"], r["run_id"], r["n_runs"]) for r in last.collect()} == {
        ("e1", "DataQuality", "r2", 2), ("e1", "ModelQuality", "r3", 1), ("e2", "DataQuality", "r4", 1)}
    violations = spark.createDataFrame([("r2", "sex", "completeness"), ("r2", "mass", "non_negative"), ("r3", "x", "y"), ("r4", "a", "b")],
                                       "run_id STRING, column STRING, check STRING")
    report = monitors.monitor_report(last, violations, endpoint="e1")
    assert {(r["type"], r["column"]) for r in report.collect()} == {("DataQuality", "sex"), ("DataQuality", "mass"), ("ModelQuality", None)}
    assert monitors.monitor_report(last, violations, types="ModelQuality").count() == 1


def test_missing_monitors_match_whole_names(spark, runs):
    wanted = monitors.required_monitors(spark.createDataFrame([("e1",), ("e2",), ("e",)], "endpoint STRING"))
    assert {tuple(r) for r in monitors.missing_monitors(wanted, runs).collect()} == {
        ("e2", "ModelQuality"), ("e", "DataQuality"), ("e", "ModelQuality")}
    assert {r["found"] for r in monitors.found_monitors(wanted, runs).filter("endpoint = 'e1'").collect()} == {True}


def test_versions_go_on_from_the_highest(spark):
    entries = spark.createDataFrame([("g", 3, "c"), ("g", 1, "a"), ("h", 1, "x")], "model_group STRING, created INT, artifact STRING")
    first = registry.register_version(None, entries, "model_group", ["created"])
    assert {(r["model_group"], r["artifact"], r["version"]) for r in first.collect()} == {("g", "a", 1), ("g", "c", 2), ("h", "x", 1)}
    assert {r["status"] for r in first.collect()} == {"PendingManualApproval"}
    more = spark.createDataFrame([("g", 9, "e"), ("i", 1, "n")], "model_group STRING, created INT, artifact STRING")
    second = registry.register_version(first, more, "model_group", ["created"], bucket=F.col("created").cast("int"))
    assert {(r["model_group"], r["version"]) for r in second.collect()} == {("g", 3), ("i", 1)}
    assert registry.latest_version(first, "model_group").filter("model_group = 'g'").first()["artifact"] == "c"


def test_description_carries_types_and_links(spark):
    entry = spark.createDataFrame([("g",)], "model_group STRING")
    row = registry.describe_version(entry, "text", {"constraints": "p/c"}).first()
    assert row["content_types"] == ["text/csv", "application/json"] and row["constraints"] == "p/c" and row["task"] == "CLASSIFICATION"


def test_only_approved_events_deploy(spark):
    events = spark.createDataFrame([("g", "v1", 1, "Approved"), ("g", "v2", 2, "Rejected"), ("h", "v3", 3, "Rejected"), ("other", "v4", 4, "Approved")],
                                   "model_group STRING, arn STRING, time INT, status STRING")
    got = registry.latest_approved(events, "model_group", "arn", ["time", "arn"], groups=["g", "h"]).collect()
    assert [(r["model_group"], r["arn"]) for r in got] == [("g", "v1")]


def test_deployment_actions(spark):
    current = spark.createDataFrame([("a", "v1", "a-config-1"), ("keep", "v1", "keep-config-1"), ("new-long", "v1", "c")],
                                    "endpoint STRING, artifact STRING, config STRING")
    approved = spark.createDataFrame([("a", "v2", "2024-02-03 04:05:06"), ("new", "v9", "2024-02-03 04:05:06")],
                                     "endpoint STRING, artifact STRING, ts STRING").withColumn("ts", F.to_timestamp("ts"))
    got = {r["endpoint"]: tuple(r)[1:] for r in registry.deployment_upsert(current, approved).collect()}
    assert got == {"a": ("v2", "a-config-0203040506", "updated"), "new": ("v9", "new-config-0203040506", "created"),
                   "keep": ("v1", "keep-config-1", "unchanged"), "new-long": ("v1", "c", "unchanged")}
    nothing = registry.deployment_upsert(current, approved.limit(0))
    assert {r["action"] for r in nothing.collect()} == {"unchanged"}


def test_drift_baseline_choice(spark):
    registered = spark.createDataFrame([("g", 1, "old"), ("g", 2, "newer"), ("h", 1, "only")], "grp STRING, version INT, path STRING")
    calculated = spark.createDataFrame([("g", "now"), ("n", "first")], "grp STRING, path STRING")
    new = {r["grp"]: (r["path"], r["source"]) for r in registry.drift_check_baselines(registered, calculated, "grp", "path").collect()}
    assert new == {"g": ("now", "calculated"), "h": ("only", "registered"), "n": ("first", "calculated")}
    kept = {r["grp"]: (r["path"], r["source"]) for r in registry.drift_check_baselines(registered, calculated, "grp", "path", False).collect()}
    assert kept == {"g": ("newer", "registered"), "h": ("only", "registered"), "n": ("first", "calculated")}
