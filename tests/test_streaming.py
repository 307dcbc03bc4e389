from pyspark.sql import functions as F

from rowsentry.operators import evaluate, merge, quality
from rowsentry.plans import monitoring_run
from rowsentry.sources import captures, reports
from rowsentry.streaming import events, hourly, merging

START = 1704067200  # 2024-01-01 00:00:00 UTC


def at(seconds):
    return F.timestamp_seconds(F.lit(START) + seconds)


def captured(spark, n=600):
    """One prediction a minute."""
    return spark.range(n).select(
        F.col("id").cast("string").alias("inference_id"), at(F.col("id") * 60).alias("ts"),
        F.when(F.col("id") % 5 == 0, "a").otherwise("b").alias("prediction"), (F.col("id") % 7 - 1.0).alias("x"))


def labels(spark, n=600):
    """Each label up to 99 minutes after its prediction."""
    return spark.range(n).select(
        F.col("id").cast("string").alias("inference_id"), at(F.col("id") * 60 + (F.col("id") % 100) * 60).alias("gt_ts"),
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("truth"))


def as_stream(spark, df, path):
    df.write.parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


def closed(df, hours):
    return df.filter(F.col("window_start") < at(hours * 3600))


def test_hourly_profile_stream_equals_batch(spark, folder):
    rows = captured(spark)
    base = spark.createDataFrame([(1.0, "b")], "x DOUBLE, prediction STRING")
    constraints = quality.suggest_constraints(quality.profile_columns_exact(base), quality.value_histogram(base, ["prediction"]))
    query = hourly.start_data_quality(as_stream(spark, rows, f"{folder}/in"), ["x", "prediction"], constraints, f"{folder}/out", f"{folder}/ck")
    query.awaitTermination(180)
    assert query.exception() is None
    emitted = spark.read.parquet(f"{folder}/out/profile")
    batch = hourly.hourly_profile(rows, ["x", "prediction"], domains=quality.constraint_domains(constraints))
    hours = emitted.select("window_start").distinct().count()
    assert hours >= 8
    names = batch.columns
    assert emitted.select(*names).exceptAll(closed(batch, hours).select(*names)).isEmpty()
    assert emitted.count() == closed(batch, hours).count()
    got = spark.read.parquet(f"{folder}/out/violations")
    want = closed(hourly.hourly_violations(batch, constraints), hours)
    assert got.select(*want.columns).exceptAll(want).isEmpty() and got.count() == want.count() > 0


def test_stream_merge_and_hourly_metrics_equal_batch(spark, folder):
    left, right = captured(spark), labels(spark)
    merged = merging.stream_merge_ground_truth(as_stream(spark, left, f"{folder}/c"), as_stream(spark, right, f"{folder}/g"))
    query = merged.writeStream.format("parquet").option("path", f"{folder}/m").option("checkpointLocation", f"{folder}/ck").trigger(availableNow=True).start()
    query.awaitTermination(180)
    emitted = spark.read.parquet(f"{folder}/m")
    batch = merging.stream_merge_ground_truth(left, right)
    assert {r["inference_id"] for r in emitted.collect()} == {r["inference_id"] for r in batch.collect()}
    assert batch.count() == sum(1 for i in range(600) if i % 100 <= 60)
    late = merge.late_records(merge.merge_ground_truth(left, right), emitted)
    assert {int(r["inference_id"]) for r in late.collect()} == {i for i in range(600) if i % 100 > 60}


def test_repeated_labels_count_once_on_streams_and_tables(spark, folder):
    left = captured(spark).filter("inference_id in ('1', '2', '3')")
    right = labels(spark).filter("inference_id in ('1', '2', '3')")
    later = right.withColumn("gt_ts", F.col("gt_ts") + F.expr("INTERVAL 1 SECOND")).withColumn("truth", F.lit("corrected"))
    batch = merging.stream_merge_ground_truth(left, right.unionByName(later).unionByName(right))
    assert batch.count() == 3 and batch.filter("truth = 'corrected'").count() == 0
    stream = merging.stream_merge_ground_truth(as_stream(spark, left, f"{folder}/c"), as_stream(spark, right.unionByName(right), f"{folder}/g"))
    query = stream.writeStream.format("parquet").option("path", f"{folder}/m").option("checkpointLocation", f"{folder}/ck").trigger(availableNow=True).start()
    query.awaitTermination(180)
    assert query.exception() is None and spark.read.parquet(f"{folder}/m").count() == 3


def arriving(spark, folder, **batches):
    """A stream that takes one file after the other, whatever the event times in them are."""
    import os
    import time

    for i, (name, df) in enumerate(batches.items()):
        df.coalesce(1).write.parquet(f"{folder}/{name}")
        for part in os.listdir(f"{folder}/{name}"):
            when = time.time() - 1000 + i
            os.utime(f"{folder}/{name}/{part}", (when, when))
    schema = next(iter(batches.values())).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(*[f"{folder}/*"])


def disordered(spark, folder, n=600):
    """Predictions and labels in three arrivals: corrections come before the labels they follow, and labels repeat."""
    left, right = captured(spark, n), labels(spark, n)
    later = right.filter("inference_id % 2 = 0").select("inference_id", (F.col("gt_ts") + F.expr("INTERVAL 5 MINUTES")).alias("gt_ts"), F.lit("z").alias("truth"))
    early = right.filter("inference_id % 7 = 0").select("inference_id", (F.col("gt_ts") - F.expr("INTERVAL 20 MINUTES")).alias("gt_ts"), F.lit("y").alias("truth"))
    third = lambda df, k: df.filter(F.col("inference_id").cast("int").between(k * n // 3, (k + 1) * n // 3 - 1))
    # The end of a stream is never closed: a last row far ahead moves the watermark over all others.
    last = spark.range(1).select(F.lit("end").alias("inference_id"), at(F.lit(10**7)).alias("ts"), F.lit("a").alias("prediction"), F.lit(0.0).alias("x"))
    told = spark.range(1).select(F.lit("end").alias("inference_id"), at(F.lit(10**7)).alias("gt_ts"), F.lit("a").alias("truth"))
    sent = {f"b{k}": third(left, k) for k in range(3)} | {"b9": last}
    known, after = {}, later.unionByName(right.filter("inference_id % 3 = 0"))
    for k in range(3):
        known[f"b{2 * k}"] = third(after, k)
        known[f"b{2 * k + 1}"] = third(right.unionByName(early), k)
    known["b9"] = told
    return (left, right.unionByName(later).unionByName(early).unionByName(right.filter("inference_id % 3 = 0")),
            arriving(spark, f"{folder}/c", **sent), arriving(spark, f"{folder}/g", **known))


def test_the_earliest_label_counts_whatever_the_order_of_arrival(spark, folder):
    left, right, sent, told = disordered(spark, folder)
    merged = merging.stream_merge_earliest(sent, told, lateness="10 hours")
    query = merged.writeStream.format("parquet").option("path", f"{folder}/m").option("checkpointLocation", f"{folder}/ck").trigger(availableNow=True).start()
    query.awaitTermination(300)
    assert query.exception() is None
    batch = merging.stream_merge_ground_truth(left, right)
    emitted = spark.read.schema(batch.schema).parquet(f"{folder}/m")
    assert emitted.columns == batch.columns and emitted.count() == batch.count() > 300
    assert emitted.exceptAll(batch).isEmpty()
    assert batch.filter("truth = 'y'").count() > 10 and batch.filter("truth = 'z'").count() == 0


def test_one_query_from_captures_to_hourly_metrics(spark, folder):
    left, right, sent, told = disordered(spark, folder)
    floors = evaluate.suggest_model_constraints(spark.createDataFrame([("accuracy", 0.6)], "metric STRING, value DOUBLE"))
    hourly.follow_model_quality(sent, told, floors, f"{folder}/out", f"{folder}/ck", lateness="10 hours").awaitTermination(300)
    want = hourly.hourly_model_metrics(hourly.hourly_confusion(merging.stream_merge_ground_truth(left, right)))
    got = reports.read_metrics(spark, f"{folder}/out/metrics")
    rounded = lambda df: {(r[0], r[1], round(r[2], 9)) for r in df.select("window_start", "metric", "value").collect()}
    assert rounded(got) == rounded(want) and len(rounded(want)) >= 30
    assert {(r["source"], r["run_id"]) for r in got.collect()} == {("model_quality", "stream")}
    low = hourly.hourly_model_violations(want, floors)
    assert spark.read.parquet(f"{folder}/out/violations").count() == low.count()


def test_repeated_runs_leave_the_same_tables(spark, folder):
    found = spark.createDataFrame([("mass", "completeness", "0.5")], "column STRING, check STRING, detail STRING")
    hours = spark.range(3).select(at(F.col("id") * 3600).alias("window_start"), F.lit("accuracy").alias("metric"), (F.col("id") / 4).alias("value"))
    for _ in range(2):
        for run in ("1", "2"):
            assert monitoring_run.record_run(spark, folder, run, "birds", "DataQuality", found) == 1
        reports.write_metrics(hours, f"{folder}/metrics", "model_quality", "window_start", "7")
        reports.write_metrics(hours.limit(1).drop("window_start"), f"{folder}/metrics", F.lit("baseline"))
    assert sorted(r["run_id"] for r in spark.read.schema("run_id STRING").parquet(f"{folder}/runs").collect()) == ["1", "2"]
    # An hour that is written again replaces itself alone.
    reports.write_metrics(hours.filter("value = 0.5").withColumn("value", F.lit(0.9)), f"{folder}/metrics", "model_quality", "window_start", "7")
    rows = reports.read_metrics(spark, f"{folder}/metrics").collect()
    assert sorted((r["source"], r["run_id"], r["value"]) for r in rows) == [
        ("baseline", "run", 0.0), ("model_quality", "7", 0.0), ("model_quality", "7", 0.25), ("model_quality", "7", 0.9)]


def test_two_writers_get_different_versions(spark, folder):
    from concurrent.futures import ThreadPoolExecutor

    from rowsentry.plans import training_run as plan
    from rowsentry.sources import commits

    def register(k):
        entry = spark.createDataFrame([("g", f"m{k}", 0.9)], "model_group STRING, artifact STRING, accuracy DOUBLE")
        return plan.append_version(spark, entry, f"{folder}/registry")

    assert plan.read_registry(spark, f"{folder}/registry") is None
    with ThreadPoolExecutor(4) as pool:
        numbers = list(pool.map(register, range(6)))
    assert sorted(numbers) == list(range(6))
    rows = plan.read_registry(spark, f"{folder}/registry").collect()
    assert sorted(r["version"] for r in rows) == [1, 2, 3, 4, 5, 6] and len({r["artifact"] for r in rows}) == 6
    # What a writer left that never committed is not seen.
    spark.range(3).write.parquet(f"{folder}/registry/rows-left")
    assert plan.read_registry(spark, f"{folder}/registry").count() == 6 and len(commits.commits(spark, f"{folder}/registry")) == 6


def test_model_quality_stream(spark, folder):
    merged = merging.stream_merge_ground_truth(captured(spark), labels(spark))
    floors = evaluate.suggest_model_constraints(spark.createDataFrame([("accuracy", 0.6)], "metric STRING, value DOUBLE"))
    stream = as_stream(spark, merged, f"{folder}/in").withWatermark("ts", "1 hour")
    query = hourly.start_model_quality(stream, floors, f"{folder}/out", f"{folder}/ck")
    query.awaitTermination(180)
    assert query.exception() is None
    metrics = hourly.hourly_model_metrics(hourly.hourly_confusion(merged))
    emitted = spark.read.parquet(f"{folder}/out/metrics")
    hours = emitted.select("window_start").distinct().count()
    assert hours >= 7
    want = {tuple(r) for r in closed(metrics, hours).select("window_start", "metric", F.round("value", 9)).collect()}
    assert {tuple(r) for r in emitted.select("window_start", "metric", F.round("value", 9)).collect()} == want
    low = closed(hourly.hourly_model_violations(metrics, floors), hours)
    assert spark.read.parquet(f"{folder}/out/violations").count() == low.count()


def test_ground_truth_file_stream(spark, folder):
    from pathlib import Path

    for hour in (1, 2):
        p = Path(f"{folder}/g/2024/01/01/{hour:02d}/0000.jsonl")
        p.parent.mkdir(parents=True)
        event = '{"groundTruthData":{"data":"a","encoding":"CSV"},"eventMetadata":{"eventId":"%d"},"eventVersion":"0"}'
        p.write_text(event % hour)
    query = captures.stream_ground_truth(spark, f"{folder}/g").writeStream.format("parquet").option("path", f"{folder}/o").option(
        "checkpointLocation", f"{folder}/ck").trigger(availableNow=True).start()
    query.awaitTermination(120)
    got = {(r["inference_id"], r["gt_ts"].hour) for r in spark.read.parquet(f"{folder}/o").collect()}
    assert got == {("1", 1), ("2", 2)}


def test_events_reach_the_action_once(spark, folder):
    rows = spark.createDataFrame([("v1", "Approved"), ("v2", "Rejected"), ("v3", "Approved")], "arn STRING, status STRING")

    def act(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{folder}/acted/batch={batch_id}")

    stream = as_stream(spark, rows, f"{folder}/in")
    for _ in range(2):
        events.start_events(stream, {"status": ["Approved"]}, act, f"{folder}/ck").awaitTermination(120)
    assert sorted(r["arn"] for r in spark.read.parquet(f"{folder}/acted").collect()) == ["v1", "v3"]


def test_batch_monitoring_run(spark, labelled, folder):
    base = labelled.drop("id", "species")
    constraints = quality.suggest_constraints(quality.profile_columns_exact(base), quality.value_histogram(base, ["island", "sex"]))
    line = F.concat_ws(",", *[F.col(c) for c in base.columns])
    answer = F.to_json(F.struct(F.col("species").alias("0"), F.lit(0.9).alias("1")))
    traffic = labelled.select(F.col("id").cast("string").alias("inference_id"), at(F.col("id") * 60).alias("ts"), F.lit("text/csv").alias("content_type"),
                              F.when(F.col("id") == 5, F.lit("Atlantis,1,2,3,4,MALE")).when(F.col("id") == 6, F.lit("x")).otherwise(line).alias("input"),
                              answer.alias("output"))
    profile, violations = monitoring_run.data_quality_run(traffic, constraints)
    assert profile.select("window_start").distinct().count() == 6
    assert [(r["column"], r["check"], r["window_start"].hour) for r in violations.collect()] == [("island", "unseen_category", 0), ("*", "unreadable", 0)]
    _, unreadable = monitoring_run.captured_features(traffic)
    assert [r["inference_id"] for r in unreadable.collect()] == ["6"]
    truth = labelled.select(F.col("id").cast("string").alias("inference_id"), F.when(F.col("id") < 60, "Gentoo").otherwise(F.col("species")).alias("truth"),
                            at(F.lit(0)).alias("gt_ts"))
    floors = spark.createDataFrame([("accuracy", 0.5)], "metric STRING, floor DOUBLE")
    _, low = monitoring_run.model_quality_run(traffic, truth, floors)
    assert [(r["window_start"].hour, r["metric"], r["value"]) for r in low.collect()] == [(0, "accuracy", 0.0)]
    assert monitoring_run.record_run(spark, folder, "r1", "birds", "DataQuality", violations) == 2
    assert monitoring_run.record_run(spark, folder, "r2", "birds", "DataQuality", violations.limit(0)) == 0
    assert monitoring_run.record_run(spark, folder, "r3", "birds", "ModelQuality", low) == 1
    runs = spark.read.parquet(f"{folder}/runs")
    assert {(r["run_id"], r["last_status"], r["n_violations"]) for r in runs.collect()} == {
        ("r1", "CompletedWithViolations", 2), ("r2", "Completed", 0), ("r3", "CompletedWithViolations", 1)}
    assert {r["check"] for r in reports.read_violations(spark, f"{folder}/violations/r1").collect()} == {"unseen_category", "unreadable"}
    kept = reports.read_violations(spark, f"{folder}/violations/r3").first()
    assert (kept["column"], kept["check"], kept["value"], kept["floor"], kept["window_start"].hour) == ("accuracy", "below_floor", 0.0, 0.5, 0)


def test_violations_of_every_hour_are_kept(spark, folder):
    hours = spark.range(5).select(at(F.col("id") * 3600).alias("window_start"), F.lit("mass").alias("column"), F.lit("completeness").alias("check"),
                                  F.concat(F.lit("completeness 0."), F.col("id").cast("string")).alias("detail"))
    assert monitoring_run.record_run(spark, folder, "r", "birds", "DataQuality", hours) == 5
    back = reports.read_violations(spark, f"{folder}/violations/r")
    assert sorted((r["window_start"].hour, r["detail"]) for r in back.collect()) == [(h, f"completeness 0.{h}") for h in range(5)]


def package_event(group, arn, status, minute):
    import json

    return json.dumps({"detail-type": "Package State Change", "source": ["registry"], "time": f"2024-02-03T04:{minute:02d}:06Z", "resources": [arn],
                       "detail": {"ModelPackageGroupName": group, "ModelPackageVersion": minute, "ModelPackageArn": arn,
                                  "ModelPackageStatus": "Completed", "ModelApprovalStatus": status}})


def test_approvals_deploy_and_rejections_do_not(spark, folder):
    from pathlib import Path

    from rowsentry.plans import deployment_run as run
    from rowsentry.sources.events import read_package_events, stream_package_events

    Path(f"{folder}/in").mkdir()

    def drop(name, *lines):
        Path(f"{folder}/in/{name}.json").write_text("\n".join(lines))

    def follow():
        run.start_deployments(spark, stream_package_events(spark, f"{folder}/in"), folder, f"{folder}/ck", ["g", "h"]).awaitTermination(120)
        return {r["endpoint"]: (r["artifact"], r["config"], r["action"]) for r in run.current_deployments(spark, folder).collect()}

    drop("a", package_event("g", "v1", "Approved", 1), package_event("h", "w1", "Rejected", 1), package_event("x", "z", "Approved", 1), '{"source": ["other"]}')
    assert follow() == {"g": ("v1", "g-config-0203040106", "created")}
    drop("b", package_event("g", "v2", "Approved", 2), package_event("g", "v3", "Approved", 3), package_event("h", "w2", "Approved", 3))
    assert follow() == {"g": ("v3", "g-config-0203040306", "updated"), "h": ("w2", "h-config-0203040306", "created")}
    events = read_package_events(spark, f"{folder}/in/b.json")
    run.deploy_approved(spark, events, folder, 1)
    assert {r["action"] for r in run.current_deployments(spark, folder).collect()} == {"updated", "created"}
    drop("c", package_event("g", "v9", "Rejected", 9))
    assert follow()["g"][0] == "v3"
    monitors = run.create_missing_monitors(spark, run.current_deployments(spark, folder), folder)
    assert monitors.count() == 4
    assert run.create_missing_monitors(spark, run.current_deployments(spark, folder), folder).count() == 4
