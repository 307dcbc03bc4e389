import json

import pytest
from pyspark.sql import functions as F

from rowsentry.fixed_values import FEATURE_COLUMNS, LABEL_DOMAIN
from rowsentry.operators import features, rows, scoring, split, train
from rowsentry.plans import training_run as plan
from rowsentry.sources import reports, tables


@pytest.fixture(scope="module")
def prepared(labelled):
    parts = split.stratified_folds(labelled, "species", "id")
    wide, fitted = features.fit_transform_columns(parts.withColumn("_y", F.col("species")), "species", keep=["id", "_y"])
    ready = scoring.as_vector(wide, fitted.feature_names).withColumn("label", F.array_position(F.array(*map(F.lit, LABEL_DOMAIN)), F.col("_y")) - 1)
    return ready.select("id", "fold", "split", "features", "label").persist(), fitted


@pytest.fixture(scope="module")
def fitted_models(prepared):
    return train.train_over_folds(prepared[0], [1, 2, 3], 9, 3, epochs=15)


def test_a_model_per_fold_with_metrics(spark, fitted_models):
    table = fitted_models.metrics_table(spark)
    got = {(r["fold"], r["metric"]) for r in table.collect()}
    assert got == {(f, m) for f in (1, 2, 3) for m in ("val_loss", "val_accuracy", "loss", "accuracy")}
    assert all(m["val_accuracy"] > 0.8 for m in fitted_models.metrics.values())


def test_fold_metrics_agree_with_sparks_own(prepared, fitted_models):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    valid = prepared[0].filter("fold = 2 and split = 'validation'")
    scored = fitted_models.models[2].transform(valid.withColumn("label", F.col("label").cast("double")))
    assert fitted_models.metrics[2]["val_loss"] == pytest.approx(MulticlassClassificationEvaluator(metricName="logLoss").evaluate(scored))
    assert fitted_models.metrics[2]["val_accuracy"] == pytest.approx(MulticlassClassificationEvaluator(metricName="accuracy").evaluate(scored))


def test_scoring_by_all_models_equals_one_by_one(labelled, prepared, fitted_models):
    fitted = {f: prepared[1].only(f) for f in (1, 2, 3)}
    together = scoring.score_by_models(labelled, fitted, fitted_models.models, LABEL_DOMAIN, "species", ["id"])
    assert together.count() == 3 * 333
    for f in (1, 2, 3):
        alone = scoring.score_rows(labelled, fitted[f], fitted_models.models[f], LABEL_DOMAIN, ["id"])
        part = together.filter(F.col("model") == f"model_{f}").select("id", "prediction", "confidence")
        assert part.exceptAll(alone).isEmpty()


def test_warm_start_continues_from_the_last_weights(prepared):
    cold = train.train_over_folds(prepared[0], [1, 2], 9, 3, epochs=3, warm_start=False)
    warm = train.train_over_folds(prepared[0], [1, 2], 9, 3, epochs=3)
    assert list(cold.models[1].weights) == list(warm.models[1].weights)
    assert list(cold.models[2].weights) != list(warm.models[2].weights)


def test_models_are_saved_in_versioned_folders(prepared, fitted_models, folder):
    train.save_models(fitted_models.models, f"{folder}/m")
    back = train.load_model(f"{folder}/m", 2)
    assert list(back.weights) == list(fitted_models.models[2].weights)


def test_probabilities_and_decoded_classes(prepared, fitted_models):
    vectors = prepared[0].filter("fold = 1 and split = 'validation'").select("id", "features")
    scored = scoring.predict_proba(fitted_models.models[1], vectors)
    for r in scoring.argmax_confidence(scored, LABEL_DOMAIN).collect():
        assert sum(r["probabilities"]) == pytest.approx(1.0) and len(r["probabilities"]) == 3
        assert r["prediction"] == LABEL_DOMAIN[r["probabilities"].index(max(r["probabilities"]))] and r["confidence"] == max(r["probabilities"])


def test_given_weights_give_the_trained_models_probabilities(prepared):
    """The expression over the weights agrees with the model they were taken from."""
    table, _ = prepared
    model = train.train_logistic(table.filter("fold = 1 and split = 'train'"), epochs=5)
    rows = table.filter("fold = 1").orderBy("id").limit(40)
    pairs = scoring.predict_proba(scoring.SoftmaxModel.of(model), scoring.predict_proba(model, rows, "want"), "got").select("want", "got").collect()
    assert len(pairs) == 40 and all(r["got"] == pytest.approx(r["want"], abs=1e-9) for r in pairs)


def test_given_weights_with_large_scores(spark):
    """No score overflows."""
    from pyspark.ml.functions import array_to_vector

    rows = spark.createDataFrame([([1000.0, 0.0],), ([-1000.0, 1.0],)], "x ARRAY<DOUBLE>").select(array_to_vector("x").alias("features"))
    model = scoring.SoftmaxModel([[1.0, 0.0], [-1.0, 0.0], [0.0, 0.0]], [0.0, 0.0, 0.0])
    assert [r["probabilities"] for r in scoring.predict_proba(model, rows).collect()] == [[1.0, 0.0, 0.0], [0.0, 1.0, 0.0]]


def test_tuning_and_top_models(prepared):
    trials, results = train.tune(prepared[0], [1, 2], 9, 3, trials=(1, 20))
    got = {r["trial"]: r for r in trials.collect()}
    assert [got[i]["epochs"] for i in (0, 1)] == [1, 20] and set(results) == {0, 1}
    best = train.top_models(trials).collect()
    assert len(best) == 1 and best[0]["rank"] == 0 and best[0]["val_accuracy"] == max(r["val_accuracy"] for r in got.values())


def test_gradient_descent_and_its_step_are_passed_on(prepared):
    rows = prepared[0].filter("fold = 1 AND split = 'train'")
    models = [train.train_classifier(rows, len(prepared[1].feature_names), 3, epochs=3, solver="gd", step=s) for s in (0.01, 0.5)]
    assert [m.getSolver() for m in models] == ["gd", "gd"] and [m.getStepSize() for m in models] == [0.01, 0.5]
    assert models[0].weights != models[1].weights


def test_top_models_ties(spark):
    trials = spark.createDataFrame([(2, 0.9), (1, 0.9), (3, 0.95), (4, 0.1)], "trial INT, val_accuracy DOUBLE")
    assert [(r["trial"], r["rank"]) for r in train.top_models(trials, 2).orderBy("rank").collect()] == [(3, 0), (1, 1), (2, 2)]


def test_log_metrics(spark):
    line = "Epoch 2/20 - 0s - loss: 0.9012 - accuracy: 0.7123 - val_loss: 1.05 - val_accuracy: 0.6543"
    df = spark.createDataFrame([(1, line), (2, "nothing here"), (3, "loss: ...")], "n INT, line STRING")
    got = {(r["n"], r["name"], r["position"]): r["value"] for r in train.extract_log_metrics(df).collect()}
    assert got == {(1, "loss", 0): 0.9012, (1, "loss", 1): 1.05, (1, "accuracy", 0): 0.7123, (1, "accuracy", 1): 0.6543,
                   (1, "val_accuracy", 0): 0.6543, (3, "loss", 0): None}
    words = {(r["name"], r["value"]) for r in train.extract_log_metrics(df.filter("n = 1"), word_boundary=True).collect()}
    assert words == {("loss", 0.9012), ("accuracy", 0.7123), ("val_accuracy", 0.6543)}


def test_requests_to_answers(spark, prepared, fitted_models):
    body = {"island": "Torgersen", "culmen_length_mm": 38.0, "culmen_depth_mm": 18.0, "flipper_length_mm": 190, "body_mass_g": 3700, "sex": "MALE"}
    line = ",".join(str(body[c]) for c in FEATURE_COLUMNS)
    sent = spark.createDataFrame([
        ("json", "application/json", "application/json", json.dumps(body)), ("csv", "text/csv", "text/csv", f"{line}\n{line}"),
        ("labelled", "text/csv", "application/json", line + ",Adelie"), ("bad", "text/plain", "text/csv", line),
        ("odd", "text/csv", "text/csv", line.replace("Torgersen", "Atlantis")), ("null", "text/csv", "text/csv", None),
        ("mixed", "text/csv", "text/csv", "\n".join([line, line.replace("38.0", "nan"), line]))],
        "inference_id STRING, content_type STRING, accept STRING, body STRING")
    scored, rejected = scoring.score_requests(sent, prepared[1].only(1), fitted_models.models[1], LABEL_DOMAIN)
    rows = scoring.answer_requests(scored, rejected).collect()
    answers = {r["inference_id"]: r["response"] for r in rows}
    assert len(rows) == len(answers) == 7 and {r["inference_id"] for r in rows if r["error"]} == {"bad", "odd", "null", "mixed"}
    assert json.loads(answers["json"])["0"] == "Adelie" and json.loads(answers["labelled"])["0"] == "Adelie"
    assert [x.split(",")[0] for x in answers["csv"].split("\n")] == ["Adelie", "Adelie"]
    errors = {r["inference_id"]: r["error"] for r in rejected.collect()}
    assert errors == {"bad": "Content type text/plain is not supported.", "odd": "Error transforming the input data.",
                      "null": "No input data received.", "mixed": "Error transforming the input data."}


def test_user_functions_load_once_per_task(spark):
    df = spark.range(100).repartition(2).withColumnRenamed("id", "x")
    out = scoring.score_with(df, lambda: 10, lambda f: f["x"], lambda x, m: x * m, lambda f, y: f.assign(y=y), "x bigint, y bigint")
    assert all(r["y"] == 10 * r["x"] for r in out.collect()) and out.count() == 100


def test_training_run_end_to_end(spark, labelled, folder):
    run = plan.training_run(spark, labelled, "group", "id", epochs=(10, 20), folder=folder)
    assert run.passed and run.accuracy >= 0.6 and run.message is None
    report = json.loads(reports.read_eval_report(spark, f"{folder}/report").first()["report"])
    assert set(report["metrics"]["accuracy"]) == {"model_1", "model_2", "model_3"}
    written = spark.read.parquet(f"{folder}/metrics").filter("source <> 'baseline'")
    assert {(r["source"], r["metric"]) for r in written.collect()} == {
        (f"trial_{t}_fold_{f}", m) for t in (0, 1) for f in (1, 2, 3) for m in ("loss", "accuracy", "val_loss", "val_accuracy")}
    assert spark.read.parquet(f"{folder}/constraints").count() == 6
    assert {r["metric"] for r in spark.read.parquet(f"{folder}/floors").collect()} >= {"accuracy", "weighted_f1"}
    entry = plan.read_registry(spark, f"{folder}/registry").collect()
    assert [(r["version"], r["status"]) for r in entry] == [(1, "PendingManualApproval")]
    again = spark.createDataFrame([("group", "elsewhere", 0.9)], "model_group STRING, artifact STRING, accuracy DOUBLE")
    plan.append_version(spark, again, f"{folder}/registry")
    assert plan.read_registry(spark, f"{folder}/registry").agg(F.max("version")).first()[0] == 2
    part = tables.read_split(spark, f"{folder}/splits", "validation", 2)
    assert part.count() == 54 and set(rows.string_columns(part)) >= {"island", "sex", "species"}
    assert {r["island"] for r in part.select("island").distinct().collect()} == {"Biscoe", "Dream", "Torgersen"}


def test_a_failing_gate_registers_nothing(spark, labelled, folder):
    run = plan.training_run(spark, labelled, "group", "id", epochs=(1,), threshold=1.01, folder=folder)
    assert not run.passed and run.message == "Model's accuracy is less than accuracy threshold 1.01"
    assert plan.read_registry(spark, f"{folder}/registry") is None


def test_folder_comes_from_the_session():
    from types import SimpleNamespace

    from rowsentry.session import shared_folder

    def session(**named):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: named.get(key, default)))

    with pytest.raises(ValueError):
        shared_folder(session())
    assert shared_folder(session(**{"spark.checkpoint.dir": "/shared/place/"})) == "/shared/place"
