"""From a cleaned labelled table to a registered model version."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowsentry.fixed_values import (
    ACCURACY_THRESHOLD, FOLDS, HIDDEN_LAYERS, LABEL_COLUMN, TUNING_EPOCHS,
)
from rowsentry.functions.arrays import encode_label
from rowsentry.functions.names import as_list
from rowsentry.operators import evaluate, features, quality, registry, rows, scoring, split, train
from rowsentry.session import shared_folder
from rowsentry.sources import commits, fitted as fitted_store, reports, tables


@dataclass(frozen=True)
class TrainingRun:
    """Where a run left its tables, and whether the gate was passed."""

    folder: str
    accuracy: float
    passed: bool
    message: str | None


def prepare(df: DataFrame, folder: str, key: str | Sequence[str], label: str = LABEL_COLUMN, folds: int = FOLDS) -> DataFrame:
    """Write the split table, laid out by split and fold, and read it back.

    The written table cuts the lineage: every later step scans its own folders only, and a lost
    executor costs a re-read instead of a new split.
    """
    spark = df.sparkSession
    tables.write_splits(split.split_and_fold(df, label, key, folds), f"{folder}/splits")
    return spark.read.parquet(f"{folder}/splits")


def fit_folds(splits: DataFrame, folder: str, key: Sequence[str], label: str = LABEL_COLUMN) -> tuple[DataFrame, features.FittedColumns]:
    """Fit per fold, save the fitted values, and give the vectors with their label codes."""
    spark = splits.sparkSession
    wide, fitted = features.fit_transform_columns(splits.withColumn("_label", F.col(label)), label, keep=[*key, "_label"])
    fitted_store.save_fitted(spark, fitted, f"{folder}/fitted")
    ready = scoring.as_vector(wide, fitted.feature_names)
    coded = ready.withColumn("label", encode_label("_label", fitted.domain(label)))
    return coded.select(*key, "fold", "split", "features", "label"), fitted


def score_test(splits: DataFrame, fitted: features.FittedColumns, models: dict, key: Sequence[str], label: str) -> DataFrame:
    """The test rows scored by the model of each fold with that fold's fit."""
    test = splits.filter("split = 'test'")
    return scoring.score_by_models(test, {f: fitted.only(f) for f in models}, models, fitted.domain(label), label, key)


def baselines(splits: DataFrame, predictions: DataFrame, folder: str, key: Sequence[str], label: str) -> None:
    """Data and model quality baselines: profile, constraints, metrics and their floors."""
    first = splits.filter("split = 'train' and fold = 1").drop("split", "fold", label, *key)
    texts = rows.string_columns(first)
    profile = quality.profile_columns(first)
    profile.write.mode("overwrite").parquet(f"{folder}/profile")
    kept = first.sparkSession.read.parquet(f"{folder}/profile")
    histogram = quality.value_histogram(first, texts) if texts else None
    quality.suggest_constraints(kept, histogram).write.mode("overwrite").parquet(f"{folder}/constraints")
    metrics = evaluate.multiclass_metrics(evaluate.confusion_matrix(predictions))
    reports.write_metrics(metrics, f"{folder}/metrics", "baseline")
    evaluate.suggest_model_constraints(metrics).write.mode("overwrite").parquet(f"{folder}/floors")


def training_run(spark: SparkSession, df: DataFrame, group: str, key: str | Sequence[str], label: str = LABEL_COLUMN,
                 folds: int = FOLDS, epochs: Sequence[int] = TUNING_EPOCHS, hidden: Sequence[int] = HIDDEN_LAYERS,
                 threshold: float = ACCURACY_THRESHOLD, folder: str | None = None) -> TrainingRun:
    """Split, fit, tune, evaluate, gate; when the gate passes, write baselines and register.

    ``folder`` defaults to ``<spark.checkpoint.dir>/<group>``, a place all executors can reach.
    """
    folder = folder or f"{shared_folder(spark)}/{group}"
    keys = as_list(key)
    splits = prepare(df, folder, keys, label, folds)
    vectors, fitted = fit_folds(splits, folder, keys, label)
    numbers = list(range(1, folds + 1))
    trials, results = train.tune(vectors, numbers, len(fitted.feature_names), len(fitted.domain(label)),
                                 trials=epochs, hidden=hidden, persist=False)
    for number, result in results.items():
        source = F.format_string(f"trial_{number}_fold_%d", "fold")
        reports.write_metrics(result.metrics_table(spark), f"{folder}/metrics", source)
    best = results[train.top_models(trials).first()["trial"]]
    train.save_models(best.models, f"{folder}/models")
    score_test(splits, fitted, best.models, keys, label).write.mode("overwrite").parquet(f"{folder}/predictions")
    predictions = spark.read.parquet(f"{folder}/predictions")
    reports.write_eval_report(evaluate.eval_report(evaluate.evaluate_models(predictions)), f"{folder}/report")
    gate = rows.quality_gate(reports.read_eval_report(spark, f"{folder}/report"), threshold=threshold).first()
    if gate["passed"]:
        baselines(splits, predictions.filter("model = 'model_1'"), folder, keys, label)
        entry = spark.createDataFrame([(group, f"{folder}/models", gate["metric"])], "model_group STRING, artifact STRING, accuracy DOUBLE")
        described = registry.describe_version(entry, "trained over folds", {"constraints": f"{folder}/constraints", "floors": f"{folder}/floors"})
        append_version(spark, described, f"{folder}/registry")
    return TrainingRun(folder, gate["metric"], gate["passed"], gate["message"])


def append_version(spark: SparkSession, entries: DataFrame, path: str) -> int:
    """Append entries to the registry table at ``path``, numbered after its last versions; returns the commit's number.

    Runs that register at the same time get different versions: the later one numbers its entries again.
    """
    return commits.commit(spark, path, lambda known: registry.register_version(known, entries, "model_group", ["artifact"]))


def read_registry(spark: SparkSession, path: str) -> DataFrame | None:
    """The registry table, or nothing while no version has been registered."""
    return commits.read_committed(spark, path)
