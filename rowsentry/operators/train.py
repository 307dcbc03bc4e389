"""Distributed training over folds, tuning, and metrics read from logs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.classification import (
    LogisticRegression, MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.storagelevel import StorageLevel

from rowsentry.fixed_values import (
    BATCH_SIZE, DEFAULT_EPOCHS, HIDDEN_LAYERS, LEARNING_RATE, LOG_PATTERNS, TUNING_EPOCHS,
)
from rowsentry.functions.names import as_list

SEED = 42
SMALLEST_PROBABILITY = 1e-15


def train_classifier(df: DataFrame, n_features: int, n_classes: int, hidden: Sequence[int] = HIDDEN_LAYERS,
                     epochs: int = DEFAULT_EPOCHS, batch: int = BATCH_SIZE, seed: int = SEED,
                     initial=None, features: str = "features", label: str = "label", solver: str = "l-bfgs",
                     step: float = LEARNING_RATE):
    """Fit a perceptron ``n_features → hidden → n_classes`` on vector and code columns.

    ``solver`` is ``l-bfgs`` or ``gd``, gradient descent with steps of ``step`` (which ``l-bfgs`` does not use).
    """
    learner = MultilayerPerceptronClassifier(
        layers=[n_features, *hidden, n_classes], maxIter=epochs, blockSize=batch, seed=seed, solver=solver, stepSize=step,
        featuresCol=features, labelCol=label)
    if initial is not None:
        learner = learner.setInitialWeights(initial)
    return learner.fit(df.select(features, F.col(label).cast("double").alias(label)))


def train_logistic(df: DataFrame, epochs: int = DEFAULT_EPOCHS, features: str = "features", label: str = "label"):
    """A multinomial logistic regression: the cheaper placeholder model for very wide tables."""
    learner = LogisticRegression(family="multinomial", maxIter=epochs, featuresCol=features, labelCol=label)
    return learner.fit(df.select(features, F.col(label).cast("double").alias(label)))


def fold_metrics(model, rows: DataFrame, label: str = "label", prefix: str = "val_") -> dict[str, float]:
    """``loss`` (cross-entropy) and ``accuracy`` of a fitted model on some rows, in one pass; of validation rows by default."""
    truth = F.col(label).cast("double")
    chosen = F.element_at(vector_to_array("probability"), truth.cast("int") + 1)
    row = model.transform(rows).agg(
        F.avg(-F.log(F.greatest(chosen, F.lit(SMALLEST_PROBABILITY)))).alias("loss"),
        F.avg((truth == F.col("prediction")).cast("double")).alias("accuracy")).first()
    return {f"{prefix}{name}": row[name] for name in ("loss", "accuracy")}


@dataclass(frozen=True)
class FoldModels:
    """Fitted models by fold and their metrics on the fold's training and validation rows."""

    models: dict
    metrics: dict

    def metrics_table(self, spark: SparkSession) -> DataFrame:
        rows = [(f, name, float(v)) for f, m in sorted(self.metrics.items()) for name, v in sorted(m.items())]
        return spark.createDataFrame(rows, "fold INT, metric STRING, value DOUBLE")


def train_over_folds(df: DataFrame, folds: Sequence[int], n_features: int, n_classes: int,
                     hidden: Sequence[int] = HIDDEN_LAYERS, epochs: int = DEFAULT_EPOCHS, batch: int = BATCH_SIZE,
                     seed: int = SEED, warm_start: bool = True, fold: str = "fold", split: str = "split",
                     features: str = "features", label: str = "label", persist: bool = True, solver: str = "l-bfgs",
                     step: float = LEARNING_RATE) -> FoldModels:
    """One model per fold; with ``warm_start`` each goes on from the previous fold's weights.

    Warm-started models have seen rows of earlier folds, so their validation score is
    optimistic. Each fit keeps its own stacked rows while it iterates; ``persist`` also keeps
    (and spills) the input, which pays when that is costly to compute and not when it is a
    stored table of splits.
    """
    rows = df.select(fold, split, features, label)
    held = rows.persist(StorageLevel.MEMORY_AND_DISK) if persist else rows
    models: dict = {}
    metrics: dict = {}
    weights = None
    try:
        for f in folds:
            train = held.filter((F.col(fold) == f) & (F.col(split) == "train"))
            valid = held.filter((F.col(fold) == f) & (F.col(split) == "validation"))
            models[f] = train_classifier(train, n_features, n_classes, hidden, epochs, batch, seed,
                                         weights, features, label, solver, step)
            metrics[f] = fold_metrics(models[f], valid, label) | fold_metrics(models[f], train, label, "")
            weights = models[f].weights if warm_start else None
    finally:
        if persist:
            held.unpersist()
    return FoldModels(models, metrics)


def tune(df: DataFrame, folds: Sequence[int], n_features: int, n_classes: int, trials: Sequence[int] = TUNING_EPOCHS,
         parallel: int = 3, persist: bool = True, **training) -> tuple[DataFrame, dict]:
    """Train once per epoch count, some at a time; ``(trial, epochs, val_accuracy)`` and the models.

    The objective is the validation accuracy after the last fold. The trials share one kept copy
    of the rows when ``persist`` is set.
    """
    held = df.persist(StorageLevel.MEMORY_AND_DISK) if persist else df

    def run(trial: int) -> FoldModels:
        return train_over_folds(held, folds, n_features, n_classes, epochs=trials[trial], persist=False, **training)

    pool = ThreadPool(min(parallel, len(trials)))
    try:
        results = pool.map(inheritable_thread_target(df.sparkSession)(run), range(len(trials)))
    finally:
        pool.close()
        if persist:
            held.unpersist()
    last = list(folds)[-1]
    rows = [(i, int(trials[i]), float(r.metrics[last]["val_accuracy"])) for i, r in enumerate(results)]
    table = df.sparkSession.createDataFrame(rows, "trial INT, epochs INT, val_accuracy DOUBLE")
    return table, dict(enumerate(results))


def top_models(trials: DataFrame, k: int = 0, metric: str = "val_accuracy", tie: str = "trial",
               by: str | Sequence[str] = ()) -> DataFrame:
    """The trials of rank 0 to ``k`` by falling metric, with their ``rank`` (per ``by``)."""
    groups = as_list(by)
    order = [F.desc(metric), F.asc(tie)]
    if not groups:
        best = trials.orderBy(*order).limit(k + 1)
        return best.withColumn("rank", F.row_number().over(Window.orderBy(*order)) - 1)
    # Each task keeps its own best k + 1 per group before the shuffle.
    ranked = trials.withColumn("rank", F.row_number().over(Window.partitionBy(*groups).orderBy(*order)) - 1)
    return ranked.filter(F.col("rank") <= k)


def extract_log_metrics(lines: DataFrame, line: str = "line", patterns: Mapping[str, str] = LOG_PATTERNS,
                        word_boundary: bool = False) -> DataFrame:
    """``name, position, value`` rows for every match of each pattern in a log line.

    The patterns match anywhere, so ``accuracy:`` is also found inside ``val_accuracy:`` unless
    ``word_boundary`` is set.
    """
    guard = "(?<![a-z_])" if word_boundary else ""
    others = [c for c in lines.columns if c != line]
    found = F.array(*[
        F.struct(F.lit(name).alias("name"),
                 F.regexp_extract_all(F.col(line), F.lit(guard + pattern), F.lit(1)).alias("hits"))
        for name, pattern in patterns.items()
    ])
    each = lines.select(*others, F.inline(found))
    return each.select(*others, "name", F.posexplode("hits").alias("position", "text")).select(
        *others, "name", "position", F.expr("try_cast(text as double)").alias("value"))


def save_models(models: Mapping, path: str) -> None:
    """One versioned folder per fold: ``model<k>/00<k>``."""
    for f, model in models.items():
        model.write().overwrite().save(f"{path}/model{f}/00{f}")


def load_model(path: str, fold: int) -> MultilayerPerceptronClassificationModel:
    return MultilayerPerceptronClassificationModel.load(f"{path}/model{fold}/00{fold}")
