"""Softmax regression by gradient descent with a fixed step: the same weights on any cluster, in any order of rows.

Every epoch is one pass over the rows for all folds and trials together. A task adds up the gradients of its rows; contributions are
rounded to whole multiples of 2^-32 first, so that sums are exact and neither partitioning nor a repeated task changes a bit.
The same pass measures the weights it starts from, on both sides of each fold.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rowsentry.fixed_values import DEFAULT_EPOCHS, LEARNING_RATE
from rowsentry.operators.scoring import SoftmaxModel
from rowsentry.operators.sizing import kept

GRAIN = float(2 ** 32)
#: Rows whose contributions to the gradient are held at a time.
BLOCK = 512
SIDES = ("train", "validation")
SMALLEST_PROBABILITY = 1e-15
METRICS = ("loss", "accuracy")


@dataclass
class SoftmaxFits:
    """Models by (fold, trial) after the last epoch, and ``(fold, trial, epoch, metric, value)`` of each epoch's end."""

    models: dict[tuple[int, int], SoftmaxModel]
    history: list[tuple[int, int, int, str, float]] = field(default_factory=list)

    def metrics_table(self, spark: SparkSession) -> DataFrame:
        """A row for each fold, trial, epoch and metric; those of validation rows are named ``val_``."""
        return spark.createDataFrame(self.history, "fold INT, trial INT, epoch INT, metric STRING, value DOUBLE")

    def weights_table(self, spark: SparkSession) -> DataFrame:
        """``fold, trial, class, index, weight``; the intercept has the index after the last feature."""
        rows = [(f, t, k, j, float(w)) for (f, t), m in sorted(self.models.items())
                for k, (row, start) in enumerate(zip(m.coefficients, m.intercepts, strict=True)) for j, w in enumerate([*row, start])]
        return spark.createDataFrame(rows, "fold INT, trial INT, class INT, index INT, weight DOUBLE")


def _whole(values: np.ndarray) -> np.ndarray:
    return np.rint(values * GRAIN).astype(np.int64)


def _softmax(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    # One dimension after the other: a row's scores do not depend on the rows beside it, as those of a matrix product may.
    scores = np.zeros((len(x), len(weights)))
    for j in range(x.shape[1]):
        scores += x[:, j: j + 1] * weights[:, j]
    parts = np.exp(scores - scores.max(axis=1, keepdims=True))
    return parts / parts.sum(axis=1, keepdims=True)


def _sums(rows: DataFrame, weights: dict[tuple[int, int], np.ndarray], gradient: bool) -> DataFrame:
    """``fold, trial, side, index, total``: sums of the gradient (train rows), then rows, loss and hits, in units of 2^-32."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)  # as large as the models themselves

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        classes, width = next(iter(models.values())).shape
        sums: dict[tuple[int, int, int], np.ndarray] = {}
        for batch in batches:
            fold, side, label = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            x = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(len(fold), width - 1)
            x = np.column_stack([x, np.ones(len(x))])
            for f in np.unique(fold):
                for t in sorted(trial for of, trial in models if of == f):
                    for s in (0, 1):
                        of = np.flatnonzero((fold == f) & (side == s))
                        held = sums.setdefault((int(f), t, s), np.zeros(classes * width + 3, np.int64))
                        for a in range(0, len(of), BLOCK):
                            some = of[a: a + BLOCK]
                            p, y = _softmax(x[some], models[f, t]), label[some]
                            chosen = p[np.arange(len(some)), y]
                            held[-3] += len(some)
                            held[-2] += _whole(-np.log(np.maximum(chosen, SMALLEST_PROBABILITY))).sum()
                            held[-1] += (p.argmax(axis=1) == y).sum()
                            if gradient and s == 0:
                                p[np.arange(len(some)), y] -= 1.0
                                held[:-3] += _whole(p[:, :, None] * x[some][:, None, :]).sum(axis=0).ravel()
        for (f, t, s), held in sums.items():
            n = len(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, v, np.int32)) for v in (f, t, s)] + [pa.array(np.arange(n, dtype=np.int32)), pa.array(held)],
                names=["fold", "trial", "side", "index", "total"])

    parts = rows.mapInArrow(run, "fold int, trial int, side int, index int, total long")
    return parts.groupBy("fold", "trial", "side", "index").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))


def _ready(df: DataFrame, n_features: int, n_classes: int, fold: str, split: str, features: str, label: str) -> DataFrame:
    x = F.col(features) if isinstance(df.schema[features].dataType, T.ArrayType) else vector_to_array(features)
    side = F.when(F.col(split) == SIDES[0], 0).when(F.col(split) == SIDES[1], 1)
    rows = df.select(F.col(fold).cast("int").alias("fold"), side.alias("side"), F.col(label).cast("int").alias("label"),
                     x.cast("array<double>").alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    fits = (F.size("x") == n_features) & finite & F.col("label").between(0, n_classes - 1)
    return rows.filter(F.col("fold").isNotNull() & F.col("side").isNotNull() & fits)


def train_softmax(df: DataFrame, folds: Sequence[int], n_features: int, n_classes: int, epochs: int = DEFAULT_EPOCHS,
                  steps: Sequence[float] = (LEARNING_RATE,), fold: str = "fold", split: str = "split", features: str = "features",
                  label: str = "label") -> SoftmaxFits:
    """A model for each fold and each step (a trial), all beginning with weights of zero, advanced together pass by pass.

    ``features`` is a vector or an array, ``label`` a class code. Rows without a fold, of another split than ``train`` and
    ``validation``, with a code outside the classes or with features that are missing, not finite or of another number take
    no part. A fold without train rows keeps its zeros; metrics of a side without rows are left out. Contributions to a
    gradient should stay below 2^31 divided by the rows of a task, which scaled features do.
    """
    rows = kept(_ready(df, n_features, n_classes, fold, split, features, label).filter(F.col("fold").isin([int(f) for f in folds])))
    width = n_features + 1
    weights = {(int(f), t): np.zeros((n_classes, width)) for f in folds for t in range(len(steps))}
    history = []
    for epoch in range(epochs + 1):
        last = epoch == epochs
        # As many rows as there are weights: the size of the models, not of the table.
        found: dict[tuple[int, int, int], np.ndarray] = {}
        for r in _sums(rows, weights, not last).collect():
            found.setdefault((r["fold"], r["trial"], r["side"]), np.zeros(n_classes * width + 3))[r["index"]] = float(r["total"])
        for (f, t, s), sums in sorted(found.items()):
            n = sums[-3]
            if epoch and n:
                prefix = "" if s == 0 else "val_"
                history += [(f, t, epoch, f"{prefix}{m}", float(v)) for m, v in zip(METRICS, (sums[-2] / GRAIN / n, sums[-1] / n), strict=True)]
            if s == 0 and n and not last:
                weights[f, t] = weights[f, t] - steps[t] * (sums[:-3] / GRAIN / n).reshape(n_classes, width)
    models = {at: SoftmaxModel(w[:, :-1].tolist(), w[:, -1].tolist(), features) for at, w in weights.items()}
    return SoftmaxFits(models, history)


def softmax_trials(fits: SoftmaxFits, spark: SparkSession, epochs: Sequence[int], metric: str = "val_accuracy") -> DataFrame:
    """``trial, step, epochs, <metric>`` of tuning over numbers of epochs and steps: the metric of the last fold.

    With a fixed step a short run is the beginning of a long one, so one run answers for every number of epochs.
    """
    wanted, last = list(epochs), max(f for f, _ in fits.models)
    rows = sorted((t, e, v) for f, t, e, m, v in fits.history if f == last and m == metric and e in wanted)
    return spark.createDataFrame([(i, t, e, v) for i, (t, e, v) in enumerate(rows)], f"trial INT, step INT, epochs INT, {metric} DOUBLE")
