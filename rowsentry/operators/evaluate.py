"""Accuracy, reports, confusion matrices and multiclass quality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rowsentry.functions.names import as_list

OVERALL_METRICS = ("accuracy", "weighted_precision", "weighted_recall", "weighted_f1")


def accuracy(df: DataFrame, truth: str = "truth", prediction: str = "prediction",
             by: str | Sequence[str] = ()) -> DataFrame:
    """Share of rows whose prediction equals the truth; a missing prediction is wrong."""
    hit = F.coalesce((F.col(truth) == F.col(prediction)).cast("double"), F.lit(0.0))
    return df.groupBy(*as_list(by)).agg(F.avg(hit).alias("accuracy"))


def predictions_by_model(df: DataFrame, truth: str, predictions: dict[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per model and source row from one prediction column per model (a single scan)."""
    each = [F.struct(F.lit(model).alias("model"), F.col(c).alias("prediction")) for model, c in predictions.items()]
    return df.select(*keep, F.col(truth).alias("truth"), F.inline(F.array(*each)))


def evaluate_models(predictions: DataFrame, truth: str = "truth", prediction: str = "prediction",
                    model: str = "model", by: str | Sequence[str] = ()) -> DataFrame:
    """Accuracy of every model on the same rows, in one pass."""
    return accuracy(predictions, truth, prediction, [*as_list(by), model])


def eval_report(accuracies: DataFrame, model: str = "model", by: str | Sequence[str] = ()) -> DataFrame:
    """``{"metrics": {"accuracy": {model: value, …}}}`` as one ``report`` text (per ``by``)."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(model).alias("key"), F.col("accuracy").alias("value"))))
    grouped = accuracies.groupBy(*as_list(by)).agg(F.map_from_entries(entries).alias("m"))
    nested = F.struct(F.struct(F.col("m").alias("accuracy")).alias("metrics"))
    return grouped.select(*as_list(by), F.to_json(nested).alias("report"))


def confusion_matrix(df: DataFrame, truth: str = "truth", prediction: str = "prediction",
                     by: str | Sequence[str] = ()) -> DataFrame:
    """Rows per (truth, prediction): ``n``. Partial counts are taken before the shuffle."""
    t, p = F.col(truth).cast("string").alias("truth"), F.col(prediction).cast("string").alias("prediction")
    return df.groupBy(*as_list(by), t, p).agg(F.count("*").alias("n"))


def _ratio(a, b):
    return F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))


def class_metrics(matrix: DataFrame, by: str | Sequence[str] = ()) -> DataFrame:
    """Per class ``support, predicted, hits, precision, recall, f1`` from a confusion matrix."""
    by = as_list(by)
    hit = F.when(F.col("truth") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("bigint")
    as_truth = F.struct(F.col("truth").alias("label"), F.col("n").alias("s"), zero.alias("p"), hit.alias("h"))
    as_guess = F.struct(F.col("prediction").alias("label"), zero.alias("s"), F.col("n").alias("p"), zero.alias("h"))
    summed = (
        matrix.select(*by, F.inline(F.array(as_truth, as_guess)))
        .filter("label IS NOT NULL")
        .groupBy(*by, "label")
        .agg(F.sum("s").alias("support"), F.sum("p").alias("predicted"), F.sum("h").alias("hits"))
    )
    precision = _ratio(F.col("hits"), F.col("predicted"))
    recall = _ratio(F.col("hits"), F.col("support"))
    return (
        summed.withColumn("precision", precision).withColumn("recall", recall)
        .withColumn("f1", _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    )


def multiclass_metrics(matrix: DataFrame, by: str | Sequence[str] = ()) -> DataFrame:
    """``metric, value`` rows: accuracy and support-weighted precision, recall and F1."""
    by = as_list(by)
    total = F.sum("support")

    def weighted(c: str):
        return _ratio(F.sum(F.col("support") * F.col(c)), total)

    values = [_ratio(F.sum("hits"), total), weighted("precision"), weighted("recall"), weighted("f1")]
    pairs = [F.struct(F.lit(n).alias("metric"), v.cast("double").alias("value")) for n, v in zip(OVERALL_METRICS, values)]
    return class_metrics(matrix, by).groupBy(*by).agg(F.array(*pairs).alias("m")).select(*by, F.inline("m"))


def suggest_model_constraints(metrics: DataFrame) -> DataFrame:
    """The baseline's metric values as floors: ``metric, floor``."""
    return metrics.select("metric", F.col("value").alias("floor"))


def check_model_quality(current: DataFrame, constraints: DataFrame, by: str | Sequence[str] = ()) -> DataFrame:
    """Current metrics below their floor: ``metric, value, floor``."""
    # One row per metric name, of which there are len(OVERALL_METRICS).
    floors = F.broadcast(constraints.select("metric", "floor"))
    return current.join(floors, "metric").filter("value < floor").select(*as_list(by), "metric", "value", "floor")


def batch_score_with_source(df: DataFrame, truth: str, prediction: str = "prediction", conf: str = "confidence") -> DataFrame:
    """Truth, prediction and confidence of each scored row; input and output share the row."""
    return df.select(F.col(truth).alias("truth"), F.col(prediction).alias("prediction"), F.col(conf).alias("confidence"))
