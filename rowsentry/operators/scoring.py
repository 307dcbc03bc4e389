"""Scoring tables and requests, with a Spark model or a user's own functions."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from rowsentry.fixed_values import FEATURE_DDL
from rowsentry.functions.arrays import argmax, confidence, decode_label
from rowsentry.operators.features import FittedColumns, category_codes, feature_columns, transform_with
from rowsentry.operators.sizing import kept
from rowsentry.sources.requests import parse_requests
from rowsentry.sources.responses import render_predictions


def as_vector(df: DataFrame, cols: Sequence[str], name: str = "features") -> DataFrame:
    """Add the columns as one vector."""
    return df.withColumn(name, array_to_vector(F.array(*[F.col(f"`{c}`").cast("double") for c in cols])))


@dataclass(frozen=True)
class SoftmaxModel:
    """A linear model with given weights, one row of ``coefficients`` and one of ``intercepts`` per class.

    Its probabilities are one JVM expression over the vector, the same on any cluster. Use it where :func:`predict_proba` takes a model.
    """

    coefficients: Sequence[Sequence[float]]
    intercepts: Sequence[float]
    features: str = "features"

    @classmethod
    def of(cls, model) -> SoftmaxModel:
        """The weights of a trained multinomial logistic model."""
        return cls(model.coefficientMatrix.toArray().tolist(), model.interceptVector.toArray().tolist(), model.getFeaturesCol())

    def getFeaturesCol(self) -> str:
        return self.features

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``probability``, a vector; null where the features are null."""
        def score(row: Sequence[float], start: float) -> Column:
            products = F.zip_with("_x", F.array(*[F.lit(float(w)) for w in row]), lambda x, w: x * w)
            return F.aggregate(products, F.lit(float(start)), lambda a, v: a + v)

        scores = F.array(*[score(row, start) for row, start in zip(self.coefficients, self.intercepts, strict=True)])
        # Differences to the largest score: no exponential overflows.
        parts = F.transform("_s", lambda v: F.exp(v - F.array_max("_s")))
        total = F.aggregate("_e", F.lit(0.0), lambda a, v: a + v)
        out = df.withColumn("_x", vector_to_array(self.features)).withColumn("_s", scores).withColumn("_e", parts)
        share = F.when(F.col("_x").isNotNull(), array_to_vector(F.transform("_e", lambda v: v / total)))
        return out.withColumn("probability", share).drop("_x", "_s", "_e")


def predict_proba(model, df: DataFrame, name: str = "probabilities") -> DataFrame:
    """Add the model's class probabilities as an array; other model outputs are dropped."""
    scored = model.transform(df)
    return scored.withColumn(name, vector_to_array("probability")).select(*df.columns, name)


def argmax_confidence(df: DataFrame, domain: Sequence[str] | None = None, probabilities: str = "probabilities") -> DataFrame:
    """Add ``prediction`` (the class, or its code without a domain) and ``confidence``."""
    code = argmax(probabilities)
    guess = decode_label(code, domain) if domain else code
    return df.withColumn("prediction", guess).withColumn("confidence", confidence(probabilities))


def score_rows(df: DataFrame, fitted: FittedColumns, model, domain: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Raw feature rows to ``keep`` columns, ``prediction`` and ``confidence``: a map-only plan."""
    ready = as_vector(transform_with(df, fitted, keep=keep, unseen="keep"), fitted.feature_names)
    scored = argmax_confidence(predict_proba(model, ready.select(*keep, "features")), domain)
    return scored.select(*keep, "prediction", "confidence")


def score_by_models(df: DataFrame, fitted: dict[int, FittedColumns], models: dict, domain: Sequence[str], label: str,
                    keep: Sequence[str] = ()) -> DataFrame:
    """Every row scored by each fold's model with that fold's fit, in one scan.

    Rows of ``keep``, ``model`` (``model_<fold>``), ``truth``, ``prediction`` and ``confidence``.
    """
    vectors = [array_to_vector(F.array(*feature_columns(fitted[f]))).alias(f"_v{f}") for f in models]
    rows = df.select(*keep, F.col(label).alias("truth"), *vectors)
    for f, model in models.items():
        named = rows.withColumnRenamed(f"_v{f}", model.getFeaturesCol())
        rows = predict_proba(model, named, f"_p{f}").drop(model.getFeaturesCol())
    each = [
        F.struct(F.lit(f"model_{f}").alias("model"), decode_label(argmax(f"_p{f}"), domain).alias("prediction"),
                 confidence(f"_p{f}").alias("confidence")) for f in models
    ]
    return rows.select(*keep, "truth", F.inline(F.array(*each)))


def score_requests(requests: DataFrame, fitted: FittedColumns, model, domain: Sequence[str],
                   schema: str = FEATURE_DDL, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Requests (``inference_id, content_type, accept, body``) to answers.

    Returns ``(scored, rejected)``: one prediction per readable row, and one row per unreadable
    one with its ``error``. A row with a missing value, in a number or a text, or with an unknown category is rejected: a
    prediction from half a row would look like any other. :func:`answer_requests` answers from both. The bodies are read once: the
    read rows of a table are written, as every answer asks four times for a part of them.
    """
    parsed = parse_requests(requests, schema, strict=strict)
    checked, codes = category_codes(parsed, fitted)
    missing = F.lit(False)
    for c in (*fitted.numeric, *fitted.categorical):
        missing = missing | F.col(c).isNull()
    unknown = F.lit(False)
    for code in codes:
        unknown = unknown | (F.col(code) < 0)
    error = (
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(missing | unknown, F.lit("Error transforming the input data."))
    )
    checked = checked.withColumn("error", error).drop(*codes)
    if not checked.isStreaming:
        checked = kept(checked)
    keys = ["inference_id", "row_no", "n_rows", "accept"]
    good = checked.filter("error IS NULL")
    bad = checked.filter("error IS NOT NULL").select(*keys, "error")
    return score_rows(good, fitted, model, domain, keys), bad


def answer_requests(scored: DataFrame, rejected: DataFrame | None = None) -> DataFrame:
    """One ``response`` or ``error`` per request: a request with a rejected row is refused as a whole."""
    if rejected is not None:
        scored = scored.unionByName(rejected, allowMissingColumns=True)
    return render_predictions(scored)


def score_with(df: DataFrame, load: Callable, parse: Callable, predict: Callable, render: Callable,
               schema: str) -> DataFrame:
    """Score with four user functions, Arrow batch by Arrow batch.

    ``load() -> model`` runs once per task; then per batch ``parse(frame) -> inputs``,
    ``predict(inputs, model) -> outputs`` and ``render(frame, outputs) -> frame`` of ``schema``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for frame in batches:
            yield render(frame, predict(parse(frame), model))

    return df.mapInPandas(run, schema)
