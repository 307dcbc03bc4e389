"""Model responses and rendered predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rowsentry.fixed_values import CSV_TYPE, JSON_TYPE, NO_RESPONSE, PREDICTIONS_DDL
from rowsentry.functions.names import as_list
from rowsentry.functions.text import csv_line, quoted
from rowsentry.sources.requests import _fail_or_keep


def parse_model_response(df: DataFrame, body: str = "body", content_type: str = "content_type",
                         strict: bool = False) -> DataFrame:
    """One row per probability vector of each response: ``row_no``, ``probabilities``, ``error``."""
    ct = F.col(content_type)
    empty = F.col(body).isNull() | (F.length(body) == 0)
    vectors = F.from_json(body, PREDICTIONS_DDL)["predictions"]
    others = [c for c in df.columns if c != body]
    error = (
        F.when(empty, F.lit(NO_RESPONSE))
        .when(~F.coalesce(ct == JSON_TYPE, F.lit(False)),
              F.concat(F.coalesce(ct, F.lit("null")), F.lit(" is not supported.")))
        .when(F.col("_vectors").isNull(), F.lit("The response holds no predictions."))
    )
    out = (
        df.withColumn("_vectors", vectors)
        .withColumn("error", error)
        .select(*others, "error",
                F.posexplode_outer(F.when(F.col("error").isNull(), F.col("_vectors"))).alias("row_no", "probabilities"))
        .withColumn("row_no", F.coalesce("row_no", F.lit(0)))
    )
    return _fail_or_keep(out, strict)


def render_instances(df: DataFrame, features: str | list[str], request: str | None = None,
                     position: str = "row_no") -> DataFrame:
    """Feature rows as ``{"instances": [[…], …]}``: one body per row, or per ``request`` id."""
    vector = F.array(*[F.col(c).cast("double") for c in as_list(features)])
    if request is None:
        return df.withColumn("body", F.to_json(F.struct(F.array(vector).alias("instances"))))
    pairs = F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), vector.alias("v"))))
    return (
        df.groupBy(request).agg(pairs.alias("pairs"))
        .select(request, F.to_json(F.struct(F.col("pairs.v").alias("instances"))).alias("body"))
    )


def render_predictions(df: DataFrame, request: str = "inference_id", accept: str = "accept",
                       prediction: str = "prediction", conf: str = "confidence",
                       position: str = "row_no", rows: str = "n_rows", strict: bool = False) -> DataFrame:
    """The answer of each request in the type it accepts, exactly once: ``response`` or ``error``.

    CSV is one ``class,confidence`` line per row, a null an empty field and texts quoted where they must be. JSON is a list
    of ``{"0": class, "1": confidence}``, or that object alone when the request had a single row. A request is refused as a
    whole if one of its rows has an ``error`` (the first by position is told) or is not there.

    Requests known to have a single row (column ``rows``) are rendered where they are, without a
    shuffle. The rows of a longer one are brought together by its id, which must be unique: such
    a request is one message, and the largest unit that is gathered.
    """
    kind = F.col(accept)
    line = csv_line(quoted(F.col(prediction).cast("string")), conf)
    object_ = F.to_json(F.struct(F.col(prediction).alias("0"), F.col(conf).alias("1")))
    refused = F.when(~F.coalesce(kind.isin(CSV_TYPE, JSON_TYPE), F.lit(False)),
                     F.concat(F.coalesce(kind, F.lit("null")), F.lit(" accept type is not supported.")))

    def answer(csv: Column, json: Column) -> Column:
        return F.when(kind == CSV_TYPE, csv).when(kind == JSON_TYPE, json)

    failed = F.col("error") if "error" in df.columns else F.lit(None).cast("string")
    several = df
    if rows in df.columns:
        several = df.filter(F.col(rows) > 1)
        wrong = F.coalesce(failed, refused)
        single = df.filter(F.col(rows) == 1).select(
            request, accept, F.when(wrong.isNull(), answer(line, object_)).alias("response"), wrong.alias("error"))
    item = F.struct(F.col(position).alias("p"), line.alias("line"), object_.alias("object"))
    wanted = F.max(F.col(rows).cast("long")) if rows in df.columns else F.count("*")
    grouped = several.groupBy(request, accept).agg(
        F.array_sort(F.collect_list(item)).alias("rows"), wanted.alias("wanted"), F.min_by(failed, F.when(failed.isNotNull(), F.col(position))).alias("failed"))
    objects = F.array_join("rows.object", ",")
    listed = F.when(F.col("wanted") == 1, objects).otherwise(F.concat(F.lit("["), objects, F.lit("]")))
    nameless = F.when(F.col(request).isNull(), F.lit("A request of several rows needs an id."))
    partial = F.when(F.size("rows") != F.col("wanted"), F.lit("Rows of the request are missing."))
    wrong = F.coalesce(refused, nameless, F.col("failed"), partial)
    out = grouped.select(
        request, accept, F.when(wrong.isNull(), answer(F.array_join("rows.line", "\n"), listed)).alias("response"), wrong.alias("error"))
    if rows in df.columns:
        out = single.unionByName(out)
    return _fail_or_keep(out, strict)
