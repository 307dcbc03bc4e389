"""Labelled tables, header-less tables and split tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rowsentry.fixed_values import LABELLED_DDL, NULL_MARKERS


def _schema(schema: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read_labelled_csv(spark: SparkSession, path: str, schema: str | T.StructType = LABELLED_DDL,
                      header: bool = True, null_markers: Sequence[str] = NULL_MARKERS) -> DataFrame:
    """All CSV files under ``path`` as one table with the given schema.

    Every spelling of a missing value becomes null, in one pass and without inference: the
    fields are read as text and cast.
    """
    wanted = _schema(schema)
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in wanted.fields])
    raw = (
        spark.read.schema(text)
        .option("header", header)
        .option("enforceSchema", not header)
        .option("ignoreLeadingWhiteSpace", True)
        .csv(path)
    )
    marks = list(null_markers)
    return raw.select(*[
        F.when(~F.trim(F.col(f.name)).isin(marks), F.col(f.name)).cast(f.dataType).alias(f.name)
        for f in wanted.fields
    ])


def read_headerless_csv(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Positional CSV: the schema supplies names and types."""
    return read_labelled_csv(spark, path, schema, header=False)


def write_splits(df: DataFrame, path: str, fmt: str = "parquet", header: bool = True) -> None:
    """One dataset laid out by ``split`` and ``fold``, so that a reader opens only its part."""
    writer = df.write.mode("overwrite").partitionBy("split", "fold")
    if fmt == "csv":
        writer.option("header", header).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown format {fmt}")


def read_split(spark: SparkSession, path: str, split: str, fold: int | None = None) -> DataFrame:
    """The rows of one split, and of one fold when given; other folders are not listed."""
    out = spark.read.parquet(path).filter(F.col("split") == split)
    return out if fold is None else out.filter(F.col("fold") == fold)


def read_if_present(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame | None:
    """The Parquet table at ``path``, or None while nothing has been written there."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
