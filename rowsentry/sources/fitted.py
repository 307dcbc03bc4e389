"""Fitted feature values as a table on disk."""

from __future__ import annotations

from pyspark.sql import SparkSession

from rowsentry.operators.features import FITTED_DDL, FittedColumns, fitted_from_rows, fitted_rows


def save_fitted(spark: SparkSession, fitted: FittedColumns, path: str) -> None:
    """Write the fitted values of all folds as one Parquet table, in one file where no column has many categories."""
    rows = fitted_rows(spark, fitted)
    (rows if fitted.large else rows.coalesce(1)).write.mode("overwrite").parquet(path)


def load_fitted(spark: SparkSession, path: str, fold: int | None = None) -> FittedColumns:
    """The fitted values of all folds, or those of one, ready for rows without a fold column."""
    table = spark.read.schema(FITTED_DDL).parquet(path)
    whole = fitted_from_rows(table)
    return whole if fold is None else whole.only(fold)
