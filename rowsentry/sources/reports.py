"""Evaluation reports, violation files and the metrics table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowsentry.fixed_values import ACCURACY_PATH

#: A violation of a column's constraint, or of a metric's floor (``column`` is then the metric).
VIOLATION_FIELDS = ("column", "check", "detail", "value", "floor")
VIOLATIONS_DDL = ("run_id STRING, window_start TIMESTAMP, violations ARRAY<STRUCT<column: STRING, check: STRING, detail: STRING, "
                  "value: DOUBLE, floor: DOUBLE>>")
METRIC_PARTS = ("source", "run_id", "window")
METRIC_COLUMNS = ("window_start", *METRIC_PARTS, "metric", "value")
METRICS_DDL = "window_start TIMESTAMP, metric STRING, value DOUBLE, source STRING, run_id STRING, window STRING"
#: Names of window folders.
WINDOW_FORMAT = "yyyy-MM-dd'T'HHmmss"


def write_eval_report(reports: DataFrame, path: str) -> None:
    """One JSON document per ``report`` row, as text lines."""
    reports.select(F.col("report").alias("value")).write.mode("overwrite").text(path)


def read_eval_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "report")


def read_report_path(report: str | Column, path: str = ACCURACY_PATH) -> Column:
    """The number at a dotted path of a JSON report."""
    return F.get_json_object(F.col(report) if isinstance(report, str) else report, f"$.{path}").cast("double")


def violation_rows(violations: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Violations of either monitor type as ``keep`` columns, ``window_start`` and the ``VIOLATION_FIELDS``.

    Rows of a data-quality check have ``column, check, detail``, those of a model-quality check ``metric, value, floor``;
    ``window_start`` is null where a run has no windows.
    """
    names = set(violations.columns)
    if "metric" in names:
        low = F.concat(F.col("metric"), F.lit(" "), F.format_string("%.6f", "value"), F.lit(" is below "), F.format_string("%.6f", "floor"))
        violations = violations.select(*keep, *[c for c in ("window_start",) if c in names], F.col("metric").alias("column"),
                                       F.lit("below_floor").alias("check"), low.alias("detail"), "value", "floor")
    kinds = dict(window_start="timestamp", column="string", check="string", detail="string", value="double", floor="double")
    return violations.select(*keep, *[
        (F.col(c) if c in violations.columns else F.lit(None)).cast(k).alias(c) for c, k in kinds.items()])


def write_violations(violations: DataFrame, path: str, run_id: str = "run_id") -> None:
    """One JSON document per run and window with the list of its violations, none of them left out.

    A window has at most one violation per check and column, which bounds its list.
    """
    named = violations.withColumnRenamed(run_id, "run_id")
    listed = violation_rows(named, ("run_id",)).groupBy("run_id", "window_start").agg(
        F.array_sort(F.collect_list(F.struct(*VIOLATION_FIELDS))).alias("violations"))
    listed.write.mode("overwrite").json(path)


def read_violations(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """``run_id, window_start`` and the fields of each violation, from documents one per line or per file."""
    docs = spark.read.schema(VIOLATIONS_DDL).option("multiLine", multi_line).json(path)
    return docs.select("run_id", "window_start", F.inline("violations"))


def write_metrics(metrics: DataFrame, path: str, source: str | Column, window: Column | str | None = None, run_id: str = "run") -> None:
    """Write ``metric, value`` rows into the long metrics table, laid out by source (a name, or a column of names), run and window.

    What a source, run and window had before is replaced, all else stays: a run or a micro-batch that is repeated leaves the
    same table.
    """
    start = F.lit(None).cast("timestamp") if window is None else (F.col(window) if isinstance(window, str) else window)
    rows = metrics.select(start.cast("timestamp").alias("window_start"), (F.lit(source) if isinstance(source, str) else source).alias("source"),
                          F.lit(run_id).alias("run_id"), F.coalesce(F.date_format(start.cast("timestamp"), WINDOW_FORMAT), F.lit("all")).alias("window"),
                          "metric", F.col("value").cast("double").alias("value"))
    replace_parts(rows, path, METRIC_PARTS)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The metrics table with its types, whatever the names of sources and runs look like."""
    return spark.read.schema(METRICS_DDL).parquet(path)


def replace_parts(rows: DataFrame, path: str, parts: Sequence[str]) -> None:
    """Write ``rows`` laid out by ``parts``; of a table that is there only the parts that ``rows`` holds are replaced."""
    rows.repartition(*parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)
