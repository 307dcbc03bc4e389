"""The list of bound queries."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register the function under its own name, with its SQL twin when it has one."""

    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def scratch(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; only a local session may name none, and gets one of its own machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is unset; name a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="bindings-")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The line key of lineitem: unique, and spelled alike by both engines.
LINE_KEY_SQL = "concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE))"


def split_sql(source: str, label: str, key: str, seed: str, percent: int = 20, fold: str = "0",
              keep: str = "*", other: str = "test") -> str:
    """A SELECT of ``source`` with ``split``: exact stratified quotas over the md5 order."""
    return f"""
      SELECT {keep}, CASE WHEN rk <= quota THEN 'train' ELSE '{other}' END AS split
      FROM (
        SELECT r.*, q.quota, row_number() OVER (
                 PARTITION BY r.fold_, r.label_ ORDER BY md5(concat_ws('|', {seed}, r.key_)), r.key_) AS rk
        FROM (SELECT s.*, {label} AS label_, CAST({key} AS VARCHAR) AS key_, {fold} AS fold_ FROM ({source}) s) r
        JOIN (
          SELECT fold_, label_, base + CASE WHEN row_number() OVER (
                   PARTITION BY fold_ ORDER BY rest DESC, label_) <= short THEN 1 ELSE 0 END AS quota
          FROM (
            SELECT fold_, label_, (c * ntr) // n AS base, (c * ntr) % n AS rest,
                   ntr - CAST(sum((c * ntr) // n) OVER (PARTITION BY fold_) AS BIGINT) AS short
            FROM (
              SELECT fold_, label_, c, n, n - (n * {percent} + 99) // 100 AS ntr
              FROM (SELECT fold_, label_, count(*) AS c,
                           CAST(sum(count(*)) OVER (PARTITION BY fold_) AS BIGINT) AS n
                    FROM (SELECT {label} AS label_, {fold} AS fold_ FROM ({source}) s) g
                    GROUP BY fold_, label_)
            )
          )
        ) q ON r.fold_ = q.fold_ AND r.label_ = q.label_
      )"""
