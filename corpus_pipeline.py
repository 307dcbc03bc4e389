"""The corpus pipeline: documents in, token ids of clean and distinct documents out.

Each stage calls one operator of ``rowsentry.llm`` on all rows its predecessor kept, its result is written as Parquet to the
shared folder and read again as the next stage's documents. All stages but the last return the columns of the documents.
Stages handle null and empty texts, repeated rows, empty tables and other columns as their operators say; rows without an id stay
unless their text itself is rejected.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsentry.llm import byte_bpe, decontaminate, jaccard_join, quality_cotraining, secret_scan
from rowsentry.llm.common import settle

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Ids that a stage broadcasts at most; more are joined by a shuffle.
SMALL_ROWS = 300_000


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents whose id is not in ``ids``; documents without an id stay."""
    ids = settle(ids.select(F.col("doc_id").alias("gone")).dropna().distinct())
    if ids.count() <= SMALL_ROWS:
        ids = F.broadcast(ids)
    return docs.join(ids, docs["doc_id"] == ids["gone"], "left_anti")


def _free(docs: DataFrame, name: str) -> str:
    """A column name that the documents do not have yet."""
    while name in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    facts = docs.select("doc_id", "text", "lang", "source")
    scored = quality_cotraining.classify(facts, labels)
    return _without(docs, scored.filter(~F.col("keep")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    groups = jaccard_join.join(docs.select("doc_id", "text"))
    return _without(docs, groups.filter(F.col("doc_id") != F.col("component_id")))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    held = _free(docs, "benchmark_items")
    return decontaminate.find(docs, items, output=held).filter(F.size(held) == 0).select(docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are taken out of the texts; ``n_chars`` follows."""
    spans = _free(docs, "spans")
    found = secret_scan.scan(docs, secret_scan.fit(docs), output=spans)
    some = F.size(spans) > 0
    found = found.withColumn("text", F.when(some, secret_scan.redacted(F.col("text"), F.col(spans))).otherwise(F.col("text")))
    return found.withColumn("n_chars", F.when(some, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether they decode to it."""
    path = public_tokenizers.path(RANKS)
    coded = byte_bpe.encode_and_decode(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN)
    whole = F.coalesce("text", F.lit("")).cast("binary") == F.col("decoded")
    return coded.select("doc_id", byte_bpe.token_count().alias("n_tokens"), "tokens", whole.alias("round_trip"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("benchmark", benchmark), ("secrets", secrets), ("tokens", tokens),
]

#: Co-training, Markov models and byte-pair merges are beyond SQL: tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
