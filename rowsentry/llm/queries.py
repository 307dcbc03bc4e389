"""The operators on their whole tables, with production parameters, and SQL twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsentry.llm import ann_scan, byte_bpe, context_mixing, decontaminate, embedding_whitening, jaccard_join, language_spans, quality_cotraining, secret_scan, substring_dedup, token_alignment, toxicity_knn, warc_revisit

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

RANKS = "byte_bpe_multi_50k.tiktoken"
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(RANKS)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = byte_bpe.encode_and_decode(docs, path, public_tokenizers.PATTERN)
    return both.select("doc_id", byte_bpe.token_count().alias("n_tokens"), F.sha2("tokens", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


@query()
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs, secret_scan.fit(docs))
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    counts = [F.size(of(k)).cast("long").alias(f"n_{secret_scan.KINDS[k]}") for k in range(4)]
    return found.select("doc_id", *counts, F.sha2(secret_scan.listed(of(0, 1, 2)), 256).alias("base_sha256"),
                        secret_scan.listed(F.col("spans")).alias("spans"))


_BITS = ("array_to_string([substr('0000000100100011010001010110011110001001101010111100110111101111', "
         "4 * instr('0123456789abcdef', substr(hex, CAST(k AS INT), 1)) - 3, 4) FOR k IN range(1, 41)], '')")
_FIVE = " + ".join(f"{16 >> j} * CAST(substr(bits, CAST(5 * i + {j + 1} AS INT), 1) AS INT)" for j in range(5))


@query(f"""
  WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
  b AS (SELECT page_id, payload_bytes, max(page_id) OVER (PARTITION BY hex) AS original, {_BITS} AS bits FROM p)
  SELECT page_id, payload_bytes,
         array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + {_FIVE} AS INT), 1) FOR i IN range(32)], '')
           AS payload_digest,
         CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
         CASE WHEN page_id = original THEN NULL ELSE original END AS refers_to
  FROM b""")
def op9_warc_revisit(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = warc_revisit.resolve(table(spark, sf_dir, "pages"), min_bytes=0)
    manifest = warc_revisit.write_archives(resolved)
    back = warc_revisit.read_archives(spark, manifest, payloads=False)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op10_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = language_spans.fit(docs.filter(F.crc32(F.col("doc_id").cast("string")) % 4 != 2))
    found = language_spans.label(docs.select("doc_id", "text", held_out.alias("held_out")), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


@query()
def op5_toxicity_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce(fold == 0, F.lit(False)).alias("held_out"))
    learned = table(spark, sf_dir, "labels").filter(fold != 0)
    return toxicity_knn.classify(docs, learned).select("doc_id", "held_out", "score", "predicted")


@query()
def op3_ann_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_scan.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


@query()
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("benchmark_items").alias("m")) \
        .select("doc_id", "m.item_id", "m.start", "m.end", "m.windows", "m.edits")


@query()
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


@query()
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeats(table(spark, sf_dir, "documents"))


@query()
def op1_quality_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_cotraining.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "text_chance", "meta_chance", "quality_score", "keep")


@query()
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = embedding_whitening.whiten(table(spark, sf_dir, "embeddings"))
    rows = white.select("vec_id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("k", "of"))
    return rows.select("vec_id", (F.col("k") + 1).cast("int").alias("component"), "n", "deviation", "of.whitened", "of.explained", "identity_error")


@query()
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = token_alignment.align(docs, *(public_tokenizers.path(name) for name in ALIGNED))
    return out.select("doc_id", *token_alignment.OUTPUTS[:-1],
                      F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise(F.lit("")).alias("groups_sha256"))


@query()
def op13_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = F.crc32(F.col("doc_id").cast("string")) % 10
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce(fold == 0, F.lit(False)).alias("held_out"))
    out = context_mixing.score(docs, fold != 0)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
