import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from rowsentry.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, "rb") as f:
        return byte_bpe.Encoder(byte_bpe.Vocabulary(f.read()), public_tokenizers.PATTERN)


@settings(max_examples=80, deadline=None)
@given(texts=st.lists(st.text(max_size=80) | st.text("ab ", max_size=400) | st.none(), max_size=6))
def test_ids_are_those_of_the_library(encoder, reference, texts):
    ids, counts = encoder.encode(texts)
    parts = np.split(ids, np.cumsum(counts)[:-1]) if texts else []
    assert [p.tolist() for p in parts] == [reference.encode_ordinary(t or "") for t in texts]


def test_words_longer_than_any_matrix(encoder, reference):
    rng = np.random.default_rng(3)
    text = "".join(rng.choice(list("abcdefgh"), 20_000)) + " " + "the" * 3000 + " " + "é" * 700
    assert encoder.encode([text])[0].tolist() == reference.encode_ordinary(text)


def test_store_of_words_starts_anew(encoder, reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "KEPT_WORDS", 3)
    for text in ("one two three four", "five six one", "two"):
        assert encoder.encode([text])[0].tolist() == reference.encode_ordinary(text)


def test_round_trip_on_a_table(spark, reference):
    texts = [None, "", "<|endoftext|> it's  two\n\nlines ", "日本語 emoji 😀", "same", "same"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").withColumn("TOKENS", F.lit("clash"))
    both = byte_bpe.decode(byte_bpe.encode(df, PATH, public_tokenizers.PATTERN), PATH)
    for r in both.withColumn("n", byte_bpe.token_count()).collect():
        ids = reference.encode_ordinary(texts[r["doc_id"]] or "")
        assert r["n"] == len(ids) and bytes(r["tokens"]) == np.array(ids, "<u4").tobytes()
        assert bytes(r["decoded"]) == (texts[r["doc_id"]] or "").encode()
    assert hashlib.sha256(b"").hexdigest() == both.filter("doc_id = 0").select(F.sha2("tokens", 256)).first()[0]


def test_empty_table_and_unknown_ids(spark):
    empty = spark.createDataFrame([], "doc_id int, text string")
    assert byte_bpe.encode(empty, PATH, public_tokenizers.PATTERN).count() == 0
    with pytest.raises(Exception, match="not in the vocabulary"):
        byte_bpe.decode(spark.createDataFrame([(bytes([255] * 4),)], "tokens binary"), PATH).collect()


def test_one_pass_gives_what_two_give(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([None, "", "it's  two\n\nlines", "日本語 😀"])], "doc_id int, text string") \
        .withColumn("TOKENS", F.lit("clash")).withColumn("Decoded", F.lit("clash"))
    one = byte_bpe.encode_and_decode(df, PATH, public_tokenizers.PATTERN)
    two = byte_bpe.decode(byte_bpe.encode(df, PATH, public_tokenizers.PATTERN), PATH)
    assert one.columns == two.columns and sorted(one.collect(), key=lambda r: r['doc_id']) == sorted(two.collect(), key=lambda r: r['doc_id'])
    with pytest.raises(ValueError, match="another name"):
        byte_bpe.encode_and_decode(df, PATH, public_tokenizers.PATTERN, "text", "tokens", "TEXT")


def test_registered_queries_have_one_python_step(spark):
    import corpus_pipeline
    from rowsentry.llm.queries import QUERIES

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for out in (QUERIES["op6_byte_bpe"](spark, "/root/testdata/sf0.001"), corpus_pipeline.tokens(spark, docs, "")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("MapInArrow") == 1, plan
