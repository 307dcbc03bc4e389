import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rowsentry.llm import queries

NAMES = ["quality_cotraining", "substring_dedup", "ann_scan", "decontaminate", "toxicity_knn", "byte_bpe", "secret_scan", "jaccard_join",
         "warc_revisit", "language_spans"]
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_every_operator_has_one_query():
    assert sorted(queries.QUERIES) == sorted(f"op{i}_{n}" for i, n in enumerate(NAMES, 1))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice(["ka", "lo", "mi", "ter", "on", "sal", "ven"]) for _ in range(rng.randint(1, 4)))
    good = lambda n: ". ".join(" ".join(word() for _ in range(8)) for _ in range(n)) + "."
    items = [(i, good(6)) for i in range(3)]
    docs, labels = [], []
    for i in range(150):
        bad = i % 5 == 0
        text = " ".join(word().upper() + "!!" for _ in range(40)) if bad else good(8)
        if i == 7:
            text += " " + items[1][1]
        if i == 8:
            text += " password=hunter2hunter2 end."
        docs.append((i, text, "en", f"s{i % 4}", len(text)))
        labels.append((i, int(not bad), 0))
    docs += [(200, docs[1][1], "fr", "s1", 1), (201, docs[2][1] + " one more word.", None, None, 2), (202, None, None, None, None), (1, docs[1][1], "en", "s1", 3)]
    base = tmp_path_factory.mktemp("pipeline")
    for name, rows, kind in (("documents", docs, "doc_id long, text string, lang string, source string, n_chars long"),
                             ("labels", labels, "doc_id long, quality int, toxic int"), ("benchmark", items, "item_id long, text string")):
        spark.createDataFrame(rows, kind).withColumn("spans" if name == "documents" else "more", F.lit("clash")).write.parquet(f"{base}/{name}.parquet")
    return str(base)


def test_stages_do_what_they_say(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.settle(stage(spark, docs, folder))
        assert docs.columns == [*COLUMNS, "spans"]
        kept[name] = sorted(r["doc_id"] for r in docs.select("doc_id").collect())
    clean = {i for i in range(150) if i % 5}
    assert clean | {200, 201, 1} <= set(kept["quality"]) and not {i for i in range(150) if i % 5 == 0} & set(kept["quality"])
    assert set(kept["near_duplicates"]) - {202} == clean
    assert set(kept["benchmark"]) - {202} == clean - {7}
    row = docs.filter("doc_id = 8").first()
    assert row["text"].endswith(" [secret] end.") and row["n_chars"] == len(row["text"]) and row["spans"] == "clash"
    assert docs.filter("doc_id = 9").first()["n_chars"] == len(docs.filter("doc_id = 9").first()["text"])
    out = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert out.filter("NOT round_trip").count() == 0 and out.count() == docs.count()
    assert corpus_pipeline.run(spark, folder).count() == out.count()


def test_stages_on_empty_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0


def test_ranks_file_is_a_public_one():
    assert public_tokenizers.path(corpus_pipeline.RANKS).endswith(queries.RANKS)
