import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from rowsentry.llm import language_spans

TEXTS = {"en": "the house and the garden were empty when they came back from the long walk",
         "fr": "la maison et le jardin étaient vides quand ils sont revenus de leur longue promenade",
         "ru": "дом и сад были пусты когда они вернулись с долгой прогулки"}


def walked(evidence, penalty):
    value, back = evidence[0].copy(), []
    for row in evidence[1:]:
        switch = value.max() - penalty
        back.append(np.where(value >= switch, np.arange(len(value)), value.argmax()))
        value = np.maximum(value, switch) + row
    path = [int(value.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


@settings(max_examples=40, deadline=None)
@given(sizes=st.lists(st.integers(0, 40), max_size=6), seed=st.integers(0, 999))
def test_chunks_give_the_best_path(sizes, seed):
    bounds = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    evidence = -np.random.default_rng(seed).integers(0, 8, (int(bounds[-1]), 3)).astype(np.float32)
    old, language_spans.CHUNK = language_spans.CHUNK, 7
    try:
        path = language_spans.viterbi(evidence, bounds, 3.0)
    finally:
        language_spans.CHUNK = old
    worth = lambda e, p: e[np.arange(len(p)), p].sum() - 3.0 * (np.diff(p) != 0).sum()
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b > a:
            assert worth(evidence[a:b], path[a:b]) == pytest.approx(worth(evidence[a:b], np.array(walked(evidence[a:b], 3.0))))


@pytest.fixture(scope="module")
def model(spark):
    rows = [(t, k) for k, t in TEXTS.items() for _ in range(5)] + [(None, "en"), ("lost", None)]
    return language_spans.fit(spark.createDataFrame(rows, "text string, lang string"))


def test_spans_of_a_mixed_text(spark, model):
    text = f"{TEXTS['en']}. {TEXTS['ru']}! {TEXTS['fr']}"
    row = language_spans.label(spark.createDataFrame([(text, 1)], "text string, score int"), model).first()
    assert [s["lang"] for s in row["lang_spans"]] == ["en", "ru", "fr"]
    spans = [text[s["start"]:s["end"]] for s in row["lang_spans"]]
    assert spans[1] == TEXTS["ru"] and TEXTS["en"] == spans[0] and TEXTS["fr"].endswith(spans[2])
    assert row["lang_pred"] in TEXTS and 0 < row["score"] < 1


def test_defined_results(spark, model):
    texts = [None, "", "12 3!? 4", "漢字", TEXTS["fr"], TEXTS["fr"], "дом " * 30_000]
    got = {r["i"]: r for r in language_spans.label(spark.createDataFrame(list(enumerate(texts)), "i int, text string"), model).collect()}
    assert [got[i]["lang_pred"] for i in (0, 1, 2)] == ["und"] * 3 and got[0]["score"] == 0 and got[1]["lang_spans"] == []
    assert got[3]["lang_pred"] == "en"  # no learned language writes it: the first
    assert got[4]["lang_pred"] == "fr" and got[4].asDict() | {"i": 5} == got[5].asDict()
    assert got[6]["lang_pred"] == "ru" and len(got[6]["lang_spans"]) == 1


def test_nothing_learned_and_empty_tables(spark):
    none = language_spans.fit(spark.createDataFrame([], "text string, lang string"))
    assert language_spans.label(spark.createDataFrame([("words",)], "text string"), none).first()["lang_pred"] == "und"
    assert language_spans.label(spark.createDataFrame([], "text string"), none).count() == 0


def test_bounded_learning_is_a_share_of_each_language(spark):
    many = spark.range(400).select(F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"))
    assert language_spans.fit(many, per_language=40).languages == ["en"]


def test_marks_are_no_letters_and_all_letters_count(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr")]
    model = language_spans.fit(spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING"))
    texts = [(1, "́̂"), (2, "\U00030000\U00030001"), (3, "the ́ cat"), (4, "the ćat"), (5, "")]
    df = spark.createDataFrame([(i, t, "own") for i, t in texts], "doc_id LONG, text STRING, lang_pred STRING")
    got = {r["doc_id"]: r for r in language_spans.label(df, model).collect()}
    assert [got[i]["lang_pred"] for i, _ in texts][0] == "und" and got[1]["score"] == 0 and got[1]["lang_spans"] == []
    assert got[2]["lang_pred"] in ("en", "fr") and got[3]["lang_pred"] == got[4]["lang_pred"] == "en" and got[5]["lang_pred"] == "und"
    assert [(s["start"], s["end"]) for s in got[3]["lang_spans"]] == [(0, 9)]


def test_many_languages_keep_their_numbers():
    import numpy as np

    evidence = np.full((6, 300), -9.0, np.float32)
    evidence[:, 250] = 0
    assert language_spans.viterbi(evidence, np.array([0, 6])).tolist() == [250] * 6
