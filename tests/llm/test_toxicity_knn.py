import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from rowsentry.llm import toxicity_knn
from rowsentry.llm.toxicity_knn import BlockMaxIndex

WORDS = [f"{a}{b}" for a in ("ka", "lo", "mi", "ter", "on", "sal") for b in ("pa", "ra", "tu", "ven", "dor", "mik")]


@settings(max_examples=40, deadline=None)
@given(seed=st.integers(0, 10_000), k=st.integers(1, 12))
def test_block_max_neighbours_are_exact(seed, k):
    rng = np.random.default_rng(seed)
    terms = 15
    rows = [(np.sort(rng.choice(terms, rng.integers(0, 6), replace=False)), None) for _ in range(400)]
    rows = [(t, rng.integers(1, 5, len(t))) for t, _ in rows]
    idf = rng.uniform(1, 4, terms)
    index = BlockMaxIndex.build(list(range(400)), rng.integers(0, 2, 400).tolist(), rows, idf)
    matrix = np.zeros((400, terms))
    for place, i in enumerate(index.ids):
        t, c = rows[i]
        matrix[place, t] = BlockMaxIndex.unit(t, c, idf)
    t, c = rows[int(rng.integers(400))]
    q = np.zeros(terms)
    q[t] = BlockMaxIndex.unit(t, c, idf)
    score = matrix @ q
    want = [p for p in np.lexsort((np.arange(400), -np.round(score, 12))) if score[p] > 0][:k]
    places, cosines = index.nearest(t, c, k)
    assert places.tolist() == want and cosines == pytest.approx(score[want])


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(0)
    rows, labels = [], []
    for i in range(400):
        text = rng.choice(WORDS, 40).tolist()
        toxic = i % 5 == 0
        if toxic:
            text[3:3] = rng.choice(["scoundrel", "blockhead", "nitwit"], 2).tolist()
        rows.append((i, " ".join(text), "clash"))
        if i % 4:
            labels.append((i, int(toxic)))
    rows += [(900, None, ""), (901, "", ""), (902, "!!", ""), (903, "nitwit " * 20_000, ""), (0, rows[0][1], "")]
    return (spark.createDataFrame(rows, "doc_id long, text string, score string"),
            spark.createDataFrame([*labels, (None, 1), (5000, None)], "doc_id long, toxic int"))


def test_unseen_toxic_texts_are_found_and_clean_ones_left(corpus):
    got = toxicity_knn.classify(*corpus).collect()
    assert len(got) == 405
    by = {r["doc_id"]: r for r in got}
    assert all(r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in got)
    unseen = [i for i in range(400) if i % 4 == 0]
    assert np.mean([by[i]["predicted"] == (i % 5 == 0) for i in unseen]) >= 0.97
    assert by[903]["predicted"] == 1 and all(e["label"] == 1 for e in by[903]["evidence"])
    assert by[900]["score"] == by[901]["score"] == by[902]["score"] < 0.5 and by[900]["evidence"] == []
    assert len({(r["score"]) for r in got if r["doc_id"] == 0}) == 1


def test_without_both_labels_or_rows(spark, corpus):
    docs, labels = corpus
    assert {r["score"] for r in toxicity_knn.classify(docs, labels.filter("toxic = 0")).collect()} == {0.0}
    assert {r["score"] for r in toxicity_knn.classify(docs, labels.filter("toxic = 9")).collect()} == {0.0}
    assert toxicity_knn.classify(docs.filter("false"), labels).count() == 0


def test_only_verified_copies_of_a_label_are_one_example(spark):
    rng = np.random.default_rng(1)
    base = rng.choice(WORDS, 60).tolist()
    other = [f"x{k}" for k in range(60)]
    rows = [(1, 0, " ".join(base)), (2, 1, " ".join([*base[:30], "nitwit", *base[30:]])), (3, 0, " ".join([*base, "more"])),
            (4, 0, " ".join(base)), (5, 1, " ".join(base))]
    # Half of each of these texts is the same: any least triple may be shared, though none is a copy.
    rows += [(10 + k, 1, " ".join([*other, *(f"y{k}_{j}" for j in range(60))])) for k in range(20)]
    got = toxicity_knn.distinct_examples(spark.createDataFrame(rows, "example_id long, label int, text string")).collect()
    assert sorted(r["example_id"] for r in got) == [1, 2, *range(10, 30)]


def test_toxic_texts_that_are_edited_copies_of_clean_ones_are_found(spark):
    rng = np.random.default_rng(2)
    docs, labels = [], []
    for i in range(150):
        text = rng.choice(WORDS, 40).tolist()
        docs += [(2 * i, " ".join(text)), (2 * i + 1, " ".join([*text, "scoundrel"]))]
        if i % 3:
            labels += [(2 * i, 0), (2 * i + 1, 1)]
    got = toxicity_knn.classify(spark.createDataFrame(docs, "doc_id long, text string"),
                                spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    unseen = [r for r in got if r["doc_id"] // 2 % 3 == 0]
    assert np.mean([r["predicted"] == r["doc_id"] % 2 for r in unseen]) >= 0.95
