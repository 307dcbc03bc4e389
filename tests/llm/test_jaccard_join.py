import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from rowsentry.llm import components, jaccard_join


def shingles(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    return {tuple(words[i: i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc, len(sets[i]), (min(ids) if ids else None) if sets[i] else doc))
    return sorted(out, key=str)


def made(seed, n):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randint(1, 3)))
    passage = [word() for _ in range(30)]
    texts = []
    for _ in range(n):
        kind = rng.random()
        if texts and kind < 0.5:
            words = rng.choice(texts).split()
            for _ in range(rng.randint(0, 3)):
                at = rng.randrange(len(words) + 1)
                words[at: at + rng.randint(0, 1)] = [word() for _ in range(rng.randint(0, 2))]
            texts.append(" ".join(words) or word())
        elif kind < 0.7:
            texts.append(" ".join([word() for _ in range(rng.randint(0, 25))] + passage))
        else:
            texts.append(" ".join(word() for _ in range(rng.randint(1, 60))))
    return texts


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("set", F.lit("clash"))
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.join(df).collect()), key=str)
    assert got == brute(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_components_are_those_of_all_pairs(spark, seed):
    texts = made(seed, 160)
    check(spark, [(i * 7 % 160, t) for i, t in enumerate(texts)])


def test_blocks_and_runs_that_are_split(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "RUN_ROWS", 4)
    monkeypatch.setattr(jaccard_join, "CLUSTER_SHINGLES", 100)
    monkeypatch.setattr(jaccard_join, "FREQUENT_AMONG", 10_000)  # frequent shingles keep their place
    check(spark, list(enumerate(made(3, 120))))


def test_shuffled_join_of_wanted_sets(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SMALL_ROWS", 0)
    check(spark, list(enumerate(made(4, 60))))


def test_defined_results(spark):
    long = " ".join(f"w{i}" for i in range(20_000))
    check(spark, [(5, None), (6, ""), (7, " \t\n"), (8, "one two"), (3, "ONE\tTwo"), (9, "one two three"), (10, long), (4, long + " end"),
                  (11, "É a b c d e"), (12, "é a b c d e"), (None, "one two"), (None, None), (8, "one two"), (13, "a\x00b\x1cc d")])


def test_empty_table(spark):
    assert jaccard_join.join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@settings(max_examples=25, deadline=None)
@given(seed=st.integers(0, 9999))
def test_tree_loses_no_pair(seed):
    rng = np.random.default_rng(seed)
    n = 150
    points = rng.poisson(rng.choice([1, 4]), (n, 16)).astype(np.int32)
    points[n // 2:] = np.maximum(points[: n - n // 2] + rng.integers(-1, 2, (n - n // 2, 16)), 0)
    sizes = np.maximum(points.sum(axis=1), 1)
    got, most = set(), rng.choice([2, 1000])
    for x, y in jaccard_join.CountTree(np.minimum(points, most), sizes).search(np.minimum(points, most), sizes):
        got |= set(zip(x.tolist(), y.tolist()))
    for i in range(n):
        for j in range(n):
            overlap = np.minimum(points[i], points[j]).sum()
            linked = 100 * overlap >= 75 * (sizes[i] + sizes[j] - overlap) and 75 * max(sizes[i], sizes[j]) <= 100 * min(sizes[i], sizes[j])
            assert not linked or (i, j) in got


@pytest.mark.parametrize("links", [[], [(1, 1)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)] + [(70, 71), (71, 70)]])
def test_components(spark, links):
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    if len(links) == 60:
        assert got == {i: 0 for i in range(61)}
    elif len(links) > 2:
        assert got == {i: 0 for i in range(50)} | {70: 70, 71: 70}
    else:
        assert got == {}
