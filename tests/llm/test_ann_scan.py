import numpy as np
import pytest
from pyspark.sql import functions as F

from rowsentry.llm import ann_scan


def brute(ids, x, queries, k):
    out = {}
    for q in queries:
        score = x @ x[np.flatnonzero(ids == q)[0]]
        other = np.flatnonzero(ids != q)
        out[q] = ids[other[np.lexsort((ids[other], -np.round(score[other], 9)))]][:k].tolist()
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 24)) * rng.uniform(0.5, 2, size=(1500, 1))
    x[200:700] = x[100]  # a third are copies
    ids = rng.permutation(1500)
    return ids, x, spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")


def test_recall_and_exact_scores(cloud, monkeypatch):
    ids, x, df = cloud
    monkeypatch.setattr(ann_scan, "BLOCK_VECTORS", 200)
    monkeypatch.setattr(ann_scan, "BLOCK_QUERIES", 16)
    got = answers(ann_scan.search(df.withColumn("list", F.lit("clash")), F.col("id") % 20 == 0))
    want = brute(ids, x, [i for i in ids.tolist() if i % 20 == 0], 20)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    recall = np.mean([len({v for v, _ in got[q]} & set(want[q])) / 20 for q in want])
    assert recall >= 0.9
    of = {int(i): v for i, v in zip(ids, x)}
    assert all(s == pytest.approx(float((of[q] * of[v]).sum()), abs=1e-12) for q, rows in got.items() for v, s in rows)
    assert all(rows == sorted(rows, key=lambda r: (-r[1], r[0])) for rows in got.values())


def test_all_lists_probed_are_exact(cloud):
    ids, x, df = cloud
    got = answers(ann_scan.search(df, F.col("id") % 100 == 0, probe_share=1.0, epsilon=50.0))
    want = brute(ids, x, [i for i in ids.tolist() if i % 100 == 0], 20)
    assert {q: [v for v, _ in rows] for q, rows in got.items()} == want


def test_rows_that_take_no_part_and_few_candidates(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [0.5, 0.5]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [None, 1.0]),
            (8, [float("inf"), 1.0]), (9, [1.0]), (None, [1.0, 1.0]), (3, [0.5, 0.5]), (20, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = answers(ann_scan.search(df, F.col("id") % 20 == 0))
    assert got == {0: [(20, 1.0), (3, 0.5)], 20: [(0, 1.0), (3, 0.5)]}


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann_scan.search(empty, F.col("id") % 20 == 0).count() == 0
    alone = spark.createDataFrame([(20, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert ann_scan.search(alone, F.col("id") % 20 == 0).count() == 0
