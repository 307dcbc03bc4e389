import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowsentry.llm import embedding_whitening as w

DDL = "vec_id LONG, embedding ARRAY<FLOAT>, x STRING, n STRING"


def rows_of(vectors):
    return [(i, None if v is None else [None if c is None else float(c) for c in v], "own", "other") for i, v in enumerate(vectors)]


def plain(vectors, k=16):
    """The same by numpy on the whole matrix: distinct rows, exact sums, full eigen decomposition."""
    x = [tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v) for v in vectors]
    distinct = sorted(set(x))
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    centred = lambda v: np.array([(n * c - s) / n for c, s in zip(v, sums)])
    m = np.array([centred(v) for v in distinct])
    values, vectors_ = np.linalg.eigh(m.T @ m / n)
    values, vectors_ = values[::-1], vectors_[:, ::-1]
    k = min(k, int((values > 1e-9 * max(values[0], 1e-300)).sum()))
    white = np.array([centred(v) for v in x]) @ vectors_[:, :k] / np.sqrt(values[:k])
    return n, [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x], white, values[:k] / values.sum()


def compare(df, vectors, ids, k=16):
    got = {r["vec_id"]: r for r in df.collect()}
    assert sorted(got) == sorted(ids)
    n, away, white, explained = plain(vectors, k)
    mine = np.array([got[i]["whitened"] for i in ids])
    assert mine.shape == white.shape
    signs = np.sign((mine * white).sum(axis=0))
    assert np.abs(mine - white * signs).max() < 1e-7
    assert [got[i]["deviation"] for i in ids] == away and {r["n"] for r in got.values()} == {n}
    assert np.allclose(got[ids[0]]["explained"], explained, rtol=1e-9)
    assert max(r["identity_error"] for r in got.values()) < 1e-9


def test_agrees_with_a_full_decomposition(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((300, 24)) * np.linspace(2, 0.5, 24)
    vectors = [*base, *base[:50], *([base[7]] * 100)]
    df = spark.createDataFrame(rows_of(vectors), DDL).repartition(5)
    out = w.whiten(df)
    assert {"x", "n", "embedding"} <= set(out.columns) and out.filter("x = 'own'").count() == len(vectors)
    compare(out, vectors, list(range(len(vectors))))


def test_rows_that_take_no_part(spark):
    good = np.random.default_rng(5).standard_normal((20, 3))
    bad = [None, [], [1, None, 2], [1, float("nan"), 2], [float("inf"), 1, 2], [1, 2]]
    df = spark.createDataFrame(rows_of([*bad, *good]), DDL)
    compare(w.whiten(df), list(good), list(range(len(bad), len(bad) + 20)))


def test_no_variance_and_no_rows(spark):
    same = w.whiten(spark.createDataFrame(rows_of([[1, 2]] * 5), DDL)).collect()
    assert len(same) == 5 and all(r["whitened"] == [] and r["deviation"] == 0 and r["n"] == 1 for r in same)
    assert w.whiten(spark.createDataFrame([], DDL)).collect() == []
    line = w.whiten(spark.createDataFrame(rows_of([[0, 0, 0], [1, 1, 1], [2, 2, 2]]), DDL)).collect()
    assert all(len(r["whitened"]) == 1 and abs(r["explained"][0] - 1) < 1e-9 for r in line)


def test_large_entries_do_not_overflow(spark):
    vectors = [[3e38, 1.0], [-3e38, 2.0], [0.0, 3.0]]
    out = w.whiten(spark.createDataFrame(rows_of(vectors), DDL)).collect()
    assert len(out) == 3 and all(r["deviation"] is None or r["deviation"] >= 0 for r in out)
    assert all(math.isfinite(v) for r in out for v in r["whitened"])


def test_restarts_and_close_eigenvalues():
    rng = np.random.default_rng(11)
    q, _ = np.linalg.qr(rng.standard_normal((300, 300)))
    values = np.concatenate([[50, 50, 50, 49.9999999], np.linspace(40, 39, 40), np.linspace(5, 0, 256)])
    v = (q * values) @ q.T
    calls = []

    def apply(u):
        calls.append(u.shape[1])
        return v @ u

    found, vectors, residuals = w.eigenpairs(apply, 300, 16)
    assert np.abs(found - np.sort(values)[::-1][:16]).max() < 1e-11
    assert residuals.max() < 1e-12 * 50 and np.abs(vectors.T @ vectors - np.eye(16)).max() < 1e-12
    assert len(calls) < 150


@pytest.mark.parametrize("n", [3, 1 << 40])
def test_deviations_are_exact(n):
    x = np.array([[10, 7], [1 << 45, -5]], np.int64)
    sums = [n * 9 + 2, n * 7 + 1]
    assert w.Centre(n, sums).deviations(x) == [sum((n * int(c) - s) ** 2 for c, s in zip(r, sums)) for r in x]


def test_query_columns(spark):
    from rowsentry.llm.queries import QUERIES

    out = QUERIES["op11_embedding_whitening"](spark, "/root/testdata/sf0.001")
    assert dict(out.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
                                "explained": "double", "identity_error": "double"}
    assert out.agg(F.max("identity_error")).first()[0] < 1e-9
    assert out.count() == 500 * 16
