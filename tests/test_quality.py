import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from rowsentry.operators import drift, quality, ranking
from rowsentry.streaming import hourly


def ks(a, b):
    a, b = np.sort(a), np.sort(b)
    points = np.concatenate([a, b])
    return np.max(np.abs(np.searchsorted(a, points, "right") / len(a) - np.searchsorted(b, points, "right") / len(b)))


def numbers(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "x DOUBLE")


@settings(max_examples=6, deadline=None)
@given(a=st.lists(st.integers(-20, 20), min_size=1, max_size=60), b=st.lists(st.integers(-15, 30), min_size=1, max_size=60))
def test_drift_numeric_is_the_ks_distance(spark, a, b):
    got = drift.drift_numeric(numbers(spark, a), numbers(spark, b), ["x"]).first()["distance"]
    assert got == pytest.approx(ks(np.array(a), np.array(b)))


def test_more_cuts_than_leaves(spark):
    cuts = [float(c) for c in range(0, 2000, 7)]
    got = spark.range(-5, 2005).select("id", ranking.range_bucket(F.col("id").cast("double"), cuts).alias("b")).collect()
    assert all(r["b"] == sum(c <= r["id"] for c in cuts) for r in got)


@pytest.fixture(params=[1_000_000, 10])
def rows_per_part(request, monkeypatch):
    monkeypatch.setattr(ranking, "ROWS_PER_PART", request.param)


def test_drift_on_a_long_column_with_a_hot_value(spark, rows_per_part):
    rng = np.random.default_rng(1)
    a = np.where(rng.random(4000) < 0.4, 0.0, rng.normal(size=4000))
    b = np.where(rng.random(3000) < 0.3, 0.0, rng.normal(0.2, 1, size=3000))
    left, right = numbers(spark, a), numbers(spark, b)
    exact = drift.drift_numeric(left, right, ["x"]).first()["distance"]
    assert exact == pytest.approx(ks(a, b))
    binned = drift.drift_numeric_binned(left, right, ["x"], 200).first()["distance"]
    assert binned <= exact + 1e-12 and binned == pytest.approx(exact, abs=0.02)
    assert drift.drift_numeric(left, left, ["x"]).first()["distance"] == 0
    constant = numbers(spark, [1, 1])
    assert drift.drift_numeric_binned(constant, constant, ["x"]).first()["distance"] == 0


def test_drift_categorical(spark):
    a = spark.createDataFrame([("p",)] * 3 + [("q",)], "c STRING")
    b = spark.createDataFrame([("p",), ("r",), ("r",), (None,)], "c STRING")
    assert drift.drift_categorical(a, b, ["c"]).first()["distance"] == 0.5


@settings(max_examples=6, deadline=None)
@given(values=st.lists(st.integers(-50, 50), min_size=1, max_size=80))
def test_exact_quantiles(spark, values):
    ps = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r["p"]: r["value"] for r in quality.profile_quantiles(numbers(spark, values), ["x"], ps).collect()}
    for p in ps:
        assert got[p] == pytest.approx(np.quantile(values, p))


def test_quantiles_of_several_columns_and_sketches(spark, rows_per_part):
    rng = np.random.default_rng(2)
    data = [(float(a), float(b), int(i % 4)) for i, (a, b) in enumerate(zip(rng.normal(size=5000), rng.exponential(size=5000)))]
    df = spark.createDataFrame(data, "a DOUBLE, b DOUBLE, h INT")
    ps = [0.01, 0.5, 0.99]
    exact = {(r["column"], r["p"]): r["value"] for r in quality.profile_quantiles(df, ["a", "b"], ps).collect()}
    for i, c in enumerate("ab"):
        for p in ps:
            assert exact[(c, p)] == pytest.approx(np.quantile([d[i] for d in data], p))
    merged = quality.merge_sketches(quality.quantile_sketches(df, ["a", "b"], ["h"]))
    rough = {(r["column"], r["p"]): r["value"] for r in quality.sketch_quantiles(merged, [0.5]).collect()}
    for i, c in enumerate("ab"):
        rank = np.mean([d[i] <= rough[(c, 0.5)] for d in data])
        assert abs(rank - 0.5) < 0.03


def test_full_buckets_are_cut_again(spark, monkeypatch):
    """No bucket keeps more values than its limit, however many levels that takes, and quantiles and distances stay exact."""
    # Most values lie close together, so that even buckets of the whole range would be full.
    df = spark.range(4000).select((F.pow(F.col("id") / 4000, 3) * 1000).alias("x"), (F.col("id") % 7).cast("double").alias("y"))
    probabilities = [0.0, 0.1, 0.5, 0.77, 1.0]
    other = df.withColumn("x", F.col("x") * 1.01)

    def results():
        return (sorted(map(tuple, quality.profile_quantiles(df, ["x", "y"], probabilities).collect())),
                sorted(map(tuple, drift.drift_numeric(df, other, ["x", "y"]).collect())))

    want = results()
    monkeypatch.setattr(ranking, "MAX_PARTS", 4)
    monkeypatch.setattr(ranking, "ROWS_PER_PART", 30)
    counts = quality.unpivot_numbers(df, ["x", "y"]).distinct()
    rows, bucket = ranking.nested_buckets(counts, ranking.value_cuts(df, ["x", "y"], 4))
    per = rows.groupBy("column", bucket.alias("b")).agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    spans = [tuple(r) for r in per.orderBy("column", "b").select("column", "n", "low", "high").collect()]
    assert sum(s[1] for s in spans) == 4007 and max(s[1] for s in spans) <= 30
    assert all(a[3] < b[2] for a, b in zip(spans, spans[1:]) if a[0] == b[0])
    assert len(rows.columns) > 4  # more than one level
    assert results() == want


def test_bucketed_rank_equals_a_window(spark):
    df = spark.range(3000).select("id", (F.col("id") % 3).alias("g"), F.md5(F.col("id").cast("string")).alias("h"))
    df = df.withColumn("g", F.when(F.col("g") != 2, F.col("g")))
    got = ranking.bucketed_rank(df, ["g"], ranking.hash_bucket("h", 2), ["h"]).collect()
    want = {}
    for r in sorted(df.collect(), key=lambda r: r["h"]):
        want.setdefault(r["g"], []).append(r["id"])
    assert len(got) == 3000
    assert all(want[r["g"]][r["rank"] - 1] == r["id"] for r in got)


def test_rank_keeps_rows_without_a_bucket(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, None), (4, 7)], "id INT, t INT")
    got = {r["id"]: r["rank"] for r in ranking.bucketed_rank(df, [], F.col("t"), ["t", "id"]).collect()}
    assert got == {1: 1, 3: 2, 2: 3, 4: 4}


@settings(max_examples=20, deadline=None)
@given(cuts=st.lists(st.integers(-5, 5), max_size=9, unique=True).map(sorted), v=st.integers(-7, 7))
def test_range_bucket(spark, cuts, v):
    got = spark.range(1).select(ranking.range_bucket(F.lit(float(v)), [float(c) for c in cuts]).alias("b")).first()["b"]
    assert got == sum(c <= v for c in cuts)


@pytest.fixture(scope="module")
def sample(spark):
    return spark.createDataFrame(
        [(1, 2.0, "a"), (2, None, "b"), (3, 4.0, None), (3, -1.0, "a")], "n INT, x DOUBLE, s STRING")


def test_profile(sample):
    got = {r["column"]: r for r in quality.profile_columns_exact(sample, domains={"s": ["a"]}).collect()}
    assert (got["n"]["kind"], got["x"]["kind"], got["s"]["kind"]) == ("Integral", "Fractional", "String")
    assert (got["n"]["n"], got["n"]["n_null"], got["x"]["n_null"], got["x"]["completeness"]) == (4, 0, 1, 0.75)
    assert (got["n"]["n_distinct"], got["x"]["n_distinct"], got["s"]["n_distinct"]) == (3, 3, 2)
    assert (got["x"]["mean"], got["x"]["min"], got["x"]["max"], got["x"]["sum"]) == (pytest.approx(5 / 3), -1.0, 4.0, 5.0)
    assert got["s"]["n_unseen"] == 1 and got["s"]["mean"] is None
    rough = {r["column"]: r["n_distinct"] for r in quality.profile_columns(sample).collect()}
    assert rough == {"n": 3, "x": 3, "s": 2}


def test_profile_of_many_columns(spark):
    wide = spark.range(10).selectExpr(*[f"id * {i} as c{i}" for i in range(130)])
    got = {r["column"]: (r["sum"], r["n_distinct"]) for r in quality.profile_columns(wide).collect()}
    assert got == {f"c{i}": (45.0 * i, 10 if i else 1) for i in range(130)}


def test_profile_of_odd_names_values_and_empty_columns(spark):
    df = spark.createDataFrame([("it's", None), ("back\\slash", None), ("plain", None)], "`a b'c` STRING, none STRING")
    got = {r["column"]: r for r in quality.profile_columns(df, domains={"a b'c": ["it's", "back\\slash"], "none": []}).collect()}
    assert (got["a b'c"]["n_unseen"], got["a b'c"]["n_distinct"]) == (1, 3)
    assert (got["none"]["n_unseen"], got["none"]["n_distinct"], got["none"]["completeness"]) == (0, 0, 0.0)


def test_estimated_distinct_counts_are_close(spark):
    df = spark.range(50000).selectExpr("id", "id / 3 as x", "cast(id % 7000 as string) as s")
    got = {r["column"]: r["n_distinct"] for r in quality.profile_columns(df).collect()}
    assert abs(got["id"] / 50000 - 1) < 0.06 and abs(got["x"] / 50000 - 1) < 0.06 and abs(got["s"] / 7000 - 1) < 0.06


def test_infer_types(spark):
    df = spark.createDataFrame([("1", "1.5", "x", None), ("-2", "2", "3", None), ("+3", ".5e3", "4", None)], "a STRING, b STRING, c STRING, d STRING")
    got = {r["column"]: r["kind"] for r in quality.infer_column_types(df).collect()}
    assert got == {"a": "Integral", "b": "Fractional", "c": "String", "d": "String"}


def test_histogram(sample):
    got = {(r["column"], r["value"]): (r["n"], r["share"]) for r in quality.value_histogram(sample, ["s"]).collect()}
    assert got == {("s", "a"): (2, 0.5), ("s", "b"): (1, 0.25), ("s", None): (1, 0.25)}


def constraints_of(df, texts):
    return quality.suggest_constraints(quality.profile_columns_exact(df), quality.value_histogram(df, texts))


def test_baseline_satisfies_its_own_constraints(labelled):
    base = labelled.drop("id")
    constraints = constraints_of(base, ["species", "island", "sex"])
    got = {r["column"]: r for r in constraints.collect()}
    assert got["island"]["domain"] == ["Biscoe", "Dream", "Torgersen"] and got["body_mass_g"]["non_negative"]
    domains = quality.constraint_domains(constraints)
    assert quality.check_constraints(quality.profile_columns(base, domains=domains), constraints).count() == 0


def test_every_check(spark, labelled):
    constraints = constraints_of(labelled.select("id", "island", "sex", "body_mass_g", "culmen_depth_mm"), ["island", "sex"])
    current = labelled.select(
        F.col("id").cast("string").alias("id"), F.lit("Atlantis").alias("island"),
        F.when(F.col("id") > 0, F.col("sex")).alias("sex"), (-F.col("body_mass_g")).alias("body_mass_g"), F.lit(1).alias("new"))
    profile = quality.profile_columns(current, domains=quality.constraint_domains(constraints))
    got = {(r["column"], r["check"]): r["detail"] for r in quality.check_constraints(profile, constraints).collect()}
    assert got == {
        ("id", "data_type"): "String where the baseline has Integral",
        ("island", "unseen_category"): "333 rows outside the domain",
        ("sex", "completeness"): "completeness 0.996997",
        ("body_mass_g", "non_negative"): "negative values",
        ("culmen_depth_mm", "missing_column"): "the column is not in the data",
        ("new", "extra_column"): "the column is not in the baseline",
    }


def test_missing_columns_are_found_in_every_hour(spark):
    base = spark.createDataFrame([(1.0, "a"), (2.0, "b")], "x DOUBLE, s STRING")
    constraints = constraints_of(base, ["s"])
    traffic = spark.createDataFrame([("2024-01-01 00:10:00", "a"), ("2024-01-01 01:10:00", "c")], "ts STRING, s STRING")
    traffic = traffic.withColumn("ts", F.to_timestamp("ts"))
    profile = hourly.hourly_profile(traffic, ["s"], domains=quality.constraint_domains(constraints))
    got = {(r["window_start"].hour, r["column"], r["check"]) for r in hourly.hourly_violations(profile, constraints).collect()}
    assert got == {(0, "x", "missing_column"), (1, "x", "missing_column"), (1, "s", "unseen_category")}


def test_numbers_stay_numbers_without_a_histogram(sample):
    out = quality.suggest_constraints(quality.profile_columns(sample))
    assert {r["column"]: r["non_negative"] for r in out.collect()} == {"n": True, "x": False, "s": None}
