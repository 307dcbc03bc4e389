import hashlib
import math
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from rowsentry.operators import split


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def quotas(sizes, percent):
    n = sum(sizes.values())
    train = n - math.ceil(n * percent / 100)
    quota = {k: v * train // n for k, v in sizes.items()}
    rest = sorted(sizes, key=lambda k: (-(sizes[k] * train % n), k))
    for k in rest[: train - sum(quota.values())]:
        quota[k] += 1
    return quota


def brute_force(rows, percent, seed):
    sizes = Counter(label for _, label in rows)
    quota = quotas(sizes, percent)
    train = set()
    for name in sizes:
        ranked = sorted((md5(f"{seed}|{k}"), str(k)) for k, label in rows if label == name)
        train |= {k for _, k in ranked[: quota[name]]}
    return train


def test_golden_counts(labelled):
    parts = split.split_and_fold(labelled, "species", "id")
    got = {(r["fold"], r["split"], r["species"]): r["n"]
           for r in parts.groupBy("fold", "split", "species").agg(F.count("*").alias("n")).collect()}
    assert [got[(0, "test", s)] for s in ("Adelie", "Chinstrap", "Gentoo")] == [29, 14, 24]
    for fold in (1, 2, 3):
        assert [got[(fold, "train", s)] for s in ("Adelie", "Chinstrap", "Gentoo")] == [93, 43, 76]
        assert [got[(fold, "validation", s)] for s in ("Adelie", "Chinstrap", "Gentoo")] == [24, 11, 19]


def test_matches_brute_force(labelled):
    rows = [(r["id"], r["species"]) for r in labelled.select("id", "species").collect()]
    got = split.stratified_split(labelled, "species", "id").filter("split = 'train'").select("id").collect()
    assert {str(r["id"]) for r in got} == brute_force(rows, 20, "42")
    folds = split.stratified_folds(labelled, "species", "id", folds=2).filter("split = 'train'").select("fold", "id").collect()
    for fold in (1, 2):
        assert {str(r["id"]) for r in folds if r["fold"] == fold} == brute_force(rows, 20, f"41|{fold}")


@settings(max_examples=8, deadline=None)
@given(sizes=st.lists(st.integers(4, 60), min_size=2, max_size=5), percent=st.integers(20, 50))
def test_quotas_hold_for_any_sizes(spark, sizes, percent):
    rows = [(i * 1000 + j, f"c{i}") for i, size in enumerate(sizes) for j in range(size)]
    df = spark.createDataFrame(rows, "id INT, label STRING")
    got = split.stratified_split(df, "label", "id", percent).filter("split = 'train'").groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in got} == {k: v for k, v in quotas(Counter(c for _, c in rows), percent).items() if v}


def test_is_a_partition_and_folds_overlap_only_in_validation(labelled):
    parts = split.split_and_fold(labelled, "species", "id")
    per_fold = parts.filter("fold > 0").groupBy("fold").agg(F.count("*").alias("n"), F.countDistinct("id").alias("d")).collect()
    assert all(r["n"] == r["d"] == 266 for r in per_fold)
    test = {r["id"] for r in parts.filter("split = 'test'").collect()}
    rest = {r["id"] for r in parts.filter("fold = 1").collect()}
    assert not test & rest and len(test | rest) == 333


@pytest.mark.parametrize("spreads", [(1e-9, 60.0), (1e6,)])
def test_width_of_the_band_does_not_matter(labelled, monkeypatch, spreads):
    a = split.stratified_split(labelled, "species", "id").select("id", "split")
    monkeypatch.setattr(split, "_SPREADS", spreads)
    b = split.stratified_split(labelled, "species", "id").select("id", "split")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("spread", [1e-9, 1e6])
def test_search_by_parts_finds_the_same_cuts(spark, monkeypatch, spread):
    """Ranges of few parts and few rows, begun in the wrong place, also with one class of nearly all rows."""
    df = spark.range(3000).select("id", F.when(F.col("id") % 50 == 0, "rare").otherwise("hot").alias("label"))
    rows = [(r["id"], r["label"]) for r in df.collect()]
    monkeypatch.setattr(split, "_SPREADS", (spread,))
    monkeypatch.setattr(split, "_SLOTS", 8)
    monkeypatch.setattr(split, "_LEAF_ROWS", 20)
    got = split.stratified_split(df, "label", "id").filter("split = 'train'").select("id").collect()
    assert {str(r["id"]) for r in got} == brute_force(rows, 20, "42")
    folds = split.stratified_folds(df, "label", "id", folds=2).filter("split = 'train'").select("fold", "id").collect()
    for fold in (1, 2):
        assert {str(r["id"]) for r in folds if r["fold"] == fold} == brute_force(rows, 20, f"41|{fold}")


def test_number_of_passes(spark, labelled, monkeypatch):
    """One pass over the rows finds the cuts of all classes, and one those of all folds."""
    passes = []
    real = split._narrowed
    monkeypatch.setattr(split, "_narrowed", lambda *a: passes.append(1) or real(*a))
    split.stratified_split(labelled, "species", "id")
    assert len(passes) == 1
    split.stratified_folds(labelled, "species", "id")
    assert len(passes) == 2
    split.split_and_fold(labelled, "species", "id")
    assert len(passes) == 4


def test_rows_of_a_key_stay_together(spark):
    """A third of the rows share one key: no row of it is apart from the others, and train exceeds its quota by no more than them."""
    df = spark.range(600).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("id"), F.col("id").alias("row"),
                                 (F.col("id") % 2).alias("label"))
    parts = split.stratified_split(df, "label", "id", together=True)
    assert {tuple(r)[0] for r in parts.filter("id = 0").groupBy("label").agg(F.countDistinct("split")).select("count(DISTINCT split)").collect()} == {1}
    keys = sorted(((md5(f"42|{k}"), str(k)), k) for k in {r["id"] for r in df.collect()})
    for label in (0, 1):
        sizes = Counter(r["id"] for r in df.filter(F.col("label") == label).collect())
        train, run = set(), 0
        for _, k in keys:
            if k in sizes and run < 240:
                train.add(k)
                run += sizes[k]
        got = parts.filter((F.col("label") == label) & (F.col("split") == "train"))
        assert {r["id"] for r in got.collect()} == train and got.count() == run
    folded = split.split_and_fold(df, "label", "id", together=True)
    per_key = folded.groupBy("id", "label", "fold").agg(F.countDistinct("split").alias("sides"))
    assert per_key.filter("sides > 1").isEmpty() and folded.select("row").distinct().count() == 600


def test_partitioning_does_not_matter(spark, labelled):
    a = {tuple(r) for r in split.stratified_split(labelled.repartition(1), "species", "id").select("id", "split").collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        b = {tuple(r) for r in split.stratified_split(labelled.repartition(13), "species", "id").select("id", "split").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert a == b


def test_many_classes_without_a_broadcast(spark, monkeypatch):
    """Beyond the measured size the cuts are joined with a shuffle, with the same result."""
    df = spark.range(4000).select("id", (F.col("id") % 40).alias("label"))
    want = {tuple(r) for r in split.stratified_split(df, "label", "id").select("id", "split").collect()}
    real = split.settle_small
    monkeypatch.setattr(split, "settle_small", lambda d, n=5: real(d, 5))
    got = {tuple(r) for r in split.stratified_split(df, "label", "id").select("id", "split").collect()}
    assert got == want


def test_guards(spark):
    with pytest.raises(Exception, match="fewer than 2 rows"):
        split.stratified_split(spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id INT, y STRING"), "y", "id")
    with pytest.raises(Exception, match="fewer rows than there are classes"):
        split.stratified_split(spark.createDataFrame([(i, "ab"[i % 2]) for i in range(4)], "id INT, y STRING"), "y", "id")
    with pytest.raises(Exception, match="label is null"):
        split.stratified_split(spark.createDataFrame([(i, None if i == 3 else "ab"[i % 2]) for i in range(20)], "id INT, y STRING"), "y", "id")
    with pytest.raises(Exception, match="not unique"):
        split.stratified_split(spark.createDataFrame([(1, "ab"[i % 2]) for i in range(20)], "id INT, y STRING"), "y", "id")


def test_hot_class(spark):
    """One class holds nearly all rows; quotas stay exact."""
    df = spark.range(20000).select("id", F.when(F.col("id") % 100 == 0, "rare").otherwise("hot").alias("label"))
    got = {(r["label"], r["split"]): r["count"] for r in split.stratified_split(df, "label", "id").groupBy("label", "split").count().collect()}
    assert got == {("rare", "train"): 160, ("rare", "test"): 40, ("hot", "train"): 15840, ("hot", "test"): 3960}


def test_shuffle_rows_and_rank_agree(spark):
    df = spark.range(500)
    ordered = [r["id"] for r in split.shuffle_rows(df, "id").collect()]
    assert ordered == sorted(range(500), key=lambda i: (md5(f"42|{i}"), str(i)))
    ranks = {r["id"]: r["rank"] for r in split.shuffle_rank(df, "id", digits=1).collect()}
    assert [ranks[i] for i in ordered] == list(range(1, 501))


def test_sample_percent(spark):
    df = spark.range(1000)
    assert split.sample_percent(df, 100, "id").count() == 1000
    assert split.sample_percent(df, 0, "id").count() == 0
    want = {i for i in range(1000) if int(md5(str(i))[:8], 16) % 100 < 25}
    assert {r["id"] for r in split.sample_percent(df, 25, "id").collect()} == want


def test_append_folds_matches_by_name(spark):
    a, b = spark.createDataFrame([(1, "x")], "i INT, s STRING"), spark.createDataFrame([("y", 2)], "s STRING, i INT")
    assert {tuple(r) for r in split.append_folds(a, b).collect()} == {(1, "x"), (2, "y")}


def test_splitting_scans_once_and_shuffles_nothing(spark, labelled, folder):
    labelled.write.parquet(f"{folder}/t")
    plan = split.split_and_fold(spark.read.parquet(f"{folder}/t"), "species", "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "hashpartitioning" not in plan and "Sort" not in plan
