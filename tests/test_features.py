import math
import time

import pytest
from pyspark.sql import functions as F

from rowsentry.operators import features, split
from rowsentry.sources import fitted as store

NUMBERS = ["culmen_length_mm", "culmen_depth_mm", "flipper_length_mm", "body_mass_g"]


@pytest.fixture(scope="module")
def folded(labelled):
    return split.stratified_folds(labelled, "species", "id").persist()


def test_scaler_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (6.0, 5.0)], "x DOUBLE, k DOUBLE")
    params = features.fit_scaler(df, ["x", "k"])
    got = {r["column"]: (r["mean"], r["std"]) for r in params.collect()}
    assert got["x"] == (3.0, pytest.approx(math.sqrt(14 / 3))) and got["k"] == (5.0, 0.0)
    done = features.apply_scaler(spark.createDataFrame([(3.0, 7.0)], "x DOUBLE, k DOUBLE"), params, ["x", "k"]).first()
    assert tuple(done) == (0.0, 2.0)


def test_scaler_by_fold_equals_the_literal_form(folded):
    train = folded.filter("split = 'train'")
    params = features.fit_scaler(train, NUMBERS, "fold")
    lazy = features.apply_scaler(folded.select("id", "fold", *NUMBERS), params, NUMBERS, "fold")
    fitted = features.fit_columns(train.drop("split"), "species", "fold", NUMBERS, [])
    direct = features.transform_with(folded, fitted, "fold", ["id", "fold"])
    a = {(r["id"], r["fold"]): [round(r[c], 9) for c in NUMBERS] for r in lazy.collect()}
    b = {(r["id"], r["fold"]): [round(r[c], 9) for c in NUMBERS] for r in direct.collect()}
    assert a == b and len(a) == 3 * 333


def test_fit_transform_width_order_and_moments(folded):
    wide, fitted = features.fit_transform_columns(folded, "species", keep=["id"])
    names = [*NUMBERS, "island_Biscoe", "island_Dream", "island_Torgersen", "sex_FEMALE", "sex_MALE",
             "species_Adelie", "species_Chinstrap", "species_Gentoo"]
    assert wide.columns == ["id", "fold", "split", *names] and len(names) == 12
    assert fitted.feature_names == names[:9] and fitted.label_names == names[9:]
    moments = wide.filter("split = 'train'").groupBy("fold").agg(
        *[F.avg(c).alias(f"{c}_m") for c in NUMBERS], *[F.stddev_pop(c).alias(f"{c}_s") for c in NUMBERS]).collect()
    for r in moments:
        assert all(abs(r[f"{c}_m"]) < 1e-9 and abs(r[f"{c}_s"] - 1) < 1e-9 for c in NUMBERS)
    ones = wide.select((F.col(names[4]) + F.col(names[5]) + F.col(names[6])).alias("i"), (F.col(names[7]) + F.col(names[8])).alias("s"),
                       (F.col(names[9]) + F.col(names[10]) + F.col(names[11])).alias("y")).distinct().collect()
    assert [tuple(r) for r in ones] == [(1.0, 1.0, 1.0)]


def test_shared_fit(folded):
    _, own = features.fit_transform_columns(folded, "species", keep=["id"])
    _, last = features.fit_transform_columns(folded, "species", keep=["id"], shared_fit="last")
    assert last.means[1] == last.means[3] == own.means[3] != own.means[1]


def test_unseen_categories(spark, labelled):
    fitted = features.fit_columns(labelled.drop("id"), "species")
    odd = spark.createDataFrame([("Atlantis", 1.0, 1.0, 1.0, 1.0, "MALE"), ("Dream", 1.0, 1.0, 1.0, 1.0, "MALE")],
                                "island STRING, culmen_length_mm DOUBLE, culmen_depth_mm DOUBLE, flipper_length_mm DOUBLE, body_mass_g DOUBLE, sex STRING")
    with pytest.raises(Exception, match="unknown category in column island: Atlantis"):
        features.transform_with(odd, fitted).collect()
    kept = features.transform_with(odd, fitted, unseen="keep").collect()
    assert sum(kept[0][4:7]) == 0 and sum(kept[1][4:7]) == 1
    assert features.transform_with(odd, fitted, unseen="skip").count() == 1


def test_missing_column_raises_at_once(labelled):
    fitted = features.fit_columns(labelled.drop("id"), "species")
    with pytest.raises(ValueError, match="missing columns: island"):
        features.transform_with(labelled.drop("island"), fitted)


def test_integer_columns_are_scaled_and_odd_types_raise(spark):
    df = spark.createDataFrame([(1, "a"), (3, "b")], "n INT, s STRING")
    fitted = features.fit_columns(df)
    assert fitted.numeric == ("n",) and [r["n"] for r in features.transform_with(df, fitted).collect()] == [-1.0, 1.0]
    with pytest.raises(ValueError, match="neither numeric nor text: d"):
        features.fit_columns(df.withColumn("d", F.current_date()))


def test_categories_are_numbered_in_buckets_like_in_one_task(spark, monkeypatch):
    df = spark.range(300).select((F.col("id") % 3).alias("fold"), F.concat(F.lit("v"), F.col("id") % 150).alias("c"), F.lit("x").alias("d"))
    one = features.fit_one_hot(df, ["c", "d"], "fold").collect()
    monkeypatch.setattr(features, "CATEGORIES_PER_TASK", 10)
    assert sorted(map(tuple, features.fit_one_hot(df, ["c", "d"], "fold").collect())) == sorted(map(tuple, one))
    assert len(one) == 3 * 51


def test_ten_thousand_categories(spark):
    df = spark.range(20_000).select("id", F.concat(F.lit("v"), F.lpad((F.col("id") % 10_000).cast("string"), 5, "0")).alias("c"), (F.col("id") * 1.0).alias("x"))
    fitted = features.fit_columns(df.drop("id"))
    start = time.perf_counter()
    dense = features.transform_with(df, fitted, keep=["id"])
    assert len(dense.columns) == 10_002 and time.perf_counter() - start < 60
    some = dense.filter("id IN (3, 10003)").select("id", "c_v00003", "c_v00004").collect()
    assert sorted(map(tuple, some)) == [(3, 1.0, 0.0), (10003, 1.0, 0.0)]
    sparse = features.sparse_vector(df, fitted, keep=["id"]).filter("id = 10003").first()["features"]
    assert sparse.size == 10_001 and sparse.indices.tolist() == [0, 4] and sparse[4] == 1.0


@pytest.mark.parametrize("literal", [200, 0])
def test_dense_and_sparse_agree_by_fold(spark, monkeypatch, literal):
    monkeypatch.setattr(features, "LITERAL_CATEGORIES", literal)
    rows = [(1, "a", "p", 1.0), (1, "b", "q", 2.0), (2, "b", "p", 4.0), (2, "c", None, 6.0)]
    df = spark.createDataFrame(rows, "fold INT, c STRING, d STRING, x DOUBLE")
    fitted = features.fit_columns(df, by="fold")
    dense = features.transform_with(df, fitted, "fold", keep=["fold", "c"], unseen="keep").orderBy("fold", "c").collect()
    sparse = features.sparse_vector(df, fitted, "fold", keep=["fold", "c"], unseen="keep").orderBy("fold", "c").collect()
    assert [[r[n] for n in fitted.feature_names] for r in dense] == [r["features"].toArray().tolist() for r in sparse]
    assert [r["c_b"] for r in dense] == [0.0, 1.0, 1.0, 0.0]
    other = df.withColumn("fold", F.lit(1))
    assert features.transform_with(other, fitted, "fold", unseen="skip").count() == 3
    with pytest.raises(Exception, match="unknown category in column"):
        features.transform_with(other, fitted, "fold").collect()


def test_the_map_of_any_number_of_categories(spark):
    df = spark.range(300).select("id", F.concat(F.lit("v"), F.col("id") % 150).alias("c"))
    hot = features.indicator_map(df, features.distinct_categories(df, "c"), "c")
    assert all(r["c_hot"] == {r["c"]: 1.0} for r in hot.collect()) and hot.count() == 300
    known = features.distinct_categories(df.filter("c != 'v7'"), "c")
    assert features.indicator_map(df, known, "c", "skip").count() == 298
    assert features.indicator_map(df, known, "c", "keep").filter("size(c_hot) = 0").count() == 2
    with pytest.raises(Exception, match="unknown category in column c: v7"):
        features.indicator_map(df, known, "c").collect()


def test_label_with_more_than_three_classes(spark):
    df = spark.range(40).select("id", (F.col("id") % 8).cast("string").alias("y"), (F.col("id") * 1.0).alias("x"))
    fitted = features.fit_columns(df.drop("id"), "y")
    row = features.transform_with(df, fitted, keep=["id"], with_label=True).filter("id = 3").first()
    assert [row[f"y_{i}"] for i in range(8)] == [0, 0, 0, 1, 0, 0, 0, 0]


def test_save_and_load(spark, folded, folder):
    _, fitted = features.fit_transform_columns(folded, "species", keep=["id"])
    store.save_fitted(spark, fitted, f"{folder}/fitted")
    back = store.load_fitted(spark, f"{folder}/fitted")
    assert back == fitted
    assert store.load_fitted(spark, f"{folder}/fitted", 2) == fitted.only(2)
    assert store.load_fitted(spark, f"{folder}/fitted", 1).means[None] == fitted.means[1]


def test_apply_is_a_projection(labelled):
    fitted = features.fit_columns(labelled.drop("id"), "species")
    plan = features.transform_with(labelled, fitted)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Python" not in plan


@pytest.mark.parametrize("by", [None, "fold"])
def test_large_dictionaries_stay_tables(spark, folder, monkeypatch, by):
    """Many categories with one long common prefix: numbered in ranges, encoded and stored without a list of them on the driver."""
    df = spark.range(30_000).select("id", (F.col("id") % 2 + 1).cast("int").alias("fold"),
                                    F.concat(F.lit("customer#"), F.lpad((F.col("id") * 7919 % 30_000).cast("string"), 6, "0")).alias("c"),
                                    F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("d"))
    fitted = features.fit_columns(df.drop("id"), by=by, numeric=[], categorical=["c", "d"])
    assert set(fitted.large) == {"c"} and fitted.width("c") == 30_000 and all("c" not in v for v in fitted.categories.values())
    assert fitted.large["c"].table.count() == 30_000

    def no_names(self):
        raise AssertionError("categories came to the driver")

    monkeypatch.setattr(features.Dictionary, "names", no_names)
    cells = features.sparse_cells(df, fitted, by, keep=["id"])
    bad = cells.filter((F.col("size") != 30_002) | (F.element_at("indices", 1) != F.col("id") * 7919 % 30_000)
                       | (F.element_at("indices", 2) != F.when(F.col("id") % 3 == 0, 30_000).otherwise(30_001)))
    assert cells.count() == 30_000 and bad.isEmpty()
    store.save_fitted(spark, fitted, f"{folder}/fitted")
    back = store.load_fitted(spark, f"{folder}/fitted")
    assert features.sparse_cells(df, back, by, keep=["id"]).exceptAll(cells).isEmpty()
    if by:
        one = store.load_fitted(spark, f"{folder}/fitted", 2)
        assert features.sparse_cells(df, one, keep=["id"], unseen="keep").filter("size(indices) = 2").count() == 15_000
        assert features.sparse_cells(df, fitted.only(2), keep=["id"], unseen="skip").count() == 15_000


@pytest.mark.parametrize("folderless", [False, True])
def test_numbered_in_ranges_like_sorted(spark, monkeypatch, folderless):
    from rowsentry.operators import dictionary

    if folderless:
        monkeypatch.setattr(dictionary, "written", lambda df: None)
    words = sorted({f"{'é' if i % 3 else 'prefix-'}{(i * 37) % 1000}" for i in range(1000)} | {"", "z"})
    df = spark.createDataFrame([(w,) for w in words], "category STRING").repartition(7)
    got = {r["category"]: r["place"] for r in dictionary.numbered(df).collect()}
    assert got == {w: i for i, w in enumerate(words)}


def test_rows_of_a_fit_and_its_result_are_made_once(spark):
    from rowsentry.operators import features

    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    rows = spark.createDataFrame([(1 + i % 2, "train" if i < 8 else "validation", float(i), "ab"[i % 2], "xy"[i // 2 % 2]) for i in range(12)],
                                 "fold INT, split STRING, size DOUBLE, kind STRING, label STRING")
    done, fitted = features.fit_transform_columns(rows.mapInArrow(count, rows.schema), "label")
    assert done.count() == len(done.collect()) == 12 and fitted.folds == [1, 2]
    assert made.value == 12
