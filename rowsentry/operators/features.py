"""Fitting and applying scaling and one-hot indicators.

Fitting is an aggregation per fold. Means, deviations and the categories of text columns with few values are literals, so
applying them is a projection: no join, no shuffle, no Python. Columns with more values keep their categories in a numbered
table (:mod:`rowsentry.operators.dictionary`), and a value is looked up by a join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from rowsentry.functions.names import as_list, require_columns
from rowsentry.operators.rows import numeric_columns, string_columns
from rowsentry.operators.dictionary import Dictionary, build, kept, numbered
from rowsentry.operators.sizing import join_unique, lookup, settle_small

#: Categories that one task numbers; more are numbered in ranges of their order.
CATEGORIES_PER_TASK = 100_000
#: Categories up to which a value is looked up in a literal; more stay a table and are looked up by a join.
LITERAL_CATEGORIES = 200
COLUMNS_PER_PASS = 100


def fit_scaler(df: DataFrame, cols: str | Sequence[str], by: str | Sequence[str] = ()) -> DataFrame:
    """Mean and population deviation of each column (per ``by``): ``column, mean, std`` rows."""
    cols, by = as_list(cols), as_list(by)
    out = None
    for start in range(0, len(cols), COLUMNS_PER_PASS):
        some = cols[start:start + COLUMNS_PER_PASS]
        aggs = []
        for c in some:
            x = F.col(c).cast("double")
            aggs.append(F.struct(F.lit(c).alias("column"), F.avg(x).alias("mean"), F.stddev_pop(x).alias("std")))
        part = df.groupBy(*by).agg(F.array(*aggs).alias("p")).select(*by, F.inline("p"))
        out = part if out is None else out.unionByName(part)
    return out


def scaled(x: Column, mean: Column, std: Column) -> Column:
    """``(x - mean) / std``; a deviation of 0 divides by 1."""
    return (x.cast("double") - mean) / F.when(std == 0, F.lit(1.0)).otherwise(std)


def apply_scaler(df: DataFrame, params: DataFrame, cols: str | Sequence[str], by: str | Sequence[str] = ()) -> DataFrame:
    """Replace the columns by their scaled values.

    ``params`` comes from :func:`fit_scaler`. Without ``by`` fit and apply are one lazy plan
    around a scalar subquery; with it the values are looked up per fold.
    """
    cols, by = as_list(cols), as_list(by)
    require_columns(df, [*cols, *by])
    fitted = [F.max(F.when(F.col("column") == c, F.struct("mean", "std"))).alias(f"_p_{i}") for i, c in enumerate(cols)]
    if by:
        joined = lookup(df, params.groupBy(*by).agg(*fitted), by, "left")
        at = {c: F.col(f"_p_{i}") for i, c in enumerate(cols)}
    else:
        joined = df.withColumn("_p", params.agg(F.struct(*fitted)).scalar())
        at = {c: F.col("_p")[f"_p_{i}"] for i, c in enumerate(cols)}
    return joined.select(*[
        scaled(F.col(c), at[c]["mean"], at[c]["std"]).alias(c) if c in at else F.col(c) for c in df.columns
    ])


def distinct_categories(df: DataFrame, cols: str | Sequence[str], by: str | Sequence[str] = ()) -> DataFrame:
    """The distinct non-null values per column: ``column, category`` rows, however many."""
    cols, by = as_list(cols), as_list(by)
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("category")) for c in cols])
    return df.select(*by, F.inline(pairs)).filter("category IS NOT NULL").distinct()


def fit_one_hot(df: DataFrame, cols: str | Sequence[str], by: str | Sequence[str] = ()) -> DataFrame:
    """Alphabetical categories per column: ``column, idx, category`` rows, ``idx`` from 0, however many there are."""
    by = as_list(by)
    found, size = settle_small(distinct_categories(df, cols, by), CATEGORIES_PER_TASK)
    if size is None:
        return numbered(found, [*by, "column"], "idx").select(*by, "column", "idx", "category")
    order = Window.partitionBy(*by, "column").orderBy("category")
    return found.select(*by, "column", (F.row_number().over(order) - 1).alias("idx"), "category")


def indicator_map(df: DataFrame, categories: DataFrame, col: str, unseen: str = "error") -> DataFrame:
    """Sparse one-hot of a column with any number of categories: ``<col>_hot`` = ``{value: 1.0}``.

    ``categories`` comes from :func:`distinct_categories`. An unseen value raises, or gives an
    empty map (``keep``), or drops the row (``skip``).
    """
    known = (
        categories.filter(F.col("column") == col)
        .select(F.col("category").alias("_c")).distinct().withColumn("_known", F.lit(True))
    )
    rows = df.withColumn("_c", F.col(col).cast("string"))
    joined = join_unique(rows, known, "_c", "left")
    hot = F.create_map(F.col("_c"), F.lit(1.0))
    none = F.expr("cast(map() as map<string,double>)")
    seen = F.col("_known").isNotNull()
    if unseen == "skip":
        joined, value = joined.filter(seen), hot
    elif unseen == "keep":
        value = F.when(seen, hot).otherwise(none)
    else:
        value = F.when(seen, hot).otherwise(F.raise_error(_unseen_text(col)).cast("map<string,double>"))
    return joined.withColumn(f"{col}_hot", value).select(*df.columns, f"{col}_hot")


def _unseen_text(col: str) -> Column:
    return F.concat(F.lit(f"unknown category in column {col}: "), F.coalesce(F.col(col).cast("string"), F.lit("null")))


@dataclass(frozen=True)
class FittedColumns:
    """Fitted values by fold: ``means[fold][column] = (mean, std)``, ``categories[fold][column]``.

    Fold ``None`` is used when the fit was not done per fold. ``label`` is the encoded label
    column, if any; its categories are the training domain. Columns with many categories are in ``large`` instead.
    """

    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    label: str | None
    means: dict = field(default_factory=dict)
    categories: dict = field(default_factory=dict)
    large: dict[str, Dictionary] = field(default_factory=dict)

    @property
    def folds(self) -> list:
        return sorted(self.means, key=lambda f: (f is not None, f))

    def domain(self, column: str) -> list[str]:
        """All categories of a column over the folds, alphabetically; of a large column they are brought here, for names of columns."""
        if column in self.large:
            return self.large[column].names()
        return sorted({c for fold in self.categories.values() for c in fold.get(column, ())})

    def width(self, column: str) -> int:
        """The number of categories of a column over the folds."""
        return self.large[column].size if column in self.large else len(self.domain(column))

    def seen(self, fold, column: str) -> list[str]:
        """The categories that a fold has seen."""
        if column in self.large:
            return [v for v in self.large[column].of_fold(fold).names() if v]
        return self.categories[fold].get(column, [])

    @property
    def feature_names(self) -> list[str]:
        return [*self.numeric, *(f"{c}_{v}" for c in self.categorical for v in self.domain(c))]

    @property
    def label_names(self) -> list[str]:
        return [f"{self.label}_{v}" for v in self.domain(self.label)] if self.label else []

    def only(self, fold) -> FittedColumns:
        """The values of one fold, usable on rows without a fold column."""
        return FittedColumns(self.numeric, self.categorical, self.label,
                             {None: self.means[fold]}, {None: self.categories[fold]},
                             {c: d.of_fold(fold) for c, d in self.large.items()})


FITTED_DDL = ("fold INT, column STRING, kind STRING, position INT, idx INT, category STRING, "
              "mean DOUBLE, std DOUBLE")


def fit_columns(df: DataFrame, label: str | None = None, by: str | None = None,
                numeric: Sequence[str] | None = None, categorical: Sequence[str] | None = None) -> FittedColumns:
    """Fit scaling and indicators on ``df`` (per fold when ``by`` names the fold column).

    By default every numeric column is scaled and every text column encoded, in schema order;
    a column of any other type raises instead of being dropped unseen.
    """
    skip = {c for c in (label, by, "split") if c}
    numbers = [c for c in numeric_columns(df) if c not in skip] if numeric is None else list(numeric)
    texts = [c for c in string_columns(df) if c not in skip] if categorical is None else list(categorical)
    if numeric is None and categorical is None:
        loose = [c for c in df.columns if c not in skip and c not in numbers and c not in texts]
        if loose:
            raise ValueError(f"columns of a type that is neither numeric nor text: {', '.join(loose)}")
    fold = F.col(by).cast("int") if by else F.lit(None).cast("int")
    source = df.withColumn("_fold", fold)
    coded = [*texts, *([label] if label else [])]
    means: dict = {}
    categories: dict = {}
    if numbers:
        # One row per fold and column: folds are a parameter of the split, columns of the table.
        for r in fit_scaler(source, numbers, "_fold").collect():
            means.setdefault(r["_fold"], {})[r["column"]] = (r["mean"], r["std"])
    large: dict = {}
    if coded:
        found = kept(distinct_categories(source, coded, "_fold"))
        sizes = {r["column"]: r["n"] for r in found.groupBy("column").agg(F.count_distinct("category").alias("n")).collect()}
        many = [c for c in coded if sizes.get(c, 0) > LITERAL_CATEGORIES]
        # At most LITERAL_CATEGORIES values of each column and fold.
        for r in found.filter(~F.col("column").isin(many)).collect():
            categories.setdefault(r["_fold"], {}).setdefault(r["column"], []).append(r["category"])
        for c in many:
            large[c] = build(found.filter(F.col("column") == c).select(F.col("_fold").alias("fold"), "category"), sizes[c], by is not None)
        if many:
            for r in found.select("_fold").distinct().collect():
                categories.setdefault(r["_fold"], {})
    for per_column in categories.values():
        for c in per_column:
            per_column[c] = sorted(per_column[c])
    for f in {*means, *categories}:
        means.setdefault(f, {})
        categories.setdefault(f, {})
    return FittedColumns(tuple(numbers), tuple(texts), label, means, categories, large)


def _by_fold(fitted: FittedColumns, by: str | None, build) -> Column:
    """``build(fold)`` for the row's fold; a plain expression when there is only one."""
    folds = fitted.folds
    if by is None:
        if len(folds) != 1:
            raise ValueError("fitted per fold: pass the fold column, or use only(fold)")
        return build(folds[0])
    out = None
    for f in folds:
        out = F.when(F.col(by) == f, build(f)) if out is None else out.when(F.col(by) == f, build(f))
    return out


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _code_column(k: int) -> str:
    return f"_code_{k}"


def _coded(df: DataFrame, fitted: FittedColumns, columns: Sequence[str], by: str | None, unseen: str) -> DataFrame:
    """Add ``_code_<k>`` for each of the columns: the place of its value in the domain over all folds, -1 for others.

    A value that the row's fold has not seen raises (``error``) or has -1 (``keep``). Every value is looked up once, in a
    literal where the domain is small and else in a joined table of one row per category and fold.
    """
    for k, c in enumerate(columns):
        value = F.col(c).cast("string")
        if c not in fitted.large:
            domain = fitted.domain(c)
            place = F.array_position(F.array(*map(F.lit, domain)), value) if domain else F.lit(0)
            code = F.coalesce(place.cast("int") - 1, F.lit(-1))
            known = _by_fold(fitted, by, lambda f, c=c, value=value: F.coalesce(
                value.isin(fitted.categories[f].get(c, [])), F.lit(False)) if fitted.categories[f].get(c) != domain else code >= 0)
            df = df.withColumn(_code_column(k), F.when(known, code).otherwise(-1))
        else:
            dictionary = fitted.large[c]
            if by is None and len(fitted.folds) != 1:
                raise ValueError("fitted per fold: pass the fold column, or use only(fold)")
            table = dictionary.table.withColumnsRenamed({"fold": "_f", "category": "_v", "place": "_i"})
            keys = df.withColumn("_v", value)
            if dictionary.per_fold:
                fold = F.lit(fitted.folds[0]) if by is None else F.col(by)
                found = lookup(keys.withColumn("_f", fold.cast("int")), table, ["_f", "_v"], "left")
            else:
                found = lookup(keys, table, "_v", "left")
            df = found.withColumn(_code_column(k), F.coalesce("_i", F.lit(-1))).drop("_f", "_v", "_i")
        if unseen == "error":
            text = _unseen_text(c)
            if c in fitted.large:
                # A later filter must not move below the join's own filters, where it would raise for rows of its other branch.
                text = F.concat(text, F.substring(F.rand().cast("string"), 1, 0))
            df = df.withColumn(_code_column(k), F.when(F.col(_code_column(k)) >= 0, F.col(_code_column(k))).otherwise(
                F.raise_error(text).cast("int")))
    return df


def category_codes(df: DataFrame, fitted: FittedColumns) -> tuple[DataFrame, list[str]]:
    """The place of each categorical value, -1 for an unknown one, in new columns, and their names."""
    columns = list(fitted.categorical)
    return _coded(df, fitted, columns, None, "keep"), [_code_column(k) for k in range(len(columns))]


def _indicator_sql(fitted: FittedColumns, columns: Sequence[str]) -> list[str]:
    """One short expression for each category: whether the code is its place."""
    return [f"CAST({_code_column(k)} = {i} AS DOUBLE) AS {_quoted(f'{c}_{v}')}"
            for k, c in enumerate(columns) for i, v in enumerate(fitted.domain(c))]


def transform_with(df: DataFrame, fitted: FittedColumns, by: str | None = None, keep: Sequence[str] = (),
                   unseen: str = "error", with_label: bool = False) -> DataFrame:
    """Apply fitted values: the ``keep`` columns, scaled numbers, indicators, label indicators.

    A missing input column raises at once. An unseen category raises (``error``), becomes all
    zeros (``keep``), or drops the row (``skip``).
    """
    need = [*fitted.numeric, *fitted.categorical, *keep, *([by] if by else [])]
    if with_label and fitted.label:
        need.append(fitted.label)
    require_columns(df, need)
    columns = [*fitted.categorical, *([fitted.label] if with_label and fitted.label else [])]
    coded = _coded(df, fitted, columns, by, "keep" if unseen == "skip" else unseen)
    if unseen == "skip":
        for k in range(len(fitted.categorical)):
            coded = coded.filter(F.col(_code_column(k)) >= 0)
    return coded.select(*[F.col(c) for c in keep], *_scaled_columns(fitted, by), *map(F.expr, _indicator_sql(fitted, columns)))


def _scaled_columns(fitted: FittedColumns, by: str | None) -> list[Column]:
    out = []
    for c in fitted.numeric:
        def one(f, c=c):
            mean, std = fitted.means[f][c]
            return scaled(F.col(c), F.lit(mean), F.lit(std))
        out.append(_by_fold(fitted, by, one).alias(c))
    return out


def feature_columns(fitted: FittedColumns, by: str | None = None) -> list[Column]:
    """The scaled numbers and indicators as expressions over the raw columns; unseen categories are all zeros.

    For a few dense columns inside another projection; :func:`transform_with` looks values of large domains up by a join.
    """
    out = _scaled_columns(fitted, by)
    for c in fitted.categorical:
        value = F.col(c).cast("string")
        seen = {f: set(fitted.seen(f, c)) for f in fitted.folds}
        for v in fitted.domain(c):
            # A category that this fold has not seen is no indicator of it.
            hit = _by_fold(fitted, by, lambda f, v=v: value == F.lit(v) if v in seen[f] else F.lit(False))
            out.append(F.coalesce(hit, F.lit(False)).cast("double").alias(f"{c}_{v}"))
    return out


def sparse_cells(df: DataFrame, fitted: FittedColumns, by: str | None = None, keep: Sequence[str] = (),
                 unseen: str = "error") -> DataFrame:
    """``keep``, ``size``, ``indices`` and ``values``: what :func:`transform_with` makes dense, no column for each category.

    The scaled numbers lie first, then the indicators in the order of ``feature_names``; zeros are left out. No category
    comes to the driver.
    """
    require_columns(df, [*fitted.numeric, *fitted.categorical, *keep])
    coded = _coded(df, fitted, fitted.categorical, by, "keep" if unseen == "skip" else unseen)
    if unseen == "skip":
        for k in range(len(fitted.categorical)):
            coded = coded.filter(F.col(_code_column(k)) >= 0)
    width, cells = len(fitted.numeric), []
    for i, x in enumerate(_scaled_columns(fitted, by)):
        cells.append(F.struct(F.lit(i).alias("i"), x.alias("v")))
    for k, c in enumerate(fitted.categorical):
        code = F.col(_code_column(k))
        cells.append(F.when(code >= 0, F.struct((code + width).alias("i"), F.lit(1.0).alias("v"))))
        width += fitted.width(c)
    there = F.filter(F.array(*cells), lambda x: x.isNotNull() & (x["v"] != 0)) if cells else F.array().cast("array<struct<i:int,v:double>>")
    return coded.select(*keep, F.lit(width).alias("size"), F.transform(there, lambda x: x["i"]).alias("indices"),
                        F.transform(there, lambda x: x["v"]).alias("values"))


def sparse_vector(df: DataFrame, fitted: FittedColumns, by: str | None = None, keep: Sequence[str] = (),
                  unseen: str = "error", name: str = "features") -> DataFrame:
    """``keep`` and the cells of :func:`sparse_cells` as one sparse vector."""
    cells = sparse_cells(df, fitted, by, keep, unseen)
    body = F.struct(F.lit(0).cast("tinyint").alias("type"), "size", "indices", "values")
    # The parser reads the stored form of a vector; there is no function from indices and values to one.
    read = F.from_json(F.to_json(F.struct(body.alias("v"))), T.StructType([T.StructField("v", VectorUDT())]))
    return cells.select(*keep, read["v"].alias(name))


def apply_one_hot(df: DataFrame, fitted: FittedColumns, by: str | None = None, keep: Sequence[str] = (),
                  unseen: str = "error") -> DataFrame:
    """Only the indicator columns of :func:`transform_with`."""
    texts = FittedColumns((), fitted.categorical, fitted.label, fitted.means, fitted.categories, fitted.large)
    return transform_with(df, texts, by, keep, unseen)


def fit_transform_columns(df: DataFrame, label: str, fold: str = "fold", split: str = "split",
                          keep: Sequence[str] = (), shared_fit: str | None = None) -> tuple[DataFrame, FittedColumns]:
    """Fit on the ``train`` rows of each fold and transform its train and validation rows.

    Each fold has its own fit; ``shared_fit="last"`` makes all folds use the last one's. The
    result holds ``keep``, the scaled numbers, feature indicators and label indicators. Both fits and the result read the rows, so
    they are written first: what made them, such as splits, runs once.
    """
    df = kept(df)
    train = df.filter(F.col(split) == "train")
    features = [c for c in df.columns if c not in {*keep, label, fold, split}]
    numbers = [c for c in numeric_columns(df) if c in features]
    texts = [c for c in string_columns(df) if c in features]
    fitted = fit_columns(train, label, fold, numbers, texts)
    if shared_fit == "last":
        last = fitted.folds[-1]
        fitted = FittedColumns(fitted.numeric, fitted.categorical, label,
                               {f: fitted.means[last] for f in fitted.folds},
                               {f: fitted.categories[last] for f in fitted.folds},
                               {c: d.of_fold(last) for c, d in fitted.large.items()})
    rows = df.filter(F.col(split).isin("train", "validation"))
    return transform_with(rows, fitted, fold, [*keep, fold, split], with_label=True), fitted


def fitted_rows(spark: SparkSession, fitted: FittedColumns) -> DataFrame:
    """The fitted values as a long table (see ``FITTED_DDL``); ``idx`` of a large column is the place over all folds."""
    rows = []
    coded = [*((c, "categorical") for c in fitted.categorical), *([(fitted.label, "label")] if fitted.label else [])]
    for f in fitted.folds:
        for i, c in enumerate(fitted.numeric):
            mean, std = fitted.means[f][c]
            rows.append((f, c, "numeric", i, None, None, mean, std))
        for i, (c, kind) in enumerate(coded):
            for idx, v in enumerate(fitted.categories[f].get(c, [])):
                rows.append((f, c, kind, i, idx, v, None, None))
    out = spark.createDataFrame(rows, T.StructType.fromDDL(FITTED_DDL))
    for i, (c, kind) in enumerate(coded):
        if c in fitted.large:
            d = fitted.large[c]
            fold = F.col("fold") if d.per_fold else F.explode(F.array(*[F.lit(f).cast("int") for f in fitted.folds])).alias("fold")
            out = out.unionByName(d.table.select(
                fold, F.lit(c).alias("column"), F.lit(kind).alias("kind"), F.lit(i).alias("position"), F.col("place").alias("idx"),
                "category", F.lit(None).cast("double").alias("mean"), F.lit(None).cast("double").alias("std")))
    return out


def fitted_from_rows(table: DataFrame) -> FittedColumns:
    """Read back what :func:`fitted_rows` wrote; columns with many categories stay in the table."""
    coded = table.filter("kind <> 'numeric'").groupBy("column").agg(
        F.first("kind").alias("kind"), F.first("position").alias("position"), F.count_distinct("category").alias("n"),
        F.count("fold").alias("folded")).collect()
    large = {r["column"]: Dictionary(
        table.filter(F.col("column") == r["column"]).select(*(["fold"] if r["folded"] else []), "category", F.col("idx").alias("place")),
        r["n"], r["folded"] > 0) for r in coded if r["n"] > LITERAL_CATEGORIES}
    rows = table.filter(~F.col("column").isin(list(large)) | (F.col("kind") == "numeric")).collect()
    means: dict = {}
    categories: dict = {}
    numeric: dict = {}
    texts = {r["column"]: r["position"] for r in coded if r["kind"] == "categorical"}
    label = next((r["column"] for r in coded if r["kind"] == "label"), None)
    folds = [r["fold"] for r in table.select("fold").distinct().collect()] if large else []
    for f in folds:
        means.setdefault(f, {})
        categories.setdefault(f, {})
    for r in sorted(rows, key=lambda r: (r["fold"] is not None, r["fold"] or 0, r["kind"], r["position"], r["idx"] or 0)):
        f, c = r["fold"], r["column"]
        means.setdefault(f, {})
        categories.setdefault(f, {})
        if r["kind"] == "numeric":
            numeric[c] = r["position"]
            means[f][c] = (r["mean"], r["std"])
        else:
            categories[f].setdefault(c, []).append(r["category"])
    return FittedColumns(tuple(sorted(numeric, key=numeric.get)), tuple(sorted(texts, key=texts.get)),
                         label, means, categories, large)
