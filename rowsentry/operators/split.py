"""Seeded shuffles, exact stratified splits and folds, percentage samples.

The order of the rows is the md5 of ``seed|key``, so a split depends only on the seed and on a
key, not on partitioning. No split sorts or shuffles the table. The class counts give the quotas,
and the last train row of a class, its cut, is found by narrowing a range of hashes: one pass
counts the rows before the range and those in each part of it, and the part that holds the quota
is the next range; once few enough rows are left, they are counted one by one. As hashes are
uniform, the cut of a class of c rows lies within a few times sqrt(c) rows of where its quota
predicts, and the first range is that band, so that one pass does for classes of up to about
10^8 rows and two beyond. Where the cut lies elsewhere, the search goes on there. Every row is then
compared with the cut of its class. All folds are found, and applied, on one row with a hash for each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowsentry.fixed_values import FOLD_SEED, FOLDS, TEST_PERCENT, TEST_SEED
from rowsentry.functions.keys import hash_percent, row_key, seeded_hash
from rowsentry.functions.names import as_list
from rowsentry.operators.ranking import BUCKET_HEX, bucketed_rank, hash_bucket
from rowsentry.operators.sizing import heavy_keys, join_unique, kept, settle_small

# Deviations of a class's cut from its expected place that the first range covers.
_SPREADS = (6.0,)
# Parts of a range, and the rows of a class and fold that are counted one by one.
_SLOTS, _LEAF_ROWS = 1024, 200_000
# Hashes are compared as text and cut into parts by their first digits as a number.
_DIGITS = 15
_TOP = 16 ** _DIGITS


def shuffle_rows(df: DataFrame, key: str | Sequence[str], seed: int = TEST_SEED) -> DataFrame:
    """All rows in a seeded random order (a range-partitioned sort)."""
    k = row_key(*as_list(key))
    return df.orderBy(seeded_hash(seed, k), k)


def shuffle_rank(df: DataFrame, key: str | Sequence[str], seed: int = TEST_SEED,
                 digits: int = BUCKET_HEX) -> DataFrame:
    """Add ``rank``, the row's place from 1 in the seeded order of :func:`shuffle_rows`."""
    keyed = df.withColumn("_k", row_key(*as_list(key))).withColumn("_h", seeded_hash(seed, "_k"))
    ranked = bucketed_rank(keyed.withColumn("_all", F.lit(0)), ["_all"], hash_bucket("_h", digits),
                           ["_h", "_k"], "rank")
    return ranked.drop("_k", "_h", "_all")


def _quotas(counts: DataFrame, percent: int) -> DataFrame:
    """Train quota ``_quota`` of each class (``_label``, ``_c``) by largest remainder."""
    # One row per class from here on.
    everything = Window.partitionBy(F.lit(0))
    sized = counts.select(
        "_label", "_c", F.sum("_c").over(everything).alias("_n"), F.count("*").over(everything).alias("_classes"),
        F.min("_c").over(everything).alias("_least"), F.max(F.col("_label").isNull()).over(everything).alias("_nameless"))
    sized = sized.withColumn("_test", F.expr(f"(_n * {int(percent)} + 99) div 100")).withColumn("_train", F.expr("_n - _test"))
    product = "cast(_c as decimal(38,0)) * _train"
    whole = sized.select("*", F.expr(f"cast({product} div _n as bigint)").alias("_base"),
                         F.expr(f"cast({product} % _n as bigint)").alias("_rest"))
    turn = F.row_number().over(everything.orderBy(F.desc("_rest"), F.asc("_label")))
    short = F.col("_train") - F.sum("_base").over(everything)

    def refuse(reason: str) -> Column:
        return F.raise_error(F.lit(reason)).cast("bigint")

    quota = (
        F.when(F.col("_nameless"), refuse("a label is null"))
        .when(F.col("_least") < 2, refuse("a class has fewer than 2 rows"))
        .when((F.col("_train") < F.col("_classes")) | (F.col("_test") < F.col("_classes")),
              refuse("a side of the split has fewer rows than there are classes"))
        .otherwise(F.col("_base") + (turn <= short).cast("bigint"))
    )
    return whole.select("_label", "_c", quota.alias("_quota"))


def _first_ranges(quotas: DataFrame, folds: Sequence[int], spread: float) -> DataFrame:
    """The range of hashes (``_lo`` to before ``_hi``) in which each class and fold is searched first.

    ``_known`` is the number of rows before the range (null: not counted yet), ``_size`` that of the rows in it.
    """
    share = F.col("_quota") / F.col("_c")
    margin = F.lit(spread) * F.sqrt(share * (1 - share) / F.col("_c")) + 2 / F.col("_c")
    low, high = F.greatest(share - margin, F.lit(0.0)), F.least(share + margin, F.lit(1.0))
    return quotas.filter("_quota > 0").select(
        "_label", F.explode(F.array(*[F.lit(f) for f in folds])).alias("_fold"), "_c", "_quota",
        F.floor(low * F.lit(float(_TOP))).cast("bigint").alias("_lo"), F.ceil(high * F.lit(float(_TOP))).cast("bigint").alias("_hi"),
        F.when(low <= 0, F.lit(0)).cast("bigint").alias("_known"), F.ceil((high - low) * F.col("_c")).cast("bigint").alias("_size"))


def _by_class(table: DataFrame, columns: Sequence[str], folds: Sequence[int], name: str) -> DataFrame:
    """One row per class with a struct ``<name><fold>`` of the columns for each fold."""
    one = [F.max(F.when(F.col("_fold") == f, F.struct(*columns))).alias(f"{name}{f}") for f in folds]
    return table.groupBy("_label").agg(*one)


def _met(rows: DataFrame, table: DataFrame, small: bool, how: str, hot: Sequence[str] | None) -> DataFrame:
    """The rows with what ``table`` holds of their class; a table that is not small meets them by a guarded shuffle."""
    return rows.join(F.broadcast(table), "_label", how) if small else join_unique(rows, table, "_label", how, hot)


def _narrowed(rows: DataFrame, ranges: DataFrame, folds: Sequence[int], small: bool, hot: Sequence[str] | None,
              together: bool) -> DataFrame:
    """The ranges after one pass over the rows: narrower, or with the cut (``_ch``, ``_ck``) once it is found."""
    step = F.when((F.col("_size") <= _LEAF_ROWS) | (F.col("_hi") - F.col("_lo") <= 1), F.lit(0)).otherwise(
        F.expr(f"(_hi - _lo + {_SLOTS - 1}) div {_SLOTS}")).cast("bigint")
    ranges = ranges.withColumn("_step", step)

    def digits(number: str) -> Column:
        return F.when(F.col(number) >= _TOP, "g").otherwise(F.lpad(F.lower(F.hex(number)), _DIGITS, "0"))

    wide = _by_class(ranges.withColumn("_from", digits("_lo")).withColumn("_to", digits("_hi")),
                     ["_from", "_to", "_lo", "_step", "_known"], folds, "_r")
    met = _met(rows, wide, small, "inner", hot)
    found = []
    for f in folds:
        h, r = F.col(f"_h{f}"), F.col(f"_r{f}")
        inside, leaf = h >= r["_from"], r["_step"] == 0
        part = F.call_function("div", F.conv(F.substring(h, 1, _DIGITS), 16, 10).cast("bigint") - r["_lo"], r["_step"])
        slot = F.when(~inside, F.lit(-1)).when(leaf, F.lit(0)).otherwise(part).cast("bigint")
        found.append(F.when((h < r["_to"]) & (inside | r["_known"].isNull()), F.struct(
            F.lit(f).alias("_fold"), slot.alias("_slot"), F.when(inside & leaf, h).alias("_ch"), F.when(inside & leaf, F.col("_k")).alias("_ck"))))
    counted = met.select("_label", F.explode(F.array(*found)).alias("_at")).filter("_at is not null").groupBy(
        "_label", "_at._fold", "_at._slot", "_at._ch", "_at._ck").agg(F.count("*").alias("_w"))
    both = ["_label", "_fold"]
    known = ranges.select(*both, "_quota", F.coalesce("_known", F.lit(0)).alias("_before"))
    along = Window.partitionBy(*both).orderBy("_slot", F.asc_nulls_first("_ch"), "_ck").rowsBetween(Window.unboundedPreceding, 0)
    run = F.col("_before") + F.sum("_w").over(along)
    # Per class and fold at most the parts of a range, or the rows that are counted one by one.
    hits = counted.join(F.broadcast(known) if small else known, both).withColumn("_run", run).groupBy(*both).agg(
        F.min(F.when(F.col("_run") >= F.col("_quota"), F.struct("_run", "_slot", "_ch", "_ck", "_w"))).alias("_hit"), F.max("_run").alias("_total"))
    after = ranges.join(hits, both, "left")
    hit, total = F.col("_hit"), F.coalesce("_total", "_known", F.lit(0))
    beyond, before = hit.isNull(), hit["_slot"] < 0
    start = F.col("_lo") + hit["_slot"] * F.col("_step")
    astride = F.lit(not together) & hit["_ch"].isNotNull() & (hit["_w"] > 1) & (hit["_run"] > F.col("_quota"))
    cut = F.when(astride, F.raise_error(F.lit("the key is not unique at the cut of a class")).cast("string")).otherwise(hit["_ch"])
    lost = F.raise_error(F.lit("the rows changed while they were counted")).cast("bigint")
    return after.select(
        *both, "_c", "_quota",
        F.when(beyond, F.when(F.col("_hi") >= _TOP, lost).otherwise(F.col("_hi"))).when(before, F.lit(0)).otherwise(start).cast("bigint").alias("_lo"),
        F.when(beyond, F.lit(_TOP)).when(before, F.col("_lo")).otherwise(F.least("_hi", start + F.col("_step"))).cast("bigint").alias("_hi"),
        F.when(beyond, total).when(before, F.lit(0)).otherwise(hit["_run"] - hit["_w"]).cast("bigint").alias("_known"),
        F.when(beyond, F.col("_c") - total).otherwise(hit["_w"]).cast("bigint").alias("_size"),
        cut.alias("_ch"), hit["_ck"].alias("_ck"))


def _small(table: DataFrame) -> tuple[DataFrame, int | None]:
    """A class table, marked for broadcast when measured to be small, and its size if so."""
    settled, size = settle_small(table)
    return (settled if size is None else F.broadcast(settled)), size


class _Cuts:
    """The cuts of all classes in some folds: one row per class, found by as many passes as :func:`_narrowed` needs."""

    def __init__(self, rows: DataFrame, quotas: DataFrame, small: bool, folds: Sequence[int], together: bool):
        lean = rows.select("_label", "_k", *[f"_h{f}" for f in folds])
        self.folds = folds
        self.hot = None if small else heavy_keys(lean.filter("_label is not null"), F.col("_label"))
        ranges, found = _first_ranges(quotas, folds, _SPREADS[0]), None
        while True:
            after, size = settle_small(_narrowed(lean, ranges, folds, small, self.hot, together))
            if size is None:
                after = kept(after)
            done, ranges = after.filter("_ch is not null").select("_label", "_fold", "_ch", "_ck"), after.filter("_ch is null").drop("_ch", "_ck")
            small = size is not None
            found = done if found is None else found.unionAll(done)
            if ranges.isEmpty():
                break
        wide, size = settle_small(_by_class(found, ["_ch", "_ck"], folds, "_cut"))
        self.table, self.small = wide, size is not None

    def applied(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``_in<fold>``, whether the row is a train row of the fold; a class without a cut has none."""
        joined = _met(rows, self.table, self.small, "left", self.hot)
        for f in self.folds:
            h, cut = F.col(f"_h{f}"), F.col(f"_cut{f}")
            before = (h < cut["_ch"]) | ((h == cut["_ch"]) & (F.col("_k") <= cut["_ck"]))
            joined = joined.withColumn(f"_in{f}", F.coalesce(before, F.lit(False)))
        return joined.drop(*[f"_cut{f}" for f in self.folds])


def _class_quotas(df: DataFrame, label: str, percent: int) -> tuple[DataFrame, bool]:
    """Quotas from the class counts (a scan of the label column alone), and whether they are few."""
    table, size = _small(_quotas(df.groupBy(F.col(label).alias("_label")).agg(F.count("*").alias("_c")), percent))
    return table, size is not None


def _keyed(df: DataFrame, label: str, key: Sequence[str]) -> DataFrame:
    return df.withColumn("_label", F.col(label)).withColumn("_k", row_key(*key))


def _with_fold_hashes(rows: DataFrame, folds: Sequence[int], seed: int) -> DataFrame:
    return rows.withColumns({f"_h{f}": seeded_hash(f"{seed}|{f}", "_k") for f in folds})


def _sides(folds: Sequence[int]) -> Column:
    """The folds of a row with its side in each."""
    return F.array(*[F.struct(F.lit(f).alias("fold"), F.when(F.col(f"_in{f}"), "train").otherwise("validation").alias("split")) for f in folds])


def stratified_split(df: DataFrame, label: str, key: str | Sequence[str], percent: int = TEST_PERCENT,
                     seed: int = TEST_SEED, together: bool = False) -> DataFrame:
    """Add ``split`` (``train`` or ``test``) with exact per-class quotas.

    Nulls in ``label``, classes of one row and splits smaller than the number of classes raise. So
    does a key that several rows of a class share where its quota ends between them; with
    ``together`` they all go to train then, and the quota is exceeded by the rest of them.
    """
    rows = _keyed(df, label, as_list(key)).withColumn("_h0", seeded_hash(seed, "_k"))
    placed = _Cuts(rows, *_class_quotas(df, label, percent), [0], together).applied(rows)
    return placed.select(*df.columns, F.when(F.col("_in0"), "train").otherwise("test").alias("split"))


def stratified_folds(df: DataFrame, label: str, key: str | Sequence[str], folds: int = FOLDS,
                     percent: int = TEST_PERCENT, seed: int = FOLD_SEED, together: bool = False) -> DataFrame:
    """Each row once per fold, with ``fold`` from 1 and ``split`` ``train`` or ``validation``.

    The folds are independent re-splits of the same rows, so validation sets may overlap. Repeated keys: :func:`stratified_split`.
    """
    numbers = range(1, int(folds) + 1)
    rows = _with_fold_hashes(_keyed(df, label, as_list(key)), numbers, seed)
    placed = _Cuts(rows, *_class_quotas(df, label, percent), numbers, together).applied(rows)
    return placed.select(*df.columns, F.inline(_sides(numbers)))


def append_folds(*parts: DataFrame) -> DataFrame:
    """Fold tables under each other, matched by column name."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def split_and_fold(df: DataFrame, label: str, key: str | Sequence[str], folds: int = FOLDS,
                   percent: int = TEST_PERCENT, test_seed: int = TEST_SEED, fold_seed: int = FOLD_SEED,
                   together: bool = False) -> DataFrame:
    """The whole plan of splits in one table: ``test`` rows with fold 0, and the folds of the rest.

    Once the cuts are known, one scan places every row and unfolds the train rows. Repeated keys: :func:`stratified_split`.
    """
    numbers = range(1, int(folds) + 1)
    quotas, few = _class_quotas(df, label, percent)
    rows = _keyed(df, label, as_list(key)).withColumn("_h0", seeded_hash(test_seed, "_k"))
    placed = _with_fold_hashes(_Cuts(rows, quotas, few, [0], together).applied(rows).drop("_h0"), numbers, fold_seed)
    rest = placed.filter("_in0")
    # The class counts of the rest are the quotas just met, unless rows of a key stayed together.
    counts = rest.groupBy("_label").agg(F.count("*").alias("_c")) if together else (
        quotas.filter("_quota > 0").select("_label", F.col("_quota").alias("_c")))
    rest_quotas, size = _small(_quotas(counts, percent))
    final = _Cuts(rest, rest_quotas, size is not None, numbers, together).applied(placed)
    test = F.array(F.struct(F.lit(0).alias("fold"), F.lit("test").alias("split")))
    return final.select(*df.columns, F.inline(F.when(F.col("_in0"), _sides(numbers)).otherwise(test)))


def sample_percent(df: DataFrame, percent: int, key: str) -> DataFrame:
    """The rows whose key falls into the first ``percent`` of 100 hash buckets."""
    if not 0 <= percent <= 100:
        raise ValueError("percent must lie between 0 and 100")
    return df if percent == 100 else df.filter(hash_percent(key) < percent)
