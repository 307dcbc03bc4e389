"""N-gram Jaccard join: an exact similarity join of shingle sets through trees over their group counts.

Equal sets are one class from the start. Classes meet under the first quarter of their shingles (in an order that puts the most
frequent shingles last, then goes by hash): two sets with a Jaccard similarity of 0.75 or more share at least one of these. Under
each such shingle

* first every class is bounded against classes of about its size that it meets most often. What passes forms clusters, and
  within a cluster, which holds its sets once, all sets are compared exactly (the bound is laxer here than the join asks);
* then classes of different clusters are searched through a tree: the shingles of a set, hashed into groups, give a point
  of group counts, and the sum of the smaller coordinates bounds the overlap of two points, or of a point and a box of
  points.

The tree's points have ``GROUPS`` coordinates; pairs it finds must pass the same bound on points with about one group for four
shingles, as the pairs that form clusters must. What survives is verified on the exact sets, and components are formed of the
verified links. Clusters, and classes under one shingle, are compared in blocks of bounded size, so no group of copies and
no shingle, however frequent, is one task's work.

Words lie between ASCII white space, A-Z lower-cased. Sets, like shingles, are told apart by 64-bit hashes. A text with fewer
words than a shingle has one shingle, all its words; null and empty texts and texts without words have none and are linked
with nothing. Repeated rows are rows of the same class. Other columns take no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsentry.llm.common import mix, pieces, release, settle, shingle_hashes, span_hashes, utf8, word_spans
from rowsentry.llm.components import components

WORDS = 5
#: Similarity in percent.
PERCENT = 75
GROUPS = 128
#: Frequent shingles put last in the order; only the plan depends on them.
FREQUENT = 1 << 18
#: Shingles that a task counts at a time, and how often one must be among them.
COUNTED = 1 << 20
FREQUENT_AMONG = 2
#: Classes under one shingle that one step holds; more are split.
RUN_ROWS = 8_192
LEAF = 64
#: Pairs that a task gathers before it drops repeats or hands them on.
PAIRS_HELD = 1 << 20
#: Shingles for each group of the finer points, and the most groups they have.
PER_GROUP = 4
MOST_GROUPS = 1 << 13
#: Coordinates of the tree's points end here; what is above counts as overlap.
MOST_COUNT = 32_767
BITMAP_BITS = 23
#: Similarity in percent that a bound must allow for a cluster: less than the join's, so that hardly any member of a group of
#: near copies is left to the search between clusters. Within clusters all sets are compared, whatever brought them together.
CLUSTER_PERCENT = 65
#: Shingles of a cluster's sets that one step holds for each side of a block.
CLUSTER_SHINGLES = 1 << 20
#: Rows of ids and sets that are broadcast at most; more are joined by a shuffle.
SMALL_ROWS = 300_000
#: Rows of whole sets in an Arrow batch.
SET_ROWS = 512
#: Ids from -2^61 down stand for rows without one.
NO_ID = 1 << 61


def _sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, ascending, one text after the other, and the place of each text's first."""
    data, offsets = utf8(column)
    starts, ends, bounds = word_spans(data, offsets)
    hashes, cuts = shingle_hashes(span_hashes(data, starts, ends), bounds, WORDS)
    of = np.repeat(np.arange(len(column)), np.diff(cuts))
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    return hashes[new], np.searchsorted(of[new], np.arange(len(column) + 1))


def _set_ids(hashes: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """One 64-bit id for each set."""
    size = np.diff(cuts)
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(mix(hashes ^ np.uint64(0xA0761D6478BD642F)), out=total[1:], dtype=np.uint64)
    return mix(total[cuts[1:]] - total[cuts[:-1]] + size.astype(np.uint64)).view(np.int64)


def frequent_shingles(docs: DataFrame, column: str) -> np.ndarray:
    """Hashes, sorted, of the shingles that repeat most across texts, from counts over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *held]), return_counts=True)
            some = counts >= FREQUENT_AMONG
            return pa.RecordBatch.from_arrays([pa.array(keys[some].view(np.int64)), pa.array(counts[some])], names=["shingle", "n"])

        for piece in pieces(batches, column):
            held.append(_sets(piece.column(column))[0])
            size += len(held[-1])
            if size >= COUNTED:
                yield counted()
                held, size = [], 0
        yield counted()

    best = docs.select(column).mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")) \
        .orderBy(F.desc("n"), "shingle").limit(FREQUENT).select("shingle")
    return np.sort(np.array([r["shingle"] for r in best.collect()], np.int64).view(np.uint64))


def _signatures(docs: DataFrame, column: str, frequent: np.ndarray) -> DataFrame:
    """``id, n, set`` for each text, and, once a task and set, its ``keys`` in their order and group ``counts``."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = shared.value
        told: set[int] = set()
        for piece in pieces(batches, column):
            hashes, cuts = _sets(piece.column(column))
            ids, size = _set_ids(hashes, cuts), np.diff(cuts)
            fresh = np.zeros(len(ids), bool)
            if len(told) > 1 << 20:
                told.clear()
            for k, (i, n) in enumerate(zip(ids.tolist(), size.tolist())):
                if n and i not in told:
                    told.add(i)
                    fresh[k] = True
            of = np.repeat(np.arange(len(ids)), size)
            place = np.searchsorted(last, hashes)
            often = last[np.minimum(place, max(len(last) - 1, 0))] == hashes if len(last) else np.zeros(len(hashes), bool)
            order = np.lexsort((hashes, often, of))
            rank = np.arange(len(hashes)) - np.repeat(cuts[:-1], size)
            prefix = np.where(fresh, size // 4 + 1, 0)
            keys = hashes[order][(rank < np.repeat(prefix, size)) & np.repeat(fresh, size)].view(np.int64)
            groups = np.where(fresh, np.clip(1 << np.ceil(np.log2(np.maximum(size / PER_GROUP, 1))).astype(np.int64),
                                             GROUPS, MOST_GROUPS), 0)
            start = np.cumsum(groups) - groups
            mine = np.repeat(fresh, size)
            group = np.repeat(start, size)[mine] + (hashes[mine] >> np.uint64(40)).astype(np.int64) % np.repeat(groups, size)[mine]
            counts = np.bincount(group, minlength=int(groups.sum())).astype(np.int32)
            ends = lambda n: pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), pa.array(size, pa.int32()), pa.array(ids),
                 pa.ListArray.from_arrays(ends(np.minimum(prefix, size)), pa.array(keys)),
                 pa.ListArray.from_arrays(ends(groups), pa.array(counts))], names=["id", "n", "set", "keys", "counts"])

    return docs.select("id", column).mapInArrow(run, "id long, n int, set long, keys array<long>, counts array<int>")


RATIO = math.log(100 / PERCENT)


def whole_runs(batches: Iterator[pa.RecordBatch], columns: list[str], keys: int, uneven: str = "") -> Iterator[tuple[dict, bool]]:
    """Sorted rows regrouped so that no run of the first ``keys`` columns is cut, up to ``16 * RUN_ROWS`` rows of one run.

    The flag says that the last run goes on; the caller may hand rows back by ``send``. Lists have one length each, but
    for those of the column ``uneven``.
    """
    kept: dict | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = {c: _numpy(batch.column(c), c == uneven) for c in columns}
        if kept is not None:
            rows = {c: np.concatenate([kept[c], rows[c]]) for c in columns}
        same = np.ones(len(rows[columns[0]]), bool)
        for c in columns[:keys]:
            same &= rows[c] == rows[c][-1]
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if cut:
            yield {c: v[:cut] for c, v in rows.items()}, False
        kept = {c: v[cut:] for c, v in rows.items()}
        if len(kept[columns[0]]) > 16 * RUN_ROWS:
            back = yield kept, True
            kept = back if back is not None else kept
            yield None, False
    if kept is not None and len(kept[columns[0]]):
        yield kept, False
    release()


def _numpy(column: pa.Array, uneven: bool = False) -> np.ndarray:
    if uneven:
        ends, flat = column.offsets.to_numpy() - column.offsets[0].as_py(), column.flatten().to_numpy()
        out = np.empty(len(column), object)
        out[:] = [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]
        return out
    if pa.types.is_list(column.type):
        return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    return column.to_numpy(zero_copy_only=False)


def first_of(change: np.ndarray) -> np.ndarray:
    """For each row the place of the last change at or before it."""
    return np.maximum.accumulate(np.where(change, np.arange(len(change)), 0))


def stand_ins(opens: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """For each row of runs sorted by size the first row of about its size, by two divisions into sizes."""
    firsts = []
    for shift in (0.0, 0.5):
        size = np.floor(np.log(n) / RATIO + shift)
        firsts.append(first_of(opens | np.concatenate([[True], size[1:] != size[:-1]])))
    return firsts


def _meetings(signatures: DataFrame) -> DataFrame:
    """``key, set, n, place`` of the classes that share a key with another class, and the classes that stand for their size."""
    rows = signatures.filter(F.size("keys") > 0).select("set", "n", F.posexplode("keys").alias("place", "key")) \
        .repartition("key").sortWithinPartitions("key", "n", "set").select("key", "n", "set", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = whole_runs(batches, ["key", "n", "set", "place"], 1)
        for rows_, open_ in source:
            if rows_ is None:
                continue
            key, n, ids, place = (rows_[c] for c in ("key", "n", "set", "place"))
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (ids[1:] != ids[:-1])
            key, n, ids, place = key[new], n[new], ids[new], place[new]
            opens = np.ones(len(key), bool)
            opens[1:] = key[1:] != key[:-1]
            start = first_of(opens)
            many = np.bincount(start, minlength=len(key))[start] > 1
            firsts = stand_ins(opens, n)
            before = np.where(opens, ids, np.roll(ids, 1))
            if many.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[many]) for x in (key, n, ids, place, ids[firsts[0]], ids[firsts[1]], before)],
                    names=["key", "n", "set", "place", "near", "nearer", "before"])
            if open_:
                # What stands for the sizes of a run that goes on meets its other rows.
                some = np.unique(np.concatenate(firsts))
                source.send({"key": key[some], "n": n[some], "set": ids[some], "place": place[some]})

    return rows.mapInArrow(run, "key long, n int, set long, place int, near long, nearer long, before long")


def needed(n: np.ndarray) -> np.ndarray:
    """The least overlap of two sets with ``n`` shingles together."""
    return -(-PERCENT * n // (100 + PERCENT))


class CountTree:
    """Points of group counts in leaves of ``LEAF``, packed by size and then by their largest spread, with boxes above them."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        # Tiles of similar size, cut again along the group that spreads most in the tile.
        order = np.argsort(sizes, kind="stable")
        tiles = []
        for a in range(0, len(order), LEAF * 8):
            tile = order[a: a + LEAF * 8]
            spread = points[tile].max(axis=0) - points[tile].min(axis=0)
            tiles.append(tile[np.argsort(points[tile, int(spread.argmax())], kind="stable")])
        self.order = np.concatenate(tiles)
        self.points, self.sizes = points[self.order].astype(np.int32), sizes[self.order]
        cuts = np.arange(0, len(self.order), LEAF)
        self.tops = np.maximum.reduceat(self.points, cuts, axis=0)
        self.least, self.most = np.minimum.reduceat(self.sizes, cuts), np.maximum.reduceat(self.sizes, cuts)

    def search(self, points: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of the searched points and of the tree's points whose bound reaches the overlap they need."""
        points = points.astype(np.int32)
        above = sizes - points.sum(axis=1)
        for leaf, top in enumerate(self.tops):
            fits = (PERCENT * self.least[leaf] <= 100 * sizes) & (PERCENT * sizes <= 100 * self.most[leaf])
            asked = np.flatnonzero(fits)
            if len(asked):
                bound = np.minimum(points[asked], top).sum(axis=1) + above[asked]
                asked = asked[bound >= needed(sizes[asked] + self.least[leaf])]
            if not len(asked):
                continue
            a = leaf * LEAF
            own, own_size = self.points[a: a + LEAF], self.sizes[a: a + LEAF]
            for i in range(0, len(asked), 512):
                some = asked[i: i + 512]
                overlap = np.minimum(points[some, None], own[None]).sum(axis=2, dtype=np.int32) + above[some, None]
                x, y = np.nonzero((overlap >= needed(sizes[some, None] + own_size[None]))
                                  & (PERCENT * np.maximum(sizes[some, None], own_size[None])
                                     <= 100 * np.minimum(sizes[some, None], own_size[None])))
                if len(x):
                    yield some[x], self.order[a + y]


def group_counts(sets: np.ndarray) -> np.ndarray:
    """The points of some shingle sets."""
    of = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    group = (np.concatenate([np.zeros(0, np.int64), *sets]).view(np.uint64) >> np.uint64(40)).astype(np.int64) % GROUPS
    return np.bincount(of * GROUPS + group, minlength=len(sets) * GROUPS).reshape(-1, GROUPS)


def _joining(x, y, root: np.ndarray, sets: np.ndarray, above: dict) -> list[int]:
    """Of the candidate pairs those that are linked and join what was apart so far; ``above`` remembers what is joined."""

    def top(r: int) -> int:
        while r in above:
            r = above[r]
        return r

    out = []
    for k, (i, j) in enumerate(zip(x.tolist(), y.tolist())):
        a, b = top(int(root[i])), top(int(root[j]))
        if a != b:
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * both >= PERCENT * (len(sets[i]) + len(sets[j]) - both):
                above[max(a, b)] = min(a, b)
                out.append(k)
    return out


def open_pairs(meetings: DataFrame, classes: DataFrame) -> DataFrame:
    """Distinct pairs ``a < b`` of classes that are not connected (``root``), share a key, and pass the tree's bound.

    ``classes`` has the points (``counts``) or, if sets are small, the sets themselves (``shingles``); then the pairs are
    verified at once, and of each run only those are given that join what was apart.
    """
    exact = "shingles" in classes.columns
    last = "shingles" if exact else "counts"
    rows = meetings.select("key", "n", "set", "place").join(classes, "set")
    crowded = meetings.groupBy("key").agg(F.count("*").alias("rows")) \
        .filter(F.col("rows") > RUN_ROWS).select("key", F.ceil(F.col("rows") / RUN_ROWS).cast("int").alias("parts"))
    mixed = rows.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("key")
    rows = rows.join(mixed, "key", "left_semi").join(crowded, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    part = F.pmod(F.xxhash64("set"), F.col("parts")).cast("int")
    names = ["key", "p", "q", "n", "set", "place", "root", "part", last]
    rows = rows.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))) \
        .withColumn("p", F.least("part", "other")).withColumn("q", F.greatest("part", "other")).select(names)
    rows = rows.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q", "n", "set")

    def pairs(rows_: dict) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        opens = np.zeros(len(rows_["key"]), bool)
        opens[:1] = True
        for c in ("key", "p", "q"):
            opens[1:] |= rows_[c][1:] != rows_[c][:-1]
        cuts = np.append(np.flatnonzero(opens), len(opens))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            n, ids, place, root, part, held = (rows_[c][a:b] for c in ("n", "set", "place", "root", "part", last))
            if b - a < 2 or (root == root[0]).all():
                continue
            one = part == rows_["p"][a]
            left, right = np.flatnonzero(one), np.flatnonzero(~one if rows_["p"][a] != rows_["q"][a] else one)
            if not len(left) or not len(right):
                continue
            points = group_counts(held) if exact else held
            tree, above = CountTree(points[left], n[left]), {}
            for x, y in tree.search(points[right], n[right]):
                x, y = right[x], left[y]
                # Under the first shingle that two sets share, what comes after it bounds their overlap, too.
                good = np.flatnonzero((root[x] != root[y]) & (np.minimum(n[x] - place[x], n[y] - place[y]) >= needed(n[x] + n[y])))
                if exact and len(good):
                    good = good[_joining(x[good], y[good], root, held, above)]
                if len(good):
                    yield np.minimum(ids[x], ids[y])[good], np.maximum(ids[x], ids[y])[good]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[np.ndarray] = []

        def distinct() -> np.ndarray:
            return np.unique(np.concatenate([np.zeros((0, 2), np.int64), *found]), axis=0)

        for rows_, open_ in whole_runs(batches, names, 3, "shingles"):
            if rows_ is None:
                continue
            if open_:
                raise RuntimeError("a block holds more classes than its key was split for")
            found += [np.stack(p, axis=1) for p in pairs(rows_)]
            if sum(map(len, found)) > PAIRS_HELD:
                found = [distinct()]
                if len(found[0]) > PAIRS_HELD // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(found[0][:, 0]), pa.array(found[0][:, 1])], names=["a", "b"])
                    found = []
        rest = distinct()
        yield pa.RecordBatch.from_arrays([pa.array(rest[:, 0]), pa.array(rest[:, 1])], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long").distinct()


def fold(counts: np.ndarray, groups: int) -> np.ndarray:
    """The counts of a power of two of groups as those of fewer groups."""
    return counts.reshape(-1, groups).sum(axis=0)


def _coarse(classes: DataFrame) -> DataFrame:
    """``set, counts`` with the ``GROUPS`` coordinates of the tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lists = batch.column("counts")
                size = np.diff(lists.offsets.to_numpy())
                of = np.repeat(np.arange(batch.num_rows), size)
                at = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
                counts = np.bincount(of * GROUPS + at % GROUPS, lists.flatten().to_numpy(), batch.num_rows * GROUPS)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("set"), pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * GROUPS, pa.int32()),
                                                                   pa.array(np.minimum(counts, MOST_COUNT).astype(np.int16)))], names=["set", "counts"])

    return classes.select("set", "counts").mapInArrow(run, "set long, counts array<smallint>")


def _bounded(pairs: DataFrame, classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs ``a, b`` whose sizes allow a link and whose finer group counts allow a similarity of ``percent``."""
    side = lambda x: classes.select(F.col("set").alias(x), F.col("n").alias(f"n{x}"), F.col("counts").alias(f"c{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "ca", "cb") \
        .filter(PERCENT * F.greatest("na", "nb") <= 100 * F.least("na", "nb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, na, nb = (batch.column(c).to_numpy() for c in ("a", "b", "na", "nb"))
            good = np.zeros(batch.num_rows, bool)
            ends = [batch.column(c).offsets.to_numpy() - batch.column(c).offsets[0].as_py() for c in ("ca", "cb")]
            flat = [batch.column(c).flatten().to_numpy() for c in ("ca", "cb")]
            for k in range(batch.num_rows):
                x, y = (v[e[k]: e[k + 1]] for v, e in zip(flat, ends))
                groups = min(len(x), len(y))
                overlap = int(np.minimum(fold(x, groups), fold(y, groups)).sum())
                good[k] = (100 + percent) * overlap >= percent * (na[k] + nb[k])
            yield pa.RecordBatch.from_arrays([pa.array(a[good]), pa.array(b[good])], names=["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def pick(docs: DataFrame, wanted: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """``docs`` with the bitmap ``cell`` of their ``id``, and a bitmap of fixed size over the ids of ``wanted``.

    Tasks drop the texts outside the bitmap; what it lets through by chance must be dropped by a join.
    """
    cell = F.pmod(F.xxhash64("id"), F.lit(1 << BITMAP_BITS))
    bit = F.expr("shiftleft(1L, CAST(pmod(xxhash64(id), 64) AS INT))")
    words = wanted.select((cell / 64).cast("long").alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    bitmap = np.zeros((1 << BITMAP_BITS) // 64, np.uint64)
    for r in words.collect():
        bitmap[r["word"]] = np.uint64(r["bits"] & (1 << 64) - 1)
    return docs.withColumn("cell", cell), bitmap


def picked(batches: Iterator[pa.RecordBatch], bitmap: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.column("cell").to_numpy()
        yield batch.filter(pa.array((bitmap[at // 64] >> (at % 64).astype(np.uint64)) & np.uint64(1) == 1))


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose sets (``set, shingles``) are similar enough."""
    side = lambda x: sets.select(F.col("set").alias(x), F.col("shingles").alias(f"s{x}"))
    both = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(side("a"), "a").join(side("b"), "b") \
        .filter(100 * both >= PERCENT * (F.size("sa") + F.size("sb") - both)).select("a", "b")


def _made(docs: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """``wanted`` (``set``, the ``id`` of a text that holds it, and more) with the set's ``shingles``, made anew from the texts."""
    found, bitmap = pick(docs.select("id", column), wanted)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(picked(batches, shared.value), column):
            hashes, cuts = _sets(piece.column(column))
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), pa.array(_set_ids(hashes, cuts)),
                 pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(hashes.view(np.int64)))], names=["id", "set", "shingles"])

    made = found.mapInArrow(run, "id long, set long, shingles array<long>")
    return made.join(F.broadcast(wanted) if wanted.count() <= SMALL_ROWS else wanted, ["id", "set"])


def spanning(sets: np.ndarray, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links between sets of the two sides (places; the same side twice for all pairs) that join what was apart."""
    size = np.array([len(x) for x in sets])
    _, flat = np.unique(np.concatenate(list(sets)), return_inverse=True)
    starts = np.cumsum(size) - size
    flags = np.zeros(int(flat.max()) + 1, np.int32)
    root = np.arange(len(sets))
    apart = len(sets) - 1
    other = np.zeros(len(sets), bool)
    other[right] = True
    for x in left.tolist():
        if not apart:
            return
        own = flat[starts[x]: starts[x] + size[x]]
        flags[own] = 1
        both = np.add.reduceat(flags[flat], starts)
        flags[own] = 0
        for y in np.flatnonzero(other & (100 * both >= PERCENT * (size[x] + size - both)) & (root != root[x])).tolist():
            if root[y] != root[x]:
                root[root == root[y]] = root[x]
                apart -= 1
                yield x, y


def _clustered(pairs: DataFrame, classes: DataFrame, docs: DataFrame, column: str, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The clusters that ``pairs`` form (``node, root``), and links that connect within each what exact similarity connects."""
    clusters = settle(components(pairs))
    rows = clusters.select(F.col("node").alias("set"), F.col("root").alias("cluster")).join(classes.select("set", "n"), "set").join(members, "set")
    rows = settle(rows)
    parts = rows.groupBy("cluster").agg(F.greatest(F.ceil(F.sum("n") / CLUSTER_SHINGLES), F.ceil(F.count("*") / RUN_ROWS)).cast("int").alias("parts"))
    wanted = settle(rows.join(parts, "cluster").select("set", "id", "cluster", "parts"))
    part = F.pmod(F.xxhash64("set"), F.col("parts")).cast("int")
    made = _made(docs, column, wanted).withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    names = ["cluster", "p", "q", "set", "part", "shingles"]
    made = made.withColumn("p", F.least("part", "other")).withColumn("q", F.greatest("part", "other")).select(names) \
        .repartition("cluster", "p", "q").sortWithinPartitions("cluster", "p", "q", "set")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows_, open_ in whole_runs(batches, names, 3, "shingles"):
            if rows_ is None:
                continue
            if open_:
                raise RuntimeError("a block holds more sets than its cluster was split for")
            opens = np.zeros(len(rows_["set"]), bool)
            opens[:1] = True
            for c in ("cluster", "p", "q"):
                opens[1:] |= rows_[c][1:] != rows_[c][:-1]
            cuts, out = np.append(np.flatnonzero(opens), len(opens)), []
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                ids = rows_["set"][a:b]
                # A set that several texts of its id hold comes more than once.
                first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])) + a
                one = rows_["part"][first] == rows_["p"][a]
                left = np.flatnonzero(one)
                right = left if rows_["p"][a] == rows_["q"][a] else np.flatnonzero(~one)
                if len(left) and len(right) and len(first) > 1:
                    ids = rows_["set"][first]
                    out += [(int(ids[x]), int(ids[y])) for x, y in spanning(rows_["shingles"][first], left, right)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return clusters, made.mapInArrow(compare, "a long, b long")


def _verified(pairs: DataFrame, docs: DataFrame, column: str, members: DataFrame) -> DataFrame:
    """The pairs that are linked, by the exact overlap of their sets.

    The sets of all ``b`` go to the set of their ``a``, which a task holds alone while it reads them one by one.
    """
    pairs = settle(pairs.select("a", "b"))
    roles = pairs.select("a", F.col("b").alias("set"), F.lit(1).alias("role")).unionAll(
        pairs.select("a", F.col("a").alias("set"), F.lit(0).alias("role")).distinct())
    met = _made(docs, column, settle(roles.join(members, "set"))).select("a", "role", "set", "shingles") \
        .repartition("a").sortWithinPartitions("a", "role", "set")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holds, own, last = None, np.zeros(0, np.int64), None
        for batch in batches:
            a, role, other = (batch.column(c).to_numpy() for c in ("a", "role", "set"))
            sets, good = _numpy(batch.column("shingles"), True), []
            for k in range(batch.num_rows):
                if role[k] == 0:
                    holds, own = a[k], sets[k].copy()
                elif holds == a[k] and (a[k], other[k]) != last:
                    both = len(np.intersect1d(own, sets[k], assume_unique=True))
                    if 100 * both >= PERCENT * (len(own) + len(sets[k]) - both):
                        good.append(k)
                    last = (a[k], other[k])
            if good:
                yield pa.RecordBatch.from_arrays([pa.array(a[good]), pa.array(other[good])], names=["a", "b"])

    return met.mapInArrow(compare, "a long, b long")


def join(df: DataFrame, doc_id: str = "doc_id", column: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row; the component is named by its smallest id.

    A row without an id gets the smallest id of its component, null if there is none.
    """
    own = F.coalesce(F.col(doc_id).cast("long"), -F.lit(NO_ID) - F.pmod(F.xxhash64(column), F.lit(NO_ID)))
    docs = df.select(own.alias("id"), F.col(column).alias("text"))
    signatures = settle(_signatures(docs, "text", frequent_shingles(docs, "text")))
    members = signatures.filter("n > 0").groupBy("set").agg(F.min("id").alias("id"))
    classes = settle(signatures.filter(F.size("counts") > 0).dropDuplicates(["set"]).select("set", "n", "counts"))
    meetings = settle(_meetings(signatures))
    # Of the classes that stand for its size and of its neighbours, those that a class meets most often.
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("near")) for k, c in enumerate(("near", "nearer", "before"))])
    stars = meetings.select("set", F.inline(kinds)).filter("set <> near") \
        .groupBy("set", "kind", "near").agg(F.count("*").alias("times")) \
        .groupBy("set", "kind").agg(F.max_by("near", F.struct("times", "near")).alias("near")) \
        .select(F.least("set", "near").alias("a"), F.greatest("set", "near").alias("b")).distinct()
    clusters, inner = _clustered(_bounded(stars, classes, CLUSTER_PERCENT), classes, docs, "text", members)
    links = settle(inner, SET_ROWS)
    coarse = _coarse(classes).join(clusters.withColumnRenamed("node", "set"), "set", "left").withColumn("root", F.coalesce("root", "set"))
    rest = _bounded(open_pairs(meetings, coarse), classes)
    more = settle(_verified(rest, docs, "text", members), SET_ROWS)
    roots = settle(components(links.unionAll(more)))
    rows = signatures.select("id", "n", "set").join(roots.withColumnRenamed("node", "set"), "set", "left") \
        .withColumn("root", F.coalesce("root", "set"))
    names = rows.filter((F.col("n") > 0) & (F.col("id") > -NO_ID)).groupBy("root").agg(F.min("id").alias("least"))
    named = F.when(F.col("id") > -NO_ID, F.col("id"))
    return rows.join(names, "root", "left").select(
        named.alias(doc_id), F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(named).alias("component_id"))
