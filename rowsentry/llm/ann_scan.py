"""Approximate nearest neighbours by inner product: an adaptive dimension scan within probed lists.

The largest inner product becomes the smallest distance by one more coordinate, sqrt(M^2 - |x|^2) with M the largest norm (0 for
queries). All vectors are rotated by one random orthogonal matrix, so that any first d coordinates are a fair sample of the whole.
Vectors lie in lists (k-means on a bounded sample; every vector is in a list); small lists share a group, large ones are
split into several, so that a task meets bounded numbers of vectors and queries. Within a probed list the coordinates are
read in column blocks; a candidate is abandoned once its partial distance, scaled to all coordinates, exceeds the k-th best
so far by the margin of a hypothesis test. Survivors get their exact inner product in double precision on the original vectors.

Vectors that are null, zero, of another length than most, or that hold null or non-finite components take no part, nor do null
ids. Rows that repeat an id count once in a query's answer. Ties go to the smaller id. Empty tables have empty answers. Other
columns take no part.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowsentry.llm.common import settle

#: Vectors (and bytes) that the lists are fitted on at most.
FIT_VECTORS = 20_000
FIT_BYTES = 64 << 20
MAX_LISTS = 4_096
#: Vectors and queries that one task compares at a time (about).
BLOCK_VECTORS = 4_096
BLOCK_QUERIES = 1_024
COLUMN_BLOCK = 16
#: Width of the hypothesis test; larger abandons later.
EPSILON = 2.1
SEED = 20_240_731


def usable(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``id, v`` of the rows that take part, before their length is checked."""
    v = F.col(embedding).cast("array<double>")
    good = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return df.select(F.col(vec_id).cast("long").alias("id"), v.alias("v")) \
        .filter(F.col("id").isNotNull() & F.col("v").isNotNull() & good & F.exists("v", lambda x: x != 0.0))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(-1, dim)


def fit_lists(points: np.ndarray, lists: int, rounds: int = 10) -> np.ndarray:
    """k-means centres; empty ones are put on the points farthest from theirs."""
    rng = np.random.default_rng(SEED)
    centres = points[rng.choice(len(points), lists, replace=False)].copy()
    for _ in range(rounds):
        near = nearest_list(points, centres)
        counts = np.bincount(near, minlength=lists)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
        empty = np.flatnonzero(counts == 0)
        if len(empty):
            far = np.argsort(-((points - centres[near]) ** 2).sum(axis=1), kind="stable")[: len(empty)]
            centres[empty] = points[far]
    return centres


def list_distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (centres ** 2).sum(axis=1) - 2 * points @ centres.T


def nearest_list(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([list_distances(points[a: a + 4096], centres).argmin(axis=1) for a in range(0, len(points), 4096)]
                          or [np.zeros(0, np.int64)])


def scan_list(ids: np.ndarray, x: np.ndarray, rotated: np.ndarray, query_ids: np.ndarray, q: np.ndarray, rotated_q: np.ndarray,
              bar: np.ndarray, k: int, epsilon: float = EPSILON) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows of a list that may be among the k nearest of a query: query, row, exact inner product, best first.

    ``bar`` is the distance that a row must not exceed; where it is infinite, the k-th of the first rows sets it.
    """
    n, dim = rotated.shape
    found = []
    step = max(1, (1 << 21) // max(n, 1))
    for a in range(0, len(query_ids), step):
        own, limit_at = rotated_q[a: a + step], bar[a: a + step].copy()
        first = min(n, 2 * k + 1)
        fresh = np.flatnonzero(np.isinf(limit_at))
        if first > k and len(fresh):
            start = ((rotated[None, :first] - own[fresh, None]) ** 2).sum(axis=2)
            start[query_ids[a + fresh, None] == ids[None, :first]] = np.inf
            limit_at[fresh] = np.partition(start, k - 1, axis=1)[:, k - 1]
        part = None
        for d in range(0, dim, COLUMN_BLOCK):
            e = min(d + COLUMN_BLOCK, dim)
            # The hypothesis: scaled to all columns, the partial distance is within the bar.
            limit = limit_at * (e / dim) * (1 + epsilon / math.sqrt(e)) ** 2 if e < dim else limit_at
            limit = limit * (1 + 1e-12) + 1e-9
            if part is None:
                near = (own[:, :e] ** 2).sum(axis=1)[:, None] + (rotated[:, :e] ** 2).sum(axis=1)[None] \
                    - 2 * own[:, :e] @ rotated[:, :e].T
                qi, xi = np.nonzero(near <= limit[:, None])
                part = near[qi, xi]
            else:
                part = part + ((rotated[xi, d:e] - own[qi, d:e]) ** 2).sum(axis=1)
                stay = part <= limit[qi]
                qi, xi, part = qi[stay], xi[stay], part[stay]
        other = query_ids[a + qi] != ids[xi]
        qi, xi = a + qi[other], xi[other]
        score = np.concatenate([(x[xi[i: i + 65536]] * q[qi[i: i + 65536]]).sum(axis=1) for i in range(0, len(qi), 65536)]
                               or [np.zeros(0)])
        order = np.lexsort((ids[xi], -score, qi))
        qi, xi, score = qi[order], xi[order], score[order]
        top = np.arange(len(qi)) - np.searchsorted(qi, qi) < k
        found.append((qi[top], xi[top], score[top]))
    return tuple(np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))


def pack(sizes: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """The first group of each list and how many groups it has: small lists share one, larger ones are split."""
    base, parts = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64)
    group, filled = 0, 0
    for k, n in enumerate(sizes.tolist()):
        if n > block:
            group += filled > 0
            base[k], parts[k] = group, -(-n // block)
            group, filled = group + parts[k], 0
            continue
        if filled + n > block:
            group, filled = group + 1, 0
        base[k], filled = group, filled + n
    return base, parts


def search(df: DataFrame, is_query, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 20, lists: int | None = None,
           probe_share: float = 0.7, min_probes: int = 16, epsilon: float = EPSILON) -> DataFrame:
    """The ``k`` nearest rows found for every row for which ``is_query`` (a condition on the column ``id``) holds.

    ``lists`` defaults to twice the square root of the number of vectors; a query probes ``probe_share`` of them, at least
    ``min_probes``, and more while they hold fewer than 50 k vectors. Returns ``query_id, rank, vec_id, score``.
    """
    spark = df.sparkSession
    rows = usable(df, vec_id, embedding)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    lengths = rows.groupBy(F.size("v").alias("dim")).agg(
        F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("norm")) \
        .orderBy(F.desc("n"), "dim").first()
    if lengths is None:
        return empty
    dim, total, longest = lengths["dim"], lengths["n"], float(lengths["norm"])
    rows = rows.filter(F.size("v") == dim)
    lists = min(lists or 2 * math.isqrt(total) + 1, MAX_LISTS, total)
    bound = min(FIT_VECTORS, max(lists, FIT_BYTES // (8 * dim)))
    share = int(min(1.0, bound / total) * (1 << 20)) or 1
    sample = np.array([r["v"] for r in rows.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share).select("v").collect()],
                      np.float64).reshape(-1, dim)
    if not len(sample):
        sample = np.array([rows.first()["v"]], np.float64)
    lists = min(lists, len(sample))
    rotation = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim + 1, dim + 1)))[0]

    def turned(x: np.ndarray, of_query: bool = False) -> np.ndarray:
        last = np.zeros(len(x)) if of_query else np.sqrt(np.maximum(longest - (x * x).sum(axis=1), 0))
        return np.hstack([x, last[:, None]]) @ rotation

    centres = spark.sparkContext.broadcast(fit_lists(turned(sample), lists))

    def assign(batches):
        for batch in batches:
            if batch.num_rows:
                near = nearest_list(turned(_matrix(batch.column("v"), dim)), centres.value)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.astype(np.int32))], names=["id", "v", "list"])

    placed = settle(rows.mapInArrow(assign, "id long, v array<double>, list int"))
    sizes = np.zeros(lists, np.int64)
    for r in placed.groupBy("list").agg(F.count("*").alias("n")).collect():
        sizes[r["list"]] = r["n"]
    probes = min(lists, max(min_probes, math.ceil(lists * probe_share)))
    base, parts = pack(sizes, BLOCK_VECTORS)
    held = spark.sparkContext.broadcast((sizes, base, parts))

    def probe(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            far = list_distances(turned(_matrix(batch.column("v"), dim), True), centres.value)
            order = np.argsort(far, axis=1, kind="stable")
            size, start, split = held.value
            within = np.cumsum(size[order], axis=1)
            count = np.maximum(probes, np.minimum((within < 50 * k).sum(axis=1) + 1, lists))
            take, groups, probed = [], [], []
            for i, n in enumerate(count.tolist()):
                mine: dict[int, list[int]] = {}
                for chosen in order[i, :n].tolist():
                    if size[chosen]:
                        for g in range(start[chosen], start[chosen] + split[chosen]):
                            mine.setdefault(g, []).append(chosen)
                take += [i] * len(mine)
                groups += mine
                probed += mine.values()
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(take, pa.int64())), batch.column("v").take(pa.array(take, pa.int64())),
                 pa.array(groups, pa.int64()), pa.array(probed, pa.list_(pa.int32()))], names=["id", "v", "grp", "lists"])

    queries = placed.filter(is_query).select("id", "v").dropDuplicates(["id", "v"]) \
        .mapInArrow(probe, "id long, v array<double>, grp long, lists array<int>")
    queries = settle(queries)
    asked = queries.groupBy("grp").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("parts"))
    # Every group of lists meets every part of the queries that probe it.
    fixed = lambda numbers: F.get(F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<long>"), F.col("list"))
    left = placed.withColumn("grp", fixed(base) + F.pmod(F.xxhash64("id"), fixed(parts))).join(asked, "grp") \
        .select("id", "v", "list", "grp", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    right = queries.join(asked, "grp").select("id", "v", "lists", "grp", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"))

    def compare(key, rows_: pa.Table, queries_: pa.Table) -> pa.Table:
        found = []
        if rows_.num_rows and queries_.num_rows:
            ids, of = rows_.column("id").to_numpy(), rows_.column("list").to_numpy()
            x = _matrix(rows_.column("v").combine_chunks(), dim)
            # A repeated id counts once: its first vector in their order.
            order = np.lexsort((*x.T[::-1], ids)) if len(np.unique(ids)) < len(ids) else np.argsort(ids, kind="stable")
            ids, x, of = ids[order], x[order], of[order]
            fresh = np.ones(len(ids), bool)
            fresh[1:] = ids[1:] != ids[:-1]
            ids, x, of = ids[fresh], x[fresh], of[fresh]
            asks, q = queries_.column("id").to_numpy(), _matrix(queries_.column("v").combine_chunks(), dim)
            rx, rq = turned(x), turned(q, True)
            length = (q * q).sum(axis=1) + longest
            probed = queries_.column("lists").combine_chunks()
            whose = np.repeat(np.arange(len(asks)), np.diff(probed.offsets.to_numpy()))
            which = probed.flatten().to_numpy()
            best = np.full((len(asks), k), -np.inf)
            for one in np.unique(of):
                mine, at = np.flatnonzero(of == one), np.sort(whose[which == one])
                if not len(at):
                    continue
                bar = length[at] - 2 * best[at].min(axis=1)
                qi, xi, score = scan_list(ids[mine], x[mine], rx[mine], asks[at], q[at], rq[at], bar, k, epsilon)
                found.append((at[qi], mine[xi], score))
                new = np.full((len(at), k), -np.inf)
                new[qi, np.arange(len(qi)) - np.searchsorted(qi, qi)] = score
                best[at] = -np.partition(-np.hstack([best[at], new]), k - 1, axis=1)[:, :k]
        if not found:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        qi, xi, score = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((ids[xi], -score, qi))
        qi, xi, score = qi[order], xi[order], score[order]
        top = np.arange(len(qi)) - np.searchsorted(qi, qi) < k
        return pa.table({"query_id": asks[qi[top]], "vec_id": ids[xi[top]], "score": score[top]})

    found = left.groupBy("grp", "part").cogroup(right.groupBy("grp", "part")) \
        .applyInArrow(compare, "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
