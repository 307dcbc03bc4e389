"""Toxicity from the nearest labelled examples by exact TF-IDF cosine, found through a block-max inverted index.

Terms are words (runs of ASCII letters, digits and other bytes from 0x80 on; A-Z lower-cased) and the first 4 to 6 bytes of longer
words. The vocabulary holds the ``VOCABULARY`` terms whose frequency differs most between the labels (by G-squared on the examples),
inverse document frequencies come from all documents. The examples are at most about ``EXAMPLES`` of each label; of those of a label whose word
triples have a Jaccard similarity of ``COPY_SIMILARITY`` or more one stays. They lie in blocks; each
posting list knows its largest weight in every block. A query opens blocks in the order of their bounds and stops when no other
block can hold a nearer example, so the neighbours are exact. Votes weighted by cosine are calibrated by leaving
each example out in turn, at the labels' real shares.

Null and empty texts, and texts without a term of the vocabulary, have no neighbours; their score is the calibrated share of
toxic examples that have none either. Equal texts have equal scores. Without labelled rows of both labels every score
is the share of toxic rows (0 without any). Columns that have the name of an output are replaced, others pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsentry.llm.common import (
    _BASE, _BASE_INVERSE, _LOWER, mix, pieces, powers, ragged, runs, settle, shingle_hashes, span_hashes, utf8, word_spans,
)

#: Examples of each label at most (about; chosen by the hash of their id).
EXAMPLES = 3_000
VOCABULARY = 4_096
MIN_DOCUMENTS = 4
NEIGHBOURS = 25
#: Least hashes of a text's word triples, any of which brings examples of a label together to be compared.
COPY_HASHES = 3
COPY_SIMILARITY = 0.75
BLOCK = 64
PREFIXES = (4, 5, 6)
EVIDENCE = 3
SHARES = 1 << 20

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all term occurrences of some texts, and the text of each."""
    data, offsets = utf8(column)
    starts, ends, bounds = runs(_WORD[data], offsets)
    of = np.repeat(np.arange(len(column)), np.diff(bounds))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LOWER[data] * powers(_BASE, len(data)), out=total[1:], dtype=np.uint64)
    back = powers(_BASE_INVERSE, len(data) + 1)[starts]
    hashes, owners = [mix((total[ends] - total[starts]) * back)], [of]
    for p in PREFIXES:
        long = np.flatnonzero(ends - starts > p)
        hashes.append(mix((total[starts[long] + p] - total[starts[long]]) * back[long] + np.uint64(p)))
        owners.append(of[long])
    return np.concatenate(hashes), np.concatenate(owners)


def sample(labels: DataFrame, doc_id: str, label: str, per_label: int) -> tuple[DataFrame, dict[int, int]]:
    """About ``per_label`` rows of each label by the hash of the id, as ``doc_id, label``, and the labels' sizes."""
    rows = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label")).dropna()
    rows = rows.filter("label IN (0, 1)")
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = {k: int(min(1.0, per_label / max(sizes.get(k, 0), 1)) * SHARES) for k in (0, 1)}
    cut = F.when(F.col("label") == 1, share[1]).otherwise(share[0])
    return rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(SHARES)) < cut), sizes


def distinct_examples(examples: DataFrame) -> DataFrame:
    """``example_id, label, text`` without near copies of a smaller example of the same label.

    The words of a text that is there many times would all seem to tell the labels apart. Examples of a label that share one of
    the least hashes of their word triples are compared with the smallest of them by the exact Jaccard similarity.
    """
    seeds = mix(np.arange(1, COPY_HASHES + 1, dtype=np.uint64))
    names = [f"h{k}" for k in range(COPY_HASHES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            data, offsets = utf8(piece.column("text"))
            starts, ends, bounds = word_spans(data, offsets)
            hashes, cuts = shingle_hashes(span_hashes(data, starts, ends), bounds, 3)
            of = np.repeat(np.arange(piece.num_rows), np.diff(cuts))
            order = np.lexsort((hashes, of))
            hashes, of = hashes[order], of[order]
            new = np.ones(len(hashes), bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
            hashes, cuts = hashes[new], np.searchsorted(of[new], np.arange(piece.num_rows + 1))
            some = np.flatnonzero(np.diff(cuts))
            least = []
            for seed in seeds:
                value = np.zeros(piece.num_rows, np.uint64)
                if len(some):
                    value[some] = np.minimum.reduceat(mix(hashes ^ seed), cuts[:-1][some])
                least.append(pa.array(value.view(np.int64)))
            triples = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in ("example_id", "label", "text")), triples, *least],
                                             names=["example_id", "label", "text", "triples", *names])

    rows = examples.select("example_id", "label", "text").mapInArrow(
        run, "example_id long, label int, text string, triples array<long>, " + ", ".join(f"{n} long" for n in names))
    # Equal sets of triples first, so that no group of exact copies meets in a join.
    rows = settle(rows.groupBy("label", "triples").agg(F.min(F.struct("example_id", "text", *names)).alias("row"))
                  .select("label", "triples", "row.*").withColumn("place", F.xxhash64("label", "triples")))
    sets = rows.select("place", "triples")
    for name in names:
        heads = rows.groupBy("label", name).agg(F.min(F.struct("example_id", "place")).alias("head"), F.count("*").alias("n")) \
            .filter("n > 1").select("label", name, F.col("head.place").alias("head"))
        pairs = rows.join(heads, ["label", name]).filter("place <> head").select("place", "head", "triples")
        both = pairs.join(sets.select(F.col("place").alias("head"), F.col("triples").alias("others")), "head")
        shared = F.size(F.array_intersect("triples", "others"))
        copies = both.filter(shared >= COPY_SIMILARITY * (F.size("triples") + F.size("others") - shared)).select("place")
        rows = settle(rows.join(copies, "place", "left_anti"))
    return rows.select("example_id", "label", "text")


def choose_terms(examples: DataFrame, size: int = VOCABULARY) -> np.ndarray:
    """The hashes, sorted, of the terms whose share of texts differs most between the labels (``text, label``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            hashes, owners = terms(piece.column("text"))
            label = piece.column("label").to_numpy(zero_copy_only=False)
            order = np.lexsort((hashes, owners))
            hashes, owners = hashes[order], owners[order]
            first = np.ones(len(hashes), bool)
            first[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
            keys, place = np.unique(hashes[first], return_inverse=True)
            toxic = np.bincount(place, weights=label[owners[first]], minlength=len(keys)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(toxic), pa.array(np.bincount(place, minlength=len(keys)))],
                names=["term", "toxic", "n"])

    sizes = examples.agg(F.sum("label").alias("toxic"), F.count("*").alias("n")).first()
    toxic, total = float(sizes["toxic"] or 0), float(sizes["n"])
    if not 0 < toxic < total:
        return np.zeros(0, np.int64)
    counts = examples.select("text", "label").mapInArrow(run, "term long, toxic long, n long") \
        .groupBy("term").agg(F.sum("toxic").alias("a"), F.sum("n").alias("n")).filter(F.col("n") >= MIN_DOCUMENTS)
    part = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    a, n = F.col("a"), F.col("n")
    g2 = 2 * (part(a, n * toxic / total) + part(n - a, n * (total - toxic) / total)
              + part(toxic - a, (total - n) * toxic / total) + part(total - toxic - n + a, (total - n) * (total - toxic) / total))
    best = counts.select("term", g2.alias("g2")).orderBy(F.desc("g2"), "term").limit(size)
    return np.sort(np.array([r["term"] for r in best.collect()], np.int64))


def vectors(df: DataFrame, vocabulary: np.ndarray, column: str) -> DataFrame:
    """Replace ``column`` by ``terms`` and ``counts``: which terms of the vocabulary each whole text has, and how often."""
    known = np.sort(vocabulary.view(np.uint64))
    flags = np.zeros(1 << 16, bool)
    flags[(known >> np.uint64(48)).astype(np.int64)] = True
    keep = [c for c in df.columns if c != column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, column):
            hashes, owners = terms(piece.column(column))
            some = np.flatnonzero(flags[(hashes >> np.uint64(48)).astype(np.int64)])
            place = np.searchsorted(known, hashes[some])
            hit = known[np.minimum(place, max(len(known) - 1, 0))] == hashes[some] if len(known) else np.zeros(0, bool)
            cells, counts = np.unique(owners[some][hit] * max(len(known), 1) + place[hit], return_counts=True)
            of = cells // max(len(known), 1)
            offsets = pa.array(np.searchsorted(of, np.arange(piece.num_rows + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (cells % max(len(known), 1), counts)]
            yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in keep), *lists], names=[*keep, "terms", "counts"])

    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema if f.name != column)
    return df.mapInArrow(run, f"{fields}, terms array<int>, counts array<int>")


def document_counts(table: DataFrame, size: int) -> np.ndarray:
    """How many rows of ``terms`` hold each term of the vocabulary, counted in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(size, np.int64)
        for batch in batches:
            count += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(count[some])], names=["term", "n"])

    seen = np.zeros(size, np.int64)
    for r in table.select("terms").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        seen[r["term"]] = r["n"]
    return seen


@dataclass
class BlockMaxIndex:
    """Postings of unit vectors: for each term the examples, their weights, and its largest weight in each block.

    Postings lie by term and place. The segment of a term and block has its postings from ``cuts`` on, those of a term its
    segments from ``segments`` on.
    """

    ids: np.ndarray
    labels: np.ndarray
    idf: np.ndarray
    places: np.ndarray
    weights: np.ndarray
    cuts: np.ndarray
    blocks: np.ndarray
    largest: np.ndarray
    segments: np.ndarray

    @classmethod
    def build(cls, ids, labels, rows: list[tuple[np.ndarray, np.ndarray]], idf: np.ndarray) -> BlockMaxIndex:
        # Examples of equal leading terms lie together, so that blocks have tight bounds; ids decide ties.
        units = [cls.unit(t, c, idf) for t, c in rows]
        lead = [(int(t[w.argmax()]), -float(w.max())) if len(t) else (len(idf), 0.0) for (t, _), w in zip(rows, units)]
        order = sorted(range(len(rows)), key=lambda k: (lead[k], int(ids[k])))
        of = np.concatenate([np.zeros(0, np.int64), *(rows[k][0] for k in order)]).astype(np.int64)
        weight = np.concatenate([np.zeros(0), *(units[k] for k in order)])
        place = np.repeat(np.arange(len(order)), [len(rows[k][0]) for k in order])
        by = np.lexsort((place, of))
        of, weight, place = of[by], weight[by], place[by]
        opens = np.ones(len(of), bool)
        opens[1:] = (of[1:] != of[:-1]) | (place[1:] // BLOCK != place[:-1] // BLOCK)
        first = np.flatnonzero(opens)
        return cls(np.array(ids, np.int64)[order], np.array(labels, np.int64)[order], idf, place, weight, np.append(first, len(of)),
                   place[first] // BLOCK, np.maximum.reduceat(weight, first) if len(first) else weight,
                   np.searchsorted(of[first], np.arange(len(idf) + 1)))

    @staticmethod
    def unit(term: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
        w = (1 + np.log(count)) * idf[term] if len(term) else np.zeros(0)
        return w / math.sqrt(float((w * w).sum())) if len(w) else w

    def nearest(self, term: np.ndarray, count: np.ndarray, k: int, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the ``k`` nearest examples that share a term, nearest first, ties by place."""
        q = self.unit(term, count, self.idf)
        if not len(q):
            return np.zeros(0, np.int64), np.zeros(0)
        number = self.segments[term + 1] - self.segments[term]
        segment = ragged(self.segments[term], number)
        weight, block = np.repeat(q, number), self.blocks[segment]
        start, size = self.cuts[segment], self.cuts[segment + 1] - self.cuts[segment]
        bounds = np.bincount(block, weight * self.largest[segment], -(-len(self.ids) // BLOCK))
        order = np.argsort(-bounds, kind="stable")
        places, scores, worst = np.zeros(0, np.int64), np.zeros(0), 0.0
        at, step = 0, 4
        while at < len(order) and bounds[order[at]] > 0 and bounds[order[at]] >= worst - 1e-12:
            inside = np.zeros(len(bounds), bool)
            inside[order[at: at + step]] = True
            at, step = at + step, step * 2
            mine = np.flatnonzero(inside[block])
            posting = ragged(start[mine], size[mine])
            s = np.bincount(self.places[posting], self.weights[posting] * np.repeat(weight[mine], size[mine]), len(self.ids))
            if skip >= 0:
                s[skip] = 0.0
            p = np.flatnonzero(s)
            places, scores = np.concatenate([places, p]), np.concatenate([scores, s[p]])
            rounded = np.round(scores, 12)
            if len(rounded) > k:
                best = np.flatnonzero(rounded >= np.partition(rounded, -k)[-k])
                places, scores, rounded = places[best], scores[best], rounded[best]
            best = np.lexsort((places, -rounded))[:k]
            places, scores = places[best], scores[best]
            worst = scores[-1] if len(scores) == k else 0.0
        return places, scores

    def vote(self, places: np.ndarray, cosines: np.ndarray) -> float:
        """Share of toxic neighbours, weighted by cosine; -1 without neighbours."""
        total = float(cosines.sum())
        return float((cosines * self.labels[places]).sum()) / total if total > 0 else -1.0


@dataclass
class ToxicityModel:
    vocabulary: np.ndarray
    index: BlockMaxIndex
    votes: np.ndarray
    chances: np.ndarray
    alone: float

    def score(self, vote: float) -> float:
        return self.alone if vote < 0 else float(np.interp(vote, self.votes, self.chances))


def _calibrate(index: BlockMaxIndex, rows, weights: dict[int, float], prior: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Chance of the label by vote, not falling with it, from examples left out in turn."""
    edges = np.linspace(0, 1, 11)
    seen, toxic = np.zeros(12), np.zeros(12)
    for place, (t, c) in enumerate(rows):
        vote = index.vote(*index.nearest(t, c, NEIGHBOURS, skip=place))
        cell = 11 if vote < 0 else min(int(vote * 10), 9)
        w = weights[int(index.labels[place])]
        seen[cell] += w
        toxic[cell] += w * index.labels[place]
    alone = (toxic[11] + prior) / (seen[11] + 1)
    middle = (edges[:-1] + edges[1:]) / 2
    start = [((toxic[k] + middle[k]) / (seen[k] + 1), seen[k] + 1, 1) for k in range(10)]
    pooled: list[tuple[float, float, int]] = []
    for value in start:
        pooled.append(value)
        while len(pooled) > 1 and pooled[-2][0] >= pooled[-1][0]:
            (a, wa, na), (b, wb, nb) = pooled.pop(-2), pooled.pop()
            pooled.append(((a * wa + b * wb) / (wa + wb), wa + wb, na + nb))
    return middle, np.repeat([p for p, _, _ in pooled], [n for _, _, n in pooled]), alone


def classify(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", column: str = "text", label: str = "toxic",
             per_label: int = EXAMPLES) -> DataFrame:
    """Score every document by the labelled rows of ``labels`` (``doc_id`` and ``label`` of 0 or 1).

    Adds ``score`` (0 to 1), ``predicted`` and ``evidence``, the nearest examples with their labels and cosines.
    """
    spark = documents.sparkSession
    documents = documents.drop("score", "predicted", "evidence", "terms", "counts")
    chosen, sizes = sample(labels, doc_id, label, per_label)
    picked = [(r["doc_id"], r["label"]) for r in chosen.collect()]
    if len(picked) > 4 * per_label:
        raise ValueError("more examples than the sample allows; are ids repeated in the labels?")
    ids = F.broadcast(spark.createDataFrame(picked, "example_id long, label int"))
    held = documents.select(F.col(doc_id).cast("long").alias("example_id"), F.col(column).alias("text")).join(ids, "example_id")
    examples = settle(distinct_examples(held))
    vocabulary = choose_terms(examples)
    ids = F.broadcast(spark.createDataFrame([tuple(r) for r in examples.select("example_id", "label").distinct().collect()],
                                            "example_id long, label int"))
    table = settle(vectors(documents, vocabulary, column))
    total = table.count()
    seen = document_counts(table, len(vocabulary))
    idf = np.log((1 + total) / (1 + seen)) + 1
    rows = table.select(F.col(doc_id).alias("example_id"), "terms", "counts").join(ids, "example_id") \
        .orderBy("example_id", "label", "terms", "counts").collect()
    sparse = [(np.array(r["terms"], np.int64), np.array(r["counts"], np.int64)) for r in rows]
    index = BlockMaxIndex.build([r["example_id"] for r in rows], [r["label"] for r in rows], sparse, idf)
    by_place = {int(i): [] for i in index.ids}
    for r, v in zip(rows, sparse):
        by_place[r["example_id"]].append(v)
    prior = sizes.get(1, 0) / max(sum(sizes.values()), 1)
    held = [sum(1 for r in rows if r["label"] == k) for k in (0, 1)]
    if all(held):
        weights = {k: sizes[k] / held[k] for k in (0, 1)}
        ordered = [by_place[int(i)].pop(0) for i in index.ids]
        votes, chances, alone = _calibrate(index, ordered, weights, prior)
    else:
        votes, chances, alone = np.array([0.0, 1.0]), np.array([prior, prior]), prior
    model = spark.sparkContext.broadcast(ToxicityModel(vocabulary, index, votes, chances, alone))
    kept = [c for c in table.columns if c not in ("terms", "counts")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            term, count = batch.column("terms"), batch.column("counts")
            offsets = term.offsets.to_numpy()
            flat_t = term.values.to_numpy().astype(np.int64)
            flat_c = count.values.to_numpy().astype(np.int64)
            scores, proof = np.full(batch.num_rows, m.alone), [[]] * batch.num_rows
            for k in np.flatnonzero(np.diff(offsets) > 0):
                a, b = offsets[k], offsets[k + 1]
                places, cosines = m.index.nearest(flat_t[a:b], flat_c[a:b], NEIGHBOURS)
                scores[k] = m.score(m.index.vote(places, cosines))
                proof[k] = [{"doc_id": int(m.index.ids[p]), "label": int(m.index.labels[p]), "cosine": float(c)}
                            for p, c in zip(places[:EVIDENCE], cosines[:EVIDENCE])]
            kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("label", pa.int32()), ("cosine", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32)),
                 pa.array(proof, kind)], names=[*kept, "score", "predicted", "evidence"])

    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in table.schema if f.name in kept)
    return table.mapInArrow(
        run, f"{fields}, score double, predicted int, evidence array<struct<doc_id:bigint,label:int,cosine:double>>")
