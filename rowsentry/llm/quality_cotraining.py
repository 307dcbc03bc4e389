"""Quality by co-training: a classifier of a page's text and one of its metadata teach each other.

The text view sees what is written (character classes, word forms, repetition), the metadata view what is known without reading
(length, line layout, language tag, source). Both are naive Bayes classifiers over binned features, fitted on all labelled rows
but a fifth kept for calibration. In each round every unlabelled document that one view is confident of (by its calibrated chance)
is counted, with its pseudo-label, for the other view. At the end a logistic regression on the kept rows combines both views.

Counts are summed by Spark over all documents, so neither training nor scoring depends on a sample; models and histograms have a
fixed size. Null and empty texts are pages of length 0, null languages and sources are values of their own. Equal documents
have equal scores. Several labels of one id count as their largest. Without labels of both kinds every score is
the labels' mean, 0.5 without any. Columns that have the name of an output are replaced, others pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsentry.llm.common import pieces, settle, span_hashes, utf8, word_spans

ROUNDS = 2
CONFIDENT = 0.97
CELLS = 32
GRID = 48
GRID_STEP = 0.5
CALIBRATION_SHARE = 5

_EDGES = np.array([0.0005, 0.002, 0.005, 0.01, 0.02, 0.03, 0.05, 0.07, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5, 0.55,
                   0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95, 0.98, 0.995])
_KINDS = ("upper", "lower", "digit", "blank", "pipe", "shout", "stop", "quote", "symbol", "high")
_KIND = np.full(256, _KINDS.index("symbol"), np.uint8)
for _chars, _name in ((range(65, 91), "upper"), (range(97, 123), "lower"), (range(48, 58), "digit"), ((9, 10, 11, 12, 13, 32), "blank"),
                      (b"|", "pipe"), (b"!", "shout"), (b".,;:?", "stop"), (b"'\"()-", "quote"), (range(128, 256), "high")):
    _KIND[list(_chars)] = _KINDS.index(_name)
TEXT_FEATURES = 13
META_FEATURES = 8


def _shares(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.searchsorted(_EDGES, part / np.maximum(whole, 1), side="right")


def _logs(x: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(1 + np.maximum(x, 0)) * 2, CELLS - 1).astype(np.int64)


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[offsets])


def text_view(column: pa.Array) -> np.ndarray:
    """The cell of each feature of what is written: texts x features."""
    data, offsets = utf8(column)
    kind = _KIND[data]
    count = {name: _per_text(kind == k, offsets) for k, name in enumerate(_KINDS)}
    size = np.diff(offsets)
    starts, ends, bounds = word_spans(data, offsets)
    words = span_hashes(data, starts, ends)
    of = np.repeat(np.arange(len(column)), np.diff(bounds))
    n = np.diff(bounds)
    order = np.lexsort((words, of))
    new = np.ones(len(words), bool)
    new[1:] = (words[order][1:] != words[order][:-1]) | (of[order][1:] != of[order][:-1])
    distinct = np.bincount(of[order][new], minlength=len(column))
    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (of[1:] == of[:-1])
    odd_end = np.isin(kind[ends - 1], [_KINDS.index(x) for x in ("symbol", "shout", "pipe")]) if len(ends) else np.zeros(0, bool)
    capital = (kind[starts] == 0) & (kind[np.minimum(starts + 1, np.maximum(ends - 1, 0))] == 0) if len(starts) else np.zeros(0, bool)
    letters = count["upper"] + count["lower"]
    return np.stack([
        _shares(count["upper"], letters), _shares(count["symbol"], size), _shares(count["pipe"], size), _shares(count["shout"], size),
        _shares(count["digit"], size), _shares(count["stop"], size), _shares(count["quote"], size), _shares(count["high"], size),
        _shares(distinct, n), _shares(np.bincount(of, again, len(column)), n), _shares(np.bincount(of, odd_end, len(column)), n),
        _shares(np.bincount(of, capital, len(column)), n), _logs(8 * size / np.maximum(n, 1))], axis=1).astype(np.int64)


def _category(column: pa.Array) -> np.ndarray:
    """A cell from 1 on by a hash of the value, 0 for null."""
    data, offsets = utf8(column)
    hashes = span_hashes(data, offsets[:-1], offsets[1:])
    cell = 1 + (hashes >> np.uint64(40)).astype(np.int64) % (CELLS - 1)
    return np.where(pc.is_null(column).to_numpy(zero_copy_only=False), 0, cell)


def metadata_view(column: pa.Array, lang: pa.Array, source: pa.Array) -> np.ndarray:
    """The cell of each feature that does not need the words: texts x features."""
    data, offsets = utf8(column)
    size = np.diff(offsets)
    breaks = data == 10
    lines = _per_text(breaks, offsets) + 1
    at = np.flatnonzero(breaks)
    of = np.searchsorted(offsets, at, side="right") - 1
    # Where lines end: the breaks of each text and its end.
    first = np.concatenate([[0], np.cumsum(lines)])
    begin, stop = np.empty(int(first[-1]), np.int64), np.empty(int(first[-1]), np.int64)
    if len(stop):
        number = np.arange(len(at)) - np.searchsorted(of, of) if len(at) else np.zeros(0, np.int64)
        stop[first[of] + number] = at
        stop[first[1:] - 1] = offsets[1:]
        begin[1:] = stop[:-1] + 1
        begin[first[:-1]] = offsets[:-1]
    length = stop - begin
    longest = np.maximum.reduceat(length, first[:-1]) if len(size) else size
    ended = (length > 0) & (data[np.maximum(stop - 1, 0)] == 46) if len(data) else np.zeros(len(stop), bool)
    closed = np.add.reduceat(ended.astype(np.int64), first[:-1]) if len(size) else size
    return np.stack([_logs(size), _logs(lines), _logs(size / lines), _shares(longest, size), _shares(closed, lines),
                     _logs(length[first[:-1]] if len(size) else size), _category(lang), _category(source)], axis=1).astype(np.int64)


@dataclass
class CoTrained:
    """log P(cell | good) - log P(cell | bad) of both views, and the weights of the combination."""

    text: np.ndarray
    meta: np.ndarray
    prior: float
    #: (slope, offset) of each view's own calibrated chance.
    alone: tuple[tuple[float, float], tuple[float, float]]
    #: weights of text, metadata, and the offset.
    both: tuple[float, float, float]
    constant: float | None = None

    def logits(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        one = self.text[np.arange(TEXT_FEATURES), text].sum(axis=1) + self.prior
        other = self.meta[np.arange(META_FEATURES), meta].sum(axis=1) + self.prior
        limit = GRID * GRID_STEP / 2 - 1e-6
        return np.clip(one, -limit, limit), np.clip(other, -limit, limit)

    def chances(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.constant is not None:
            same = np.full(len(text), self.constant)
            return same, same, same
        a, b = self.logits(text, meta)
        sig = lambda z: 1 / (1 + np.exp(-z))
        return (sig(self.alone[0][0] * a + self.alone[0][1]), sig(self.alone[1][0] * b + self.alone[1][1]),
                sig(self.both[0] * a + self.both[1] * b + self.both[2]))


def _logistic(x: np.ndarray, good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Weights (offset last) of a ridge logistic regression on weighted points.

    Newton steps alone run away where the views part good from bad almost surely; a step that raises the loss is halved.
    """
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.diag([0.01] * (x.shape[1] - 1) + [1e-3])

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((good * np.logaddexp(0, -z) + bad * np.logaddexp(0, z)).sum() + w @ ridge @ w / 2)

    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        n = good + bad
        step = np.linalg.solve((x * (n * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge, x.T @ (good - n * p) - ridge @ w)
        step /= max(1.0, np.abs(step).max() / 2)
        while np.abs(step).max() >= 1e-8 and loss(w + step) > loss(w):
            step /= 2
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _features(documents: DataFrame, column: str, lang: str, source: str) -> DataFrame:
    """The rows without their text, with the cells of both views."""
    given = [c for c in (lang, source) if c in documents.columns]
    keep = [c for c in documents.columns if c != column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, column):
            missing = pa.nulls(piece.num_rows, pa.string())
            meta = [piece.column(c).cast(pa.string()) if c in given else missing for c in (lang, source)]
            made = [text_view(piece.column(column)), metadata_view(piece.column(column), *meta)]
            lists = [pa.ListArray.from_arrays(pa.array(np.arange(piece.num_rows + 1) * m.shape[1], pa.int32()),
                                              pa.array(m.ravel().astype(np.int16))) for m in made]
            yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in keep), *lists], names=[*keep, "text_cells", "meta_cells"])

    fields = "".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}, " for f in documents.schema if f.name in keep)
    return documents.mapInArrow(run, f"{fields}text_cells array<smallint>, meta_cells array<smallint>")


def _cells(batch: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy().astype(np.int64).reshape(-1, width)


def _summed(table: DataFrame, count, size: int) -> np.ndarray:
    """The sum over all batches of the array of ``size`` numbers that ``count`` makes of one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += count(batch)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], names=["cell", "n"])

    out = np.zeros(size)
    for r in table.mapInArrow(run, "cell long, n double").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[r["cell"]] = r["n"]
    return out


def _bayes(counts: np.ndarray) -> np.ndarray:
    p = counts + 1.0
    p = p / p.sum(axis=2, keepdims=True)
    return np.log(p[1]) - np.log(p[0])


def fit(table: DataFrame, rounds: int = ROUNDS, confident: float = CONFIDENT) -> CoTrained:
    """Co-train on ``text_cells``, ``meta_cells``, ``label`` (0, 1 or null) and ``calibrates`` (rows kept for calibration)."""
    spark = table.sparkSession
    sizes = {r["label"]: r["n"] for r in table.filter("label IS NOT NULL").groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not (sizes.get(0) and sizes.get(1)):
        return CoTrained(np.zeros(0), np.zeros(0), 0.0, ((0.0, 0.0), (0.0, 0.0)), (0.0, 0.0, 0.0), 1.0 * (1 in sizes) if sizes else 0.5)
    text_size, meta_size = 2 * TEXT_FEATURES * CELLS, 2 * META_FEATURES * CELLS

    def count(batch: pa.RecordBatch, model: CoTrained | None) -> np.ndarray:
        text, meta = _cells(batch, "text_cells", TEXT_FEATURES), _cells(batch, "meta_cells", META_FEATURES)
        label = pc.fill_null(batch.column("label"), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        learns = (label >= 0) & ~batch.column("calibrates").to_numpy(zero_copy_only=False)
        for_text = for_meta = np.where(learns, label, -1)
        if model is not None:
            one, other, _ = model.chances(text, meta)
            sure = lambda p: np.where(p >= confident, 1, np.where(p <= 1 - confident, 0, -1))
            for_text, for_meta = np.where(label < 0, sure(other), for_text), np.where(label < 0, sure(one), for_meta)
        out = []
        for cells, given, features in ((text, for_text, TEXT_FEATURES), (meta, for_meta, META_FEATURES)):
            rows = np.flatnonzero(given >= 0)
            at = (given[rows, None] * features + np.arange(features)) * CELLS + cells[rows]
            out.append(np.bincount(at.ravel(), minlength=2 * features * CELLS))
        return np.concatenate(out)

    def grid(batch: pa.RecordBatch, model: CoTrained) -> np.ndarray:
        a, b = model.logits(_cells(batch, "text_cells", TEXT_FEATURES), _cells(batch, "meta_cells", META_FEATURES))
        place = [np.floor(x / GRID_STEP).astype(np.int64) + GRID // 2 for x in (a, b)]
        label = batch.column("label").to_numpy().astype(np.int64)
        return np.bincount((label * GRID + place[0]) * GRID + place[1], minlength=2 * GRID * GRID)

    kept = table.filter("label IS NOT NULL AND calibrates")
    middle = (np.arange(GRID) - GRID // 2 + 0.5) * GRID_STEP
    prior = float(np.log(sizes[1] / sizes[0]))
    model = None
    for _ in range(rounds + 1):
        shared = spark.sparkContext.broadcast(model)
        counts = _summed(table, lambda b, m=shared: count(b, m.value), text_size + meta_size)
        model = CoTrained(_bayes(counts[:text_size].reshape(2, TEXT_FEATURES, CELLS)),
                          _bayes(counts[text_size:].reshape(2, META_FEATURES, CELLS)), prior, ((1.0, 0.0), (1.0, 0.0)), (1.0, 0.0, 0.0))
        now = spark.sparkContext.broadcast(model)
        seen = _summed(kept, lambda b, m=now: grid(b, m.value), 2 * GRID * GRID).reshape(2, GRID, GRID)
        alone = [tuple(_logistic(middle[:, None], seen[1].sum(axis=k), seen[0].sum(axis=k))) for k in (1, 0)]
        points = np.stack(np.meshgrid(middle, middle, indexing="ij"), axis=2).reshape(-1, 2)
        some = seen.sum(axis=0).ravel() > 0
        both = _logistic(points[some], seen[1].ravel()[some], seen[0].ravel()[some])
        model.alone, model.both = tuple(alone), tuple(both)
    return model


def classify(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", column: str = "text", label: str = "quality",
             lang: str = "lang", source: str = "source", rounds: int = ROUNDS) -> DataFrame:
    """``quality_score`` (chance that a document is good) and ``keep`` (from 0.5 on), with both views' own chances.

    Returns the columns of ``documents`` but its text. ``labels`` holds ``doc_id`` and ``label`` (0 or 1).
    """
    documents = documents.drop("text_chance", "meta_chance", "quality_score", "keep", "label", "calibrates", "text_cells", "meta_cells")
    known = labels.select(F.col(doc_id).alias("label_id"), F.col(label).cast("int").alias("label")).filter("label IN (0, 1)") \
        .groupBy("label_id").agg(F.max("label").alias("label"))
    cells = _features(documents, column, lang, source)
    table = settle(cells.join(known, cells[doc_id] == known["label_id"], "left").drop("label_id").withColumn(
        "calibrates", F.coalesce(F.pmod(F.xxhash64(F.col(doc_id)), F.lit(CALIBRATION_SHARE)) == 0, F.lit(False))))
    model = table.sparkSession.sparkContext.broadcast(fit(table, rounds))
    kept = [c for c in table.columns if c not in ("text_cells", "meta_cells", "label", "calibrates")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, other, both = model.value.chances(_cells(batch, "text_cells", TEXT_FEATURES), _cells(batch, "meta_cells", META_FEATURES))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(one), pa.array(other), pa.array(both), pa.array(both >= 0.5)],
                names=[*kept, "text_chance", "meta_chance", "quality_score", "keep"])

    fields = "".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}, " for f in table.schema if f.name in kept)
    return table.mapInArrow(run, f"{fields}text_chance double, meta_chance double, quality_score double, keep boolean")
