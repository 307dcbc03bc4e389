"""Benchmark decontamination by q-gram lemma filtering.

Benchmark items are cut into overlapping windows of ``WINDOW`` characters (shorter items are one window). A text region within e
edits of a window of w characters shares at least w + 1 - q (e + 1) of its q-grams, all on at most e + 1 neighbouring diagonals. So the
shared q-grams are counted in diagonal bands that overlap by e, bands that meet the bound are retained, and each is
verified by banded alignment. A document holds an item if at least one of its windows is found.

Characters are code points, lower-cased one by one; white space runs count as one blank. Items shorter than ``Q`` characters and null
items take no part; null and empty texts hold nothing. Equal items are found under each of their ids, equal texts hold the
same. A column named like the output is replaced, others pass through. The items are broadcast in slices of at most
``SLICE_CHARACTERS``; more than one slice means more than one pass over the texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsentry.llm.common import _BASE, _BASE_INVERSE, mix, pieces, powers, ragged, utf8

Q = 10
WINDOW = 100
STRIDE = 50
EDIT_RATE = 0.08
SLICE_CHARACTERS = 16 << 20
#: Text bytes that one step works on.
STEP_BYTES = 1 << 20
BITS = 20


@lru_cache(maxsize=1)
def _lower() -> np.ndarray:
    table = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x20000):
        if not 0xD800 <= c < 0xE000:
            small = chr(c).lower()
            if len(small) == 1:
                table[c] = ord(small)
            if chr(c).isspace():
                table[c] = 0x20
    return table


def normal(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Normal characters of all texts, the offsets of each, the place of each character in its text, and the texts' lengths."""
    data, byte_offsets = utf8(column)
    points = _lower()[np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)]
    reached = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=reached[1:])
    offsets = reached[byte_offsets]
    blank = points == 0x20
    again = np.zeros(len(points), bool)
    again[1:] = blank[1:] & blank[:-1]
    again[offsets[:-1][offsets[:-1] < len(points)]] = False
    kept = np.flatnonzero(~again)
    short = np.searchsorted(kept, offsets)
    place = kept - np.repeat(offsets[:-1], np.diff(short))
    return points[kept], short, place, np.diff(offsets)


def gram_hashes(points: np.ndarray) -> np.ndarray:
    """Hashes of all runs of ``Q`` characters."""
    n = len(points) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(points) + 1, np.uint64)
    codes = (points.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95)
    np.cumsum(codes * powers(_BASE, len(points)), out=total[1:], dtype=np.uint64)
    return mix((total[Q:] - total[:n]) * powers(_BASE_INVERSE, n))


class Windows:
    """The windows of some items and an index of their q-grams."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        points, offsets, _, _ = normal(pa.array([t for _, t in items], pa.string()))
        self.points, self.item, self.start, self.size = points, [], [], []
        for (item, _), a, b in zip(items, offsets[:-1].tolist(), offsets[1:].tolist()):
            if b - a < Q:
                continue
            for s in sorted({*range(a, max(b - WINDOW, a) + 1, STRIDE), max(b - WINDOW, a)}):
                self.item.append(item)
                self.start.append(s)
                self.size.append(min(WINDOW, b - a))
        self.item, self.start, self.size = (np.array(x, np.int64) for x in (self.item, self.start, self.size))
        # A budget for which the lemma still asks for a shared q-gram.
        self.edits = np.minimum((self.size * rate).astype(np.int64), np.maximum(self.size // Q - 1, 0))
        self.least = self.size + 1 - Q * (self.edits + 1)
        count = self.size - Q + 1
        at = ragged(self.start, count)
        hashes = gram_hashes(points)[at] if len(at) else np.zeros(0, np.uint64)
        order = np.argsort(hashes, kind="stable")
        self.keys, first = np.unique(hashes[order], return_index=True)
        self.cuts = np.append(first, len(hashes))
        self.gram_window = np.repeat(np.arange(len(self.start)), count)[order]
        self.gram_place = (at - np.repeat(self.start, count))[order]
        self.flags = np.zeros(1 << BITS, bool)
        self.flags[(self.keys >> np.uint64(64 - BITS)).astype(np.int64)] = True
        self.step = int(self.edits.max()) + 1 if len(self.edits) else 1

    def candidates(self, points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, window and first diagonal (place in ``points`` minus place in the window) of the bands that meet the bound."""
        none = (np.zeros(0, np.int64),) * 3
        if not len(self.keys):
            return none
        hashes = gram_hashes(points)
        at = np.flatnonzero(self.flags[(hashes >> np.uint64(64 - BITS)).astype(np.int64)])
        key = np.searchsorted(self.keys, hashes[at])
        hit = self.keys[np.minimum(key, len(self.keys) - 1)] == hashes[at]
        at, key = at[hit], key[hit]
        text = np.searchsorted(offsets, at, side="right") - 1
        inside = at + Q <= offsets[text + 1]
        at, key, text = at[inside], key[inside], text[inside]
        # A gram that few texts share is rarely worth a look: only texts with enough hits for some window go on.
        enough = np.bincount(text, minlength=len(offsets))[text] >= max(1, int(self.least.min()))
        at, key, text = at[enough], key[enough], text[enough]
        count = self.cuts[key + 1] - self.cuts[key]
        gram = ragged(self.cuts[key], count)
        window, place = self.gram_window[gram], self.gram_place[gram]
        diagonal = np.repeat(at, count) - place + WINDOW
        text = np.repeat(text, count)
        band = diagonal // self.step
        low = diagonal - band * self.step < self.edits[window]
        window, place, text = (np.concatenate([x, x[low]]) for x in (window, place, text))
        band = np.concatenate([band, band[low] - 1]) + 1
        bands = int(len(points) + 2 * WINDOW) // self.step + 3
        cell = (text * len(self.start) + window) * bands + band
        pairs = np.unique(cell * WINDOW + place) // WINDOW
        cells, seen = np.unique(pairs, return_counts=True)
        rest, band = np.divmod(cells, bands)
        text, window = np.divmod(rest, len(self.start))
        good = seen >= self.least[window]
        return text[good], window[good], (band[good] - 1) * self.step - WINDOW


def align(patterns: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least edits of each pattern against any run of its text within the band, and the diagonal where the best one ends.

    Row i of the table is a prefix of i characters, column d the text up to i + d: a band of as many diagonals as the
    texts are longer than the patterns.
    """
    many, length = patterns.shape
    width = texts.shape[1] - length + 1
    column = np.arange(width, dtype=np.int32)
    row = np.zeros((many, width), np.int32)
    for i in range(length):
        differ = texts[:, i: i + width] != patterns[:, i: i + 1]
        new = row + differ
        new[:, :-1] = np.minimum(new[:, :-1], row[:, 1:] + 1)
        row = np.minimum.accumulate(new - column, axis=1) + column
    end = row.argmin(axis=1)
    return row[np.arange(many), end], end


def _verify(windows: Windows, points: np.ndarray, offsets: np.ndarray, text, window, diagonal):
    """text, window, start, end (places in ``points``) and edits of the candidates within their budget."""
    out = []
    for size, edits in sorted(set(zip(windows.size[window].tolist(), windows.edits[window].tolist()))):
        mine = np.flatnonzero((windows.size[window] == size) & (windows.edits[window] == edits))
        margin = edits + 1
        width = windows.step + 3 * edits + 2
        for a in range(0, len(mine), 2048):
            part = mine[a: a + 2048]
            first = diagonal[part] - margin
            cells = first[:, None] + np.arange(size + width - 1)
            valid = (cells >= offsets[text[part]][:, None]) & (cells < offsets[text[part] + 1][:, None])
            region = np.where(valid, points[np.clip(cells, 0, len(points) - 1)], np.uint32(0xFFFFFFFF))
            pattern = windows.points[windows.start[window[part]][:, None] + np.arange(size)]
            cost, end = align(pattern, region)
            good = np.flatnonzero(cost <= edits)
            if not len(good):
                continue
            stop = first[good] + size + end[good]
            # From the end backwards for the start.
            back = stop[:, None] - 1 - np.arange(size + edits)
            known = back >= offsets[text[part[good]]][:, None]
            behind = np.where(known, points[np.maximum(back, 0)], np.uint32(0xFFFFFFFF))
            begin = stop - _reach(pattern[good][:, ::-1], behind, cost[good])
            out.append((text[part[good]], window[part[good]], np.maximum(begin, offsets[text[part[good]]]), stop, cost[good]))
    return [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 5


def _reach(patterns: np.ndarray, texts: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """How many characters from the front of each text the pattern needs for its least cost, both from their first on."""
    many, length = patterns.shape
    extra = texts.shape[1] - length
    width = 2 * extra + 1
    column = np.arange(width, dtype=np.int32)
    padded = np.concatenate([np.full((many, extra), 0xFFFFFFFE, np.uint32), texts, np.full((many, extra), 0xFFFFFFFE, np.uint32)], axis=1)
    row = np.where(column >= extra, column - extra, 10_000).astype(np.int32)[None].repeat(many, 0)
    for i in range(length):
        new = row + (padded[:, i: i + width] != patterns[:, i: i + 1])
        new[:, :-1] = np.minimum(new[:, :-1], row[:, 1:] + 1)
        row = np.minimum.accumulate(new - column, axis=1) + column
    return length + row.argmin(axis=1) - extra


_FOUND = "array<struct<item_id:bigint,start:bigint,end:bigint,windows:int,edits:int>>"


def _matches(windows: Windows, column: pa.Array) -> pa.Array:
    """For each text the items it holds: first and last place, windows found, and edits of the closest window."""
    points, offsets, place, lengths = normal(column)
    text, window, begin, stop, cost = _verify(windows, points, offsets, *windows.candidates(points, offsets))
    found: dict[int, dict[int, list]] = {}
    for t, w, a, b, c in zip(*(x.tolist() for x in (text, window, begin, stop, cost))):
        start, end = int(place[a]), int(place[b - 1]) + 1
        one = found.setdefault(t, {}).setdefault(int(windows.item[w]), [start, end, set(), c])
        one[0], one[1], one[3] = min(one[0], start), max(one[1], end), min(one[3], c)
        one[2].add(w)
    rows = [[{"item_id": i, "start": v[0], "end": v[1], "windows": len(v[2]), "edits": v[3]}
             for i, v in sorted(found.get(t, {}).items())] for t in range(len(column))]
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()),
                               ("windows", pa.int32()), ("edits", pa.int32())]))
    return pa.array(rows, kind)


def _slices(benchmark: DataFrame, item_id: str, column: str) -> Iterator[list[tuple[int, str]]]:
    rows = benchmark.select(F.col(item_id).cast("long").alias("item"), F.col(column).alias("text")).dropna().distinct()
    part, size = [], 0
    for r in rows.orderBy("item", "text").toLocalIterator():
        if part and size + len(r["text"]) > SLICE_CHARACTERS:
            yield part
            part, size = [], 0
        part.append((r["item"], r["text"]))
        size += len(r["text"])
    if part:
        yield part


def find(documents: DataFrame, benchmark: DataFrame, column: str = "text", item_id: str = "item_id", item_text: str = "text",
         output: str = "benchmark_items", edit_rate: float = EDIT_RATE) -> DataFrame:
    """Add ``output``: the benchmark items that a text holds, as an array of (item_id, start, end, windows, edits)."""
    spark = documents.sparkSession
    documents = documents.drop(output)
    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in documents.schema)
    out = documents.withColumn(output, F.array().cast(_FOUND))
    for items in _slices(benchmark, item_id, item_text):
        blob = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], blob=blob) -> Iterator[pa.RecordBatch]:
            windows = Windows(blob.value, edit_rate)
            for piece in pieces(batches, column, STEP_BYTES):
                *others, before = piece.columns
                now = _matches(windows, piece.column(column))
                if any(len(x) for x in before):
                    now = pa.array([[*a, *b] for a, b in zip(before.to_pylist(), now.to_pylist())], now.type)
                yield pa.RecordBatch.from_arrays([*others, now], names=piece.schema.names)

        out = out.mapInArrow(run, f"{fields}, `{output}` {_FOUND}")
    return out
