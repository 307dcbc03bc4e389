"""Byte-level BPE encoding and decoding with padded numpy matrices.

Words (the matches of the split pattern) that are new to a batch are bucketed by length and laid into padded matrices
of token ids. In each round every row merges its leftmost pair of minimum rank, so every row loses exactly one column;
pair ranks come from a vectorized open-addressing table, and rows without a pair to merge are taken out. Rows of more than
``LONG_WORD`` bytes (runs without any split) merge the same pairs in the same order from a heap, as a matrix round would
cost their whole length.

Null and empty texts have no tokens. Equal texts have equal tokens. Other columns pass through untouched; one that already has
the name of the output is replaced.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsentry.llm.common import pieces, ragged

WIDTHS = (4, 6, 8, 12, 16, 24, 32, 48, 64, 128, 256)
LONG_WORD = WIDTHS[-1]
#: Encoded words that a Python worker keeps; beyond it the store starts anew.
KEPT_WORDS = 150_000
NONE = np.int32(2**31 - 1)
#: A rank file is broadcast; larger ones are refused.
MAX_RANK_BYTES = 64 << 20


class PairTable:
    """(left id, right id) -> rank of the merged token: open addressing, looked up for whole arrays."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        self.bits = max(4, int(len(pairs) * 4).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, -1, np.int64)
        self.values = np.full(size, NONE, np.int32)
        left = np.fromiter((a for a, _ in pairs), np.int64, len(pairs))
        right = np.fromiter((b for _, b in pairs), np.int64, len(pairs))
        keys, values = left << 32 | right, np.fromiter(pairs.values(), np.int32, len(pairs))
        slots = self._slots(keys)
        while len(keys):
            free = self.keys[slots] == -1
            _, first = np.unique(slots, return_index=True)
            put = np.zeros(len(keys), bool)
            put[first] = True
            put &= free
            self.keys[slots[put]], self.values[slots[put]] = keys[put], values[put]
            keys, values, slots = keys[~put], values[~put], (slots[~put] + 1) & (size - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs; NONE where there is none or a side is padding (-1)."""
        out = np.full(left.shape, NONE, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        keys = left.ravel()[todo].astype(np.int64) << 32 | right.ravel()[todo]
        slots = self._slots(keys)
        flat = out.ravel()
        while len(todo):
            there = self.keys[slots]
            hit = there == keys
            flat[todo[hit]] = self.values[slots[hit]]
            more = ~hit & (there != -1)
            todo, keys, slots = todo[more], keys[more], (slots[more] + 1) & (len(self.keys) - 1)
        return out


class Vocabulary:
    def __init__(self, blob: bytes):
        self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, blob.splitlines()) if a}
        self.byte_id = np.full(256, -1, np.int32)
        for b in range(256):
            self.byte_id[b] = self.rank[bytes([b])]
        self.pairs = {(self.rank[t[:i]], self.rank[t[i:]]): r for t, r in self.rank.items() if len(t) > 1
                      for i in range(1, len(t)) if t[:i] in self.rank and t[i:] in self.rank}
        self.table = PairTable(self.pairs)
        size = max(self.rank.values()) + 1
        tokens = [b""] * size
        for t, r in self.rank.items():
            tokens[r] = t
        self.known = np.zeros(size, bool)
        self.known[list(self.rank.values())] = True
        self.lengths = np.fromiter(map(len, tokens), np.int64, size)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def encode_rows(self, words: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of the words, padded to ``width`` columns, and the number of each."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        ids = np.full((len(words), width), -1, np.int32)
        ids[np.arange(width) < lengths[:, None]] = self.byte_id[data]
        out, counts = np.full_like(ids, -1), lengths.copy()
        rows = np.arange(len(words))
        ranks = self.table.ranks(ids[:, :-1], ids[:, 1:])
        while len(rows):
            at = ranks.argmin(axis=1)
            each = np.arange(len(rows))
            best = ranks[each, at]
            done = best == NONE
            if done.any():
                out[rows[done], : ids.shape[1]] = ids[done]
                rows, ids, ranks, at, best = rows[~done], ids[~done], ranks[~done], at[~done], best[~done]
                each = np.arange(len(rows))
                if not len(rows):
                    break
            ids[each, at] = best
            counts[rows] -= 1
            keep = np.ones(ids.shape, bool)
            keep[each, at + 1] = False
            ids = ids[keep].reshape(len(rows), -1)
            keep = np.ones(ranks.shape, bool)
            keep[each, at] = False
            ranks = ranks[keep].reshape(len(rows), -1)
            if ranks.shape[1] == 0:
                out[rows, :1] = ids
                break
            left = at > 0
            ranks[each[left], at[left] - 1] = self.table.ranks(ids[each[left], at[left] - 1], ids[each[left], at[left]])
            right = at < ranks.shape[1]
            ranks[each[right], at[right]] = self.table.ranks(ids[each[right], at[right]], ids[each[right], at[right] + 1])
        return out, counts

    def encode_long(self, word: bytes) -> list[int]:
        """The same merges for one long word, from a heap of (rank, place)."""
        ids = self.byte_id[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := self.pairs.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = r, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (x := self.pairs.get((r, ids[after[i]]))) is not None:
                    heapq.heappush(heap, (x, i, r, ids[after[i]]))
            if before[i] >= 0 and (x := self.pairs.get((ids[before[i]], r))) is not None:
                heapq.heappush(heap, (x, before[i], ids[before[i]], r))
        return [x for x in ids if x >= 0]

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words one after the other, and the number of each."""
        found: list[np.ndarray | None] = [None] * len(words)
        buckets: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            whole = self.rank.get(w)
            if whole is not None:
                found[k] = np.array([whole], np.int32)
            elif len(w) > LONG_WORD:
                found[k] = np.array(self.encode_long(w), np.int32)
            else:
                buckets.setdefault(next(x for x in WIDTHS if len(w) <= x), []).append(k)
        for width, members in buckets.items():
            step = max(1, (1 << 20) // width)
            for a in range(0, len(members), step):
                part = members[a: a + step]
                ids, counts = self.encode_rows([words[k] for k in part], width)
                for k, row, n in zip(part, ids, counts.tolist()):
                    found[k] = row[:n]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return (np.concatenate(found) if found else np.zeros(0, np.int32)), counts

    def decode_ids(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all tokens one after the other, and the number of each."""
        if len(ids) and (ids.max() >= len(self.known) or not self.known[ids].all()):
            raise ValueError("a token id is not in the vocabulary")
        lengths = self.lengths[ids]
        return self.bytes[ragged(self.starts[ids], lengths)], lengths


@lru_cache(maxsize=2)
def _vocabulary(blob: bytes) -> Vocabulary:
    return Vocabulary(blob)


class Encoder:
    """Encodes texts, keeping the tokens of words seen before."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.split = vocabulary, regex.compile(pattern).findall
        self._reset()

    def _reset(self):
        self.slot: dict[str, int] = {}
        self.ids, self.counts = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts one after the other, and the number of each."""
        words: list[str] = []
        ends = []
        for t in texts:
            if t:
                words += self.split(t)
            ends.append(len(words))
        if len(self.slot) > KEPT_WORDS:
            self._reset()
        new = [w for w in dict.fromkeys(words) if w not in self.slot]
        if new:
            ids, counts = self.vocabulary.encode_words([w.encode("utf-8") for w in new])
            self.slot.update(zip(new, range(len(self.slot), len(self.slot) + len(new))))
            self.ids, self.counts = np.concatenate([self.ids, ids]), np.concatenate([self.counts, counts])
            self.starts = np.cumsum(self.counts) - self.counts
        if not words:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        slots = np.fromiter(map(self.slot.__getitem__, words), np.int64, len(words))
        counts = self.counts[slots]
        reached = np.concatenate([[0], np.cumsum(counts)])[np.array(ends, np.int64)]
        return self.ids[ragged(self.starts[slots], counts)], np.diff(reached, prepend=0)


def _read_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        blob = f.read(MAX_RANK_BYTES + 1)
    if len(blob) > MAX_RANK_BYTES:
        raise ValueError("the rank file is larger than what may be broadcast")
    return blob


def _map(df: DataFrame, column: str, outputs: tuple[str, ...], make):
    """Add the binary columns ``outputs`` that ``make`` (once a task) computes from slices of ``column``."""
    if column.lower() in {o.lower() for o in outputs}:
        raise ValueError("the output needs another name than its input")
    df = df.drop(*outputs)
    kept = df.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for piece in pieces(batches, column):
            made = [pa.array(x, pa.binary()) for x in step(piece.column(column))]
            yield pa.RecordBatch.from_arrays([*piece.columns, *made], names=[*piece.schema.names, *outputs])

    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in kept)
    return df.mapInArrow(run, f"{fields}, " + ", ".join(f"`{o}` binary" for o in outputs))


def _packed(encoder: Encoder, texts: pa.Array) -> list[bytes]:
    ids, counts = encoder.encode(texts.to_pylist())
    packed = ids.astype("<u4").tobytes()
    ends = np.cumsum(counts) * 4
    return [packed[b - 4 * n: b] for n, b in zip(counts.tolist(), ends.tolist())]


def _unpacked(vocabulary: Vocabulary, rows: list[bytes]) -> list[bytes]:
    data, lengths = vocabulary.decode_ids(np.frombuffer(b"".join(rows), "<u4").astype(np.int64))
    reached = np.concatenate([[0], np.cumsum(lengths)])
    ends = reached[np.cumsum([len(x) // 4 for x in rows], dtype=np.int64)].tolist()
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip([0, *ends], ends)]


def encode(df: DataFrame, ranks_path: str, pattern: str, column: str = "text", output: str = "tokens") -> DataFrame:
    """Add ``output``: the token ids of ``column``, packed as little-endian unsigned 32-bit integers.

    Each match of ``pattern`` is encoded on its own; special tokens are plain text. The rank file (bounded by
    ``MAX_RANK_BYTES``) is read by the driver and broadcast.
    """
    blob = df.sparkSession.sparkContext.broadcast(_read_ranks(ranks_path))

    def make():
        encoder = Encoder(_vocabulary(blob.value), pattern)
        return lambda texts: [_packed(encoder, texts)]

    return _map(df, column, (output,), make)


def decode(df: DataFrame, ranks_path: str, column: str = "tokens", output: str = "decoded") -> DataFrame:
    """Add ``output``: the bytes of the packed token ids in ``column`` (null: no bytes). Unknown ids raise."""
    blob = df.sparkSession.sparkContext.broadcast(_read_ranks(ranks_path))

    def make():
        vocabulary = _vocabulary(blob.value)
        return lambda packed: [_unpacked(vocabulary, [x or b"" for x in packed.to_pylist()])]

    return _map(df, column, (output,), make)


def encode_and_decode(df: DataFrame, ranks_path: str, pattern: str, column: str = "text", output: str = "tokens",
                      decoded: str = "decoded") -> DataFrame:
    """Add what :func:`encode` and then :func:`decode` of its ids add, in one pass: a task has one Python worker and one vocabulary."""
    blob = df.sparkSession.sparkContext.broadcast(_read_ranks(ranks_path))

    def make():
        vocabulary = _vocabulary(blob.value)
        encoder = Encoder(vocabulary, pattern)

        def step(texts: pa.Array) -> list[list[bytes]]:
            packed = _packed(encoder, texts)
            return [packed, _unpacked(vocabulary, packed)]

        return step

    return _map(df, column, (output, decoded), make)


def token_count(column: str = "tokens"):
    return (F.octet_length(column) / 4).cast("long")
