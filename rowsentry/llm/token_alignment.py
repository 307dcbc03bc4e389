"""Alignment of two tokenizers by products of sparse incidence matrices.

Both tokenizers cut the same bytes, a space and the text. Token-byte incidence matrices A and B in compressed sparse rows give, by
Gustavson's row products, the overlap links A·Bᵀ (how many bytes two tokens share). Where two neighbouring links share no token,
tokens of both sides end: these offsets cut the text into groups. Group incidence matrices with one row for each id, whose
entries count its tokens in a group, give the links within groups by the same product: the entry of two ids is how many
pairs of their tokens share a group, so a group of any size costs its distinct ids, not its pairs.

Before a space between two visible ASCII or accented Latin characters both tokenizers end a token. Texts are cut there, and a
worker encodes and aligns each distinct run once, as long as it remembers it. Documents are written with a block number (a few megabytes of text); each block
asks for the corpus-wide counts of the id pairs it holds and is answered by a cogroup, so no table of all pairs is broadcast.

Null and empty texts, and those that a tokenizer does not give back byte by byte, have no tokens: zeros and an empty ``groups``.
Repeated rows are documents of their own. Columns that have the name of an output are replaced, others pass through.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsentry.llm.common import BLOCK, free_name, in_blocks, pieces, ragged, release, settle, utf8

#: Entries that one step of a product expands to at most (one longer row is a step of its own).
STEP = 1 << 20
#: Runs, and bytes of runs, whose alignment a worker remembers from one piece of text to the next.
REMEMBERED, REMEMBERED_BYTES = 1 << 19, 1 << 24
#: Id pairs that a task holds before it hands its counts on.
HELD = 1 << 19
OUTPUTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
# Fixed value: how the byte-level pre-tokenizer cuts a text.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_VISIBLE = np.zeros(256, bool)
_VISIBLE[33:127] = True
#: The second bytes of the accented Latin letters after 0xC3; multiplication and division signs are none.
_ACCENTED = np.zeros(256, bool)
_ACCENTED[[*range(0x80, 0x97), *range(0x98, 0xB7), *range(0xB8, 0xC0)]] = True


@dataclass
class Rows:
    """A sparse matrix in compressed rows."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @property
    def height(self) -> int:
        return len(self.starts) - 1

    def transposed(self) -> Rows:
        order = np.argsort(self.columns, kind="stable")
        starts = np.zeros(self.width + 1, np.int64)
        np.cumsum(np.bincount(self.columns, minlength=self.width), out=starts[1:])
        row = np.repeat(np.arange(self.height), np.diff(self.starts))
        return Rows(starts, row[order], self.values[order], self.height)


def incidence(lengths: np.ndarray) -> Rows:
    """Tokens x bytes of tokens that follow each other: each holds the next ``length`` bytes."""
    starts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    return Rows(starts, np.arange(starts[-1]), np.ones(int(starts[-1]), np.int64), int(starts[-1]))


def counted(rows: np.ndarray, columns: np.ndarray, height: int, width: int) -> Rows:
    """The matrix that counts how often each (row, column) occurs."""
    key, n = np.unique(rows * np.int64(width) + columns, return_counts=True)
    starts = np.zeros(height + 1, np.int64)
    np.cumsum(np.bincount(key // max(width, 1), minlength=height), out=starts[1:])
    return Rows(starts, key % max(width, 1), n.astype(np.int64), width)


def product(a: Rows, b: Rows, step: int = STEP) -> Rows:
    """A·B by rows: each row of A gathers the rows of B at its entries, scaled, and adds up equal columns."""
    size = np.diff(b.starts)[a.columns]
    before = np.concatenate([[0], np.cumsum(size)])
    at_row = before[a.starts]
    columns, values, heights = [], [], np.zeros(a.height, np.int64)
    first = 0
    while first < a.height:
        last = max(first + 1, int(np.searchsorted(at_row, at_row[first] + step, side="right")) - 1)
        entries = slice(int(a.starts[first]), int(a.starts[last]))
        source = ragged(b.starts[a.columns[entries]], size[entries])
        row = np.repeat(np.arange(first, last), np.diff(at_row[first: last + 1]))
        key = row * np.int64(b.width) + b.columns[source]
        value = np.repeat(a.values[entries], size[entries]) * b.values[source]
        if len(key):
            if (key[1:] < key[:-1]).any():
                order = np.argsort(key, kind="stable")
                key, value = key[order], value[order]
            new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            columns.append(key[new] % b.width)
            values.append(np.add.reduceat(value, new))
            heights[first:last] = np.bincount(key[new] // b.width - first, minlength=last - first)
        first = last
    none = np.zeros(0, np.int64)
    return Rows(np.concatenate([[0], np.cumsum(heights)]), np.concatenate([none, *columns]), np.concatenate([none, *values]), b.width)


def overlaps(a_lengths: np.ndarray, b_lengths: np.ndarray) -> Rows:
    """A tokens x B tokens: the bytes that both hold."""
    return product(incidence(a_lengths), incidence(b_lengths).transposed())


def groups(links: Rows) -> tuple[np.ndarray, np.ndarray, int]:
    """The group of each A token and of each B token, and the number of groups, from the overlap links."""
    a, b = np.repeat(np.arange(links.height), np.diff(links.starts)), links.columns
    opens = np.ones(len(a), bool)
    opens[1:] = (a[1:] != a[:-1]) & (b[1:] != b[:-1])
    number = np.cumsum(opens) - 1
    of_a, of_b = np.zeros(links.height, np.int64), np.zeros(links.width, np.int64)
    of_a[a], of_b[b] = number, number
    return of_a, of_b, int(opens.sum())


class Tokenizers:
    """Both tokenizers of a task, and what bytes each id stands for."""

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        points = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(p): p for p in points} | {chr(256 + k): p for k, p in enumerate(sorted(set(range(256)) - set(points)))}
        with open(a_path, encoding="utf-8") as f:
            described = json.load(f)
        model, cut = described["model"], described["pre_tokenizer"]
        vocabulary = model["vocab"]
        pattern = BYTE_LEVEL if cut["type"] == "ByteLevel" and cut["use_regex"] and not described["normalizer"] and not model["dropout"] else None
        a_bytes = [b""] * (max(max(vocabulary.values()), self.a.get_vocab_size() - 1) + 1)
        for token, i in vocabulary.items():
            a_bytes[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        b_pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(b_pieces)]
        # Runs may be cut before a space only if no piece goes on over one.
        self.cuts = not any("▁" in p.lstrip("▁") for p in b_pieces)
        # Merges in the order of their ids are ranks: then plain runs, where all engines agree on the classes of characters, take
        # the same merges in the faster library.
        self.ranked = None
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        if all(vocabulary.get(x + y) == 256 + k for k, (x, y) in enumerate(merges)) and pattern:
            import tiktoken

            ranks = {t: i for i, t in enumerate(a_bytes) if i < 256 + len(merges)}
            self.ranked = tiktoken.Encoding("ranked", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.b_ranked, self.b_of_rank = self._b_by_ranks(b_pieces, b_bytes)
        self.a_bytes, self.a_starts, self.a_width = *self._joined(a_bytes), len(a_bytes)
        self.b_bytes, self.b_starts, self.b_width = *self._joined(b_bytes), len(b_bytes)

    def _b_by_ranks(self, pieces: list[str], as_bytes: list[bytes]):
        """B's merges of plain runs in the faster library, and its ids by rank; None unless both surely agree.

        B merges the pair of the highest score first, the other the pair of the lowest rank. Characters of two bytes are the first
        merges, as B begins with characters.
        """
        import tiktoken

        b = self.b
        kinds = [(b.is_control(i) or b.is_unknown(i) or b.is_byte(i)) for i in range(len(pieces))]
        # Plain runs hold a single space, so pieces of several never meet them.
        normal = [i for i, special in enumerate(kinds) if not special and b"  " not in as_bytes[i]]
        odd = any(b.is_unused(i) for i in normal) or not self.cuts
        # Whole numbers that fall are scores of merges, not of chances; pieces given by the user have others.
        score = [b.get_score(i) for i in normal if len(pieces[i]) > 1]
        if odd or any(y >= x or y != int(y) for x, y in zip([1, *score], score)):
            return None, None
        of_bytes = {as_bytes[i]: i for i in normal}
        byte = {as_bytes[i][0]: i for i in range(len(pieces)) if b.is_byte(i)}
        plain = [*map(chr, range(33, 127)), *(chr(c) for c in range(0xC0, 0x100) if _ACCENTED[c - 0x40]), "\n"]
        for c in plain:
            if b"".join(as_bytes[i] for i in b.encode(f"x{c}x")) != f" x{c}x".encode() or not all(x in byte or bytes([x]) in of_bytes for x in c.encode()):
                return None, None
        # The other library takes a whole run that is a token as it is.
        whole = [i for i in normal if as_bytes[i][:1] == b" " and len(as_bytes[i]) > 1 and as_bytes[i].count(b" ") == 1]
        if any(x != [i] for i, x in zip(whole, b.encode([as_bytes[i][1:].decode() for i in whole], num_threads=1))):
            return None, None
        single = [bytes([x]) for x in range(256)]
        pairs = [c.encode() for c in plain if len(c.encode()) == 2 and c.encode() in of_bytes]
        longer = [as_bytes[i] for i in normal if len(as_bytes[i]) > 1 and as_bytes[i] not in pairs]
        ranks = {t: k for k, t in enumerate([*single, *pairs, *longer])}
        ids = [of_bytes.get(t, byte.get(t[0], -1) if len(t) == 1 else -1) for t in ranks]
        return tiktoken.Encoding("scored", pat_str=r" [^ ]+", mergeable_ranks=ranks, special_tokens={}), np.array(ids, np.int64)

    @staticmethod
    def _joined(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(b"".join(tokens), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64)

    def encode(self, runs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both tokenizers and how many each run has; runs begin with the space that B adds by itself."""
        size = np.fromiter(map(len, runs), np.int64, len(runs))
        data = np.frombuffer(b"".join(runs), np.uint8)
        plain = self._plain(data, size)
        joined = data[np.repeat(plain, size)].tobytes().decode()
        whole = [np.array(f(joined) if joined else [], np.int64) for f in (self._a_joined, self._b_joined)]
        ends = np.cumsum(size[plain])
        reached = []
        for ids, starts in zip(whole, (self.a_starts, self.b_starts)):
            reached.append(np.concatenate([[0], np.cumsum(starts[ids + 1] - starts[ids])]))
        if not all(len(ends) == 0 or np.isin(ends, r).all() for r in reached):  # a tokenizer that changes plain bytes
            plain, ends, whole, reached = np.zeros(len(runs), bool), ends[:0], [x[:0] for x in whole], [r[:1] for r in reached]
        rest = [runs[i].decode() for i in np.flatnonzero(~plain).tolist()]
        out = []
        for ids, at, each in zip(whole, reached, (self._a_each, self._b_each)):
            others = each(rest)
            counts = np.zeros(len(runs), np.int64)
            counts[plain] = np.diff(np.searchsorted(at, ends), prepend=0)
            counts[~plain] = [len(x) for x in others]
            own = np.repeat(plain, counts)
            merged = np.zeros(len(own), np.int64)
            merged[own], merged[~own] = ids, np.fromiter((i for x in others for i in x), np.int64)
            out += [merged, counts]
        return tuple(out)

    @staticmethod
    def _plain(data: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Which runs are, after their space, visible ASCII, accented Latin letters, and single line ends between these."""
        ends = np.cumsum(size)
        after, before = np.append(data[1:], np.uint8(32)), np.append(np.uint8(32), data[:-1])
        letter = (before == 0xC3) & _ACCENTED[data]
        lead = (data == 0xC3) & _ACCENTED[after]
        good = _VISIBLE[data] | letter | lead
        line = data == 10
        good[1:] |= line[1:] & good[:-1]
        good[:-1] &= ~line[:-1] | ((_VISIBLE[data] | lead)[1:])
        good[ends[size > 0] - 1] &= ~line[ends[size > 0] - 1]
        return (_per_run(good, size) == size - 1) & (size > 1) & (data[np.minimum(ends - size, max(len(data) - 1, 0))] == 32)

    def _a_joined(self, text: str) -> list[int]:
        return self.ranked.encode_ordinary(text) if self.ranked else self.a.encode(text, add_special_tokens=False).ids

    def _b_joined(self, text: str) -> list[int] | np.ndarray:
        return self.b_of_rank[self.b_ranked.encode_ordinary(text)] if self.b_ranked else self.b.encode(text[1:], num_threads=1)

    def _a_each(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def _b_each(self, texts: list[str]) -> list[list[int]]:
        return self.b.encode([t[1:] for t in texts], num_threads=1) if texts else []


@lru_cache(maxsize=2)
def tokenizers(a_path: str, b_path: str) -> Tokenizers:
    return Tokenizers(a_path, b_path)


def _per_run(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    at = np.concatenate([[0], np.cumsum(counts)])
    return total[at[1:]] - total[at[:-1]]


def _same_bytes(ids: np.ndarray, counts: np.ndarray, data: np.ndarray, starts: np.ndarray, wanted: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The byte length of each token, and for each run whether its tokens' bytes are the run."""
    lengths = starts[ids + 1] - starts[ids]
    size = np.array([len(w) for w in wanted], np.int64)
    equal = _per_run(lengths, counts) == size
    mine = data[ragged(starts[ids], lengths)]
    given = np.frombuffer(b"".join(wanted), np.uint8)
    own = np.concatenate([[0], np.cumsum(_per_run(lengths, counts))])
    theirs = np.concatenate([[0], np.cumsum(size)])
    fit = np.flatnonzero(equal)
    differ = mine[ragged(own[fit], size[fit])] != given[ragged(theirs[fit], size[fit])]
    equal[fit] = _per_run(differ, size[fit]) == 0
    return lengths, equal


@dataclass
class Aligned:
    """The distinct runs of some texts, aligned: counts of each, and the id pairs that each links."""

    whole: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    #: Rows runs, columns places in ``pairs``, values how many token pairs.
    links: Rows
    #: A id * B's width + B id, sorted.
    pairs: np.ndarray
    texts: list[str]


def align_runs(runs: list[bytes], both: Tokenizers, written: bool = True) -> Aligned:
    """Align distinct runs; those whose bytes a tokenizer does not give back have no tokens. ``texts`` are empty unless ``written``."""
    a, n_a, b, n_b = both.encode(runs)
    a_lengths, a_equal = _same_bytes(a, n_a, both.a_bytes, both.a_starts, runs)
    b_lengths, b_equal = _same_bytes(b, n_b, both.b_bytes, both.b_starts, runs)
    whole = a_equal & b_equal
    some_a, some_b = np.repeat(whole, n_a), np.repeat(whole, n_b)
    a, a_lengths, b, b_lengths = a[some_a], a_lengths[some_a], b[some_b], b_lengths[some_b]
    n_a, n_b = np.where(whole, n_a, 0), np.where(whole, n_b, 0)
    run_a, run_b = np.repeat(np.arange(len(runs)), n_a), np.repeat(np.arange(len(runs)), n_b)
    of_a, of_b, n = groups(overlaps(a_lengths, b_lengths))
    run_of = np.zeros(n, np.int64)
    run_of[of_a] = run_a
    # One row for each id of a run, one column for each group.
    a_rows, a_at = np.unique(run_a * np.int64(both.a_width) + a, return_inverse=True)
    b_rows, b_at = np.unique(run_b * np.int64(both.b_width) + b, return_inverse=True)
    shared = product(counted(a_at, of_a, len(a_rows), n), counted(b_at, of_b, len(b_rows), n).transposed())
    row = np.repeat(np.arange(shared.height), np.diff(shared.starts))
    pair = a_rows[row] % both.a_width * both.b_width + b_rows[shared.columns] % both.b_width
    pairs, place = np.unique(pair, return_inverse=True)
    run = a_rows[row] // both.a_width
    starts = np.concatenate([[0], np.cumsum(np.bincount(run, minlength=len(runs)))])
    links = Rows(starts, place, shared.values, len(pairs))
    texts = _written(a, of_a, b, of_b, run_of, n, len(runs)) if written else []
    return Aligned(whole, n_a, n_b, np.bincount(run_of, minlength=len(runs)), _per_run(shared.values, np.diff(starts)), links, pairs, texts)


def _written(a: np.ndarray, of_a: np.ndarray, b: np.ndarray, of_b: np.ndarray, run_of: np.ndarray, n: int, runs: int) -> list[str]:
    """The groups of each run as ``a1,a2|b1;a3|b2,b3``."""
    ids, group = np.concatenate([a, b]), np.concatenate([of_a, of_b])
    order = np.argsort(group, kind="stable")  # within a group A's tokens stay before B's
    ids, group, is_b = ids[order].tolist(), group[order], order >= len(a)
    mark = np.zeros(len(ids), np.int64)
    if len(ids):
        ends = np.append(group[1:] != group[:-1], True)
        mark[:-1] = (is_b[1:] != is_b[:-1]) & ~ends[:-1]
        last = np.append(run_of[group[1:]] != run_of[group[:-1]], True)
        mark[ends] = 2
        mark[last] = 3
    marks = (",", "|", ";", "\n")
    whole = "".join([f"{i}{marks[m]}" for i, m in zip(ids, mark.tolist())])
    lines = iter(whole.split("\n"))
    held = np.bincount(run_of, minlength=runs) > 0
    return [next(lines) if h else "" for h in held.tolist()]


def split_runs(column: pa.Array, cuts: bool = True) -> tuple[pa.Array, np.ndarray]:
    """The runs of all texts (each with a space before it), and the places of the texts' first runs."""
    data, offsets = utf8(column)
    texts = len(column)
    at = offsets + np.arange(texts + 1)
    spaced = np.full(len(data) + texts, 32, np.uint8)
    spaced[np.arange(len(data)) + np.repeat(np.arange(texts), np.diff(offsets)) + 1] = data
    first = np.zeros(len(spaced), bool)
    if cuts and len(spaced) > 2:
        begins = _VISIBLE[spaced] | (spaced == 0xC3)  # the lead byte of the accented Latin letters
        ends = _VISIBLE[spaced]
        ends[1:] |= spaced[:-1] == 0xC3
        first[1:-1] = ends[:-2] & (spaced[1:-1] == 32) & begins[2:]
    first[at[:-1]] = True
    starts = np.flatnonzero(first)
    places = np.append(starts, len(spaced)).astype(np.int64)
    runs = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(spaced)])
    return runs, np.searchsorted(starts, at)


class Known:
    """Runs that a worker has aligned: their numbers, counts, links (id pairs and how many token pairs) and groups as text.

    Only time depends on what is remembered. When it grows beyond its bounds, the runs that came again since the last time stay,
    unless they are too many themselves. Groups are only ``written`` for who needs them.
    """

    def __init__(self, both: Tokenizers, written: bool = True):
        self.both, self.written = both, written
        self.keep([])

    def keep(self, some: list[bytes]) -> None:
        """Only these of the known runs are still known."""
        none = np.zeros(0, np.int64)
        if some:
            old = np.fromiter(map(self.number.__getitem__, some), np.int64, len(some))
            size = self.starts[old + 1] - self.starts[old]
            at = ragged(self.starts[old], size)
            self.whole, self.counts = self.whole[old], self.counts[:, old]
            self.starts, self.pairs, self.times = np.concatenate([[0], np.cumsum(size)]), self.pairs[at], self.times[at]
            self.texts = [self.texts[i] for i in old.tolist()] if self.written else []
        else:
            self.whole, self.counts = np.zeros(0, bool), np.zeros((4, 0), np.int64)
            self.starts, self.pairs, self.times, self.texts = np.zeros(1, np.int64), none, none, []
        self.number = dict(zip(some, range(len(some))))
        self.bytes = sum(map(len, some))
        self.again = np.zeros(len(some), bool)

    def numbers(self, runs: pa.Array) -> np.ndarray:
        if len(self.number) > REMEMBERED or self.bytes > REMEMBERED_BYTES:
            came = self.again.tolist()
            some = [r for r, again in zip(self.number, came) if again]
            few = len(some) <= REMEMBERED // 2 and sum(map(len, some)) <= REMEMBERED_BYTES // 2
            self.keep(some if few else [])
        before, number = len(self.number), self.number
        # Most runs are there several times: each is looked up once.
        each = runs.dictionary_encode()
        distinct = each.dictionary.to_pylist()
        new = [r for r in distinct if r not in number]
        if new:
            made = align_runs(new, self.both, self.written)
            number.update(zip(new, range(before, before + len(new))))
            self.bytes += sum(map(len, new))
            self.whole = np.append(self.whole, made.whole)
            self.counts = np.hstack([self.counts, [made.n_a, made.n_b, made.n_groups, made.n_links]])
            self.starts = np.append(self.starts, self.starts[-1] + made.links.starts[1:])
            self.pairs = np.append(self.pairs, made.pairs[made.links.columns])
            self.times = np.append(self.times, made.links.values)
            self.texts += made.texts
            self.again = np.append(self.again, np.zeros(len(new), bool))
        found = np.fromiter(map(number.__getitem__, distinct), np.int64, len(distinct))
        self.again[found[found < before]] = True
        return found[each.indices.to_numpy()]


@lru_cache(maxsize=1)
def known(a_path: str, b_path: str, written: bool = True) -> Known:
    return Known(tokenizers(a_path, b_path), written)


@dataclass
class Texts:
    """Some texts by their runs: the known run at every place, whose text it is, and which texts have tokens."""

    known: Known
    runs: np.ndarray
    of: np.ndarray
    bounds: np.ndarray
    some: np.ndarray

    def summed(self, per_place: np.ndarray) -> np.ndarray:
        return np.where(self.some, _per_run(per_place, np.diff(self.bounds)), 0)

    def links(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the links of each of the runs are, and how many each has."""
        size = self.known.starts[runs + 1] - self.known.starts[runs]
        return ragged(self.known.starts[runs], size), size


def _texts(column: pa.Array, memory: Known) -> Texts:
    runs, bounds = split_runs(column, memory.both.cuts)
    numbers = memory.numbers(runs)
    n = np.diff(bounds)
    whole = _per_run(~memory.whole[numbers], n) == 0
    some = whole & (pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False) > 0)
    return Texts(memory, numbers, np.repeat(np.arange(len(n)), n), bounds, some)


def _documents_of(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Id pairs, and in how many of the texts each is linked."""
    kept = t.some[t.of]
    width = np.int64(max(len(t.known.whole), 1))
    held = np.unique(t.of[kept] * width + t.runs[kept])
    at, size = t.links(held % width)
    pairs, place = np.unique(t.known.pairs[at], return_inverse=True)
    once = np.unique(np.repeat(held // width, size) * np.int64(max(len(pairs), 1)) + place)
    return pairs, np.bincount(once % max(len(pairs), 1), minlength=len(pairs))


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    pairs, at = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
    n = np.zeros(len(pairs), np.int64)
    np.add.at(n, at, np.concatenate([c for _, c in parts]))
    return pairs, n


def pair_counts(table: DataFrame, block: str, column: str, a_path: str, b_path: str) -> DataFrame:
    """``block, pair, n``: how many of a block's documents hold an id pair linked; a pair may have several rows of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = known(a_path, b_path, False)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        number = None

        def out() -> pa.RecordBatch:
            pairs, n = _merged(held)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs), number, np.int64)), pa.array(pairs), pa.array(n)], names=["block", "pair", "n"])

        for piece in pieces(batches, column):
            blocks = piece.column(block).to_numpy()
            cut = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
            for i, j in zip(cut, cut[1:]):
                if held and blocks[i] != number:
                    yield out()
                number = blocks[i]
                held.append(_documents_of(_texts(piece.column(column).slice(i, j - i), memory)))
                if sum(len(p) for p, _ in held) > HELD:
                    held[:] = [_merged(held)]
                    if len(held[0][0]) > HELD // 2:
                        yield out()
        if held:
            yield out()

    return table.select(block, column).mapInArrow(run, "block long, pair long, n long")


def linked_ids(table: DataFrame, block: str, column: str, a_path: str, b_path: str) -> tuple[DataFrame, DataFrame]:
    """What each block asks for, and ``a_id, b_id, documents, best`` for every id pair of the corpus: in how many documents it is linked,
    and whether that is its A id's highest count.
    """
    width = tokenizers(a_path, b_path).b_width
    asked = settle(pair_counts(table, block, column, a_path, b_path))
    counts = asked.groupBy("pair").agg(F.sum("n").alias("documents")) \
        .select(F.expr(f"pair div {width}").alias("a_id"), F.expr(f"pair % {width}").alias("b_id"), "documents")
    counts = settle(counts)
    highest = counts.groupBy("a_id").agg(F.max("documents").alias("highest"))
    return asked, counts.join(highest, "a_id").select("a_id", "b_id", "documents", (F.col("documents") == F.col("highest")).alias("best"))


def align(df: DataFrame, a_path: str, b_path: str, column: str = "text", block_bytes: int = BLOCK) -> DataFrame:
    """Add ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups`` (``a1,a2|b1;a3|b2,b3``)."""
    df = df.drop(*OUTPUTS)
    block = free_name(df.columns, "block")
    table = settle(in_blocks(df, column, block, block_bytes))
    asked, counts = linked_ids(table, block, column, a_path, b_path)
    width = tokenizers(a_path, b_path).b_width
    answers = asked.select("block", "pair").distinct().join(
        counts.select((F.col("a_id") * width + F.col("b_id")).alias("pair"), "documents", "best"), "pair")
    kept = df.columns

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        memory = known(a_path, b_path)
        pair, documents, best = (right.column(c).to_numpy() for c in ("pair", "documents", "best"))
        order = np.argsort(pair)
        pair, documents, best = pair[order], documents[order], best[order].astype(np.int64)
        made = []
        for piece in pieces(left.to_batches(), column):
            t = _texts(piece.column(column), memory)
            held, place = np.unique(t.runs, return_inverse=True)
            links, per = t.links(held)
            # Pairs of texts without tokens were not asked for; their sums are not used.
            n = top = np.zeros(len(links), np.int64)
            if len(pair):
                at = np.minimum(np.searchsorted(pair, memory.pairs[links]), len(pair) - 1)
                there = pair[at] == memory.pairs[links]
                n, top = np.where(there, documents[at], 0), np.where(there, best[at], 0)
            sums = [t.summed(c[t.runs]) for c in memory.counts]
            sums += [t.summed(_per_run(memory.times[links] * v, per)[place]) for v in (top, n)]
            bounds, names = t.bounds.tolist(), memory.texts
            said = [names[r] for r in t.runs.tolist()]
            texts = [";".join(said[i:j]) if s else "" for i, j, s in zip(bounds, bounds[1:], t.some.tolist())]
            made.append(pa.RecordBatch.from_arrays([*(piece.column(c) for c in kept), *(pa.array(s.astype(np.int64)) for s in sums), pa.array(texts, pa.string())],
                                                   names=[*kept, *OUTPUTS]))
        release()
        return pa.Table.from_batches(made) if made else left.select(kept).slice(0, 0)

    fields = "".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}, " for f in df.schema)
    return table.groupBy(block).cogroup(answers.withColumnRenamed("block", block).groupBy(block)).applyInArrow(
        run, fields + "".join(f"{c} long, " for c in OUTPUTS[:-1]) + "groups string")
