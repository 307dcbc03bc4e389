"""Language of each span of a text: script ranges narrow the candidates, Viterbi over per-word scores places the changes.

A word (a run of letters and their marks) is scored for every learned language that uses its script, from hashed character trigrams with
word edges and from the hashed word itself. The best sequence of languages pays a penalty for each switch. Long texts
are cut into chunks of ``CHUNK`` words whose best scores between all pairs of states are found side by side and then
chained, so no text, however long, is walked word by word.

Texts that are null, empty or without a letter have the language ``und``, score 0 and no spans; so has every text if nothing
was learned. Equal texts have equal results, ties go to the language that sorts first. Columns that have the name of an
output are replaced, others pass through.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsentry.llm.common import mix, pieces, ragged, run_hashes, runs, utf8

#: Texts that each language is learned from at most (about; chosen by the hash of their text).
FIT_PER_LANGUAGE = 5_000
BITS = 14
BUCKETS = 1 << BITS
SWITCH_PENALTY = 8.0
#: Share of a language's learned words in a script from which on it is a candidate there.
SCRIPT_SHARE = 0.01
CHUNK = 128
LONGEST_EVIDENCE = 12.0
#: Numbers of languages.
STATE = np.int16

# First and last code points of scripts; letters outside are script 0.
SCRIPTS = {
    "Latin": [(0x41, 0x24F), (0x1E00, 0x1EFF)], "Greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)], "Cyrillic": [(0x400, 0x52F)],
    "Armenian": [(0x530, 0x58F)], "Hebrew": [(0x590, 0x5FF)], "Arabic": [(0x600, 0x6FF), (0x750, 0x77F)],
    "Devanagari": [(0x900, 0x97F)], "Bengali": [(0x980, 0x9FF)], "Tamil": [(0xB80, 0xBFF)], "Thai": [(0xE00, 0xE7F)],
    "Georgian": [(0x10A0, 0x10FF)], "Hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)], "Kana": [(0x3040, 0x30FF)],
    "Han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2A6DF)],
}


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: is it a letter (2), a mark (1) or neither (0), its script, its lower case."""
    size = 0x110000
    letter, script, lower = np.zeros(size, np.uint8), np.zeros(size, np.uint8), np.arange(size, dtype=np.uint32)
    for c in range(size):
        if 0xD800 <= c < 0xE000:
            continue
        ch = chr(c)
        letter[c] = {"L": 2, "M": 1}.get(unicodedata.category(ch)[0], 0)
        small = ch.lower()
        if len(small) == 1:
            lower[c] = ord(small)
    for k, ranges in enumerate(SCRIPTS.values(), 1):
        for a, b in ranges:
            script[a: b + 1] = k
    return letter, script, lower


@dataclass
class Words:
    """The words of some texts: ``bounds`` are the places of the texts' first words, ``starts`` and ``ends`` code points."""

    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray
    script: np.ndarray
    grams: np.ndarray
    gram_starts: np.ndarray
    word_bucket: np.ndarray


def _words(column: pa.Array) -> Words:
    data, byte_offsets = utf8(column)
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    reached = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=reached[1:])
    offsets = reached[byte_offsets]
    letter, script, lower = _tables()
    kind = letter[points]
    starts, ends, bounds = runs(kind > 0, offsets)
    if len(starts):  # a run of marks alone is no word
        lettered = np.maximum.reduceat(kind, starts) == 2
        bounds = np.concatenate([[0], np.cumsum(lettered)])[bounds]
        starts, ends = starts[lettered], ends[lettered]
    low = lower[points].astype(np.uint64)
    # Trigrams of the word with its edges: the k-th is (k-1, k, k+1), edges being 0.
    length = ends - starts
    at = ragged(starts, length)
    first = np.cumsum(length) - length
    before, after = low[np.maximum(at - 1, 0)], low[np.minimum(at + 1, max(len(low) - 1, 0))]
    before[first] = 0
    after[first + length - 1] = 0
    mixed = mix(before * np.uint64(0x9E3779B97F4A7C15) ^ low[at] * np.uint64(0xC2B2AE3D27D4EB4F) ^ after * np.uint64(0x165667B19E3779F9))
    whole = run_hashes(low, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    return Words(bounds, starts, ends, offsets, script[points[starts]], (mixed >> np.uint64(64 - BITS)).astype(np.int64),
                 first, (whole >> np.uint64(64 - BITS)).astype(np.int64) + BUCKETS)


@dataclass
class LanguageModel:
    languages: list[str]
    #: log P(bucket | language): trigrams, then words.
    scores: np.ndarray
    #: scripts x languages: may the language use the script?
    candidates: np.ndarray


def fit(df: DataFrame, column: str = "text", lang: str = "lang", per_language: int = FIT_PER_LANGUAGE) -> LanguageModel:
    """Learn from the rows with a text and a language, about ``per_language`` of each, chosen by the hash of the text.

    The counts are summed by Spark; the model has languages x (2 * BUCKETS + scripts) numbers.
    """
    rows = df.select(F.col(column).alias("text"), F.col(lang).alias("lang")).dropna()
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return LanguageModel([], np.zeros((2 * BUCKETS, 0), np.float32), np.zeros((len(SCRIPTS) + 1, 0), bool))
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, max(1, int(min(1.0, per_language / sizes[k]) * (1 << 62))))])
    part = rows.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 62)) < F.try_element_at(share, F.col("lang")))
    number = {k: i for i, k in enumerate(languages)}
    width = 2 * BUCKETS + len(SCRIPTS) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(languages) * width, np.int64)
        for piece in pieces(batches, "text"):
            w = _words(piece.column("text"))
            of_word = np.repeat(np.array([number[x] for x in piece.column("lang").to_pylist()], np.int64), np.diff(w.bounds)) * width
            of_gram = np.repeat(of_word, np.diff(np.append(w.gram_starts, len(w.grams))))
            total += np.bincount(np.concatenate([of_gram + w.grams, of_word + w.word_bucket, of_word + 2 * BUCKETS + w.script]),
                                 minlength=len(total))
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], names=["cell", "n"])

    counts = np.zeros((len(languages), width))
    for r in part.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[r["cell"] // width, r["cell"] % width] = r["n"]
    scores = []
    for block in (counts[:, :BUCKETS], counts[:, BUCKETS: 2 * BUCKETS]):
        p = block + 0.5
        scores.append(np.log(p / p.sum(axis=1, keepdims=True)))
    words = counts[:, 2 * BUCKETS:]
    candidates = words > SCRIPT_SHARE * np.maximum(words.sum(axis=1, keepdims=True), 1)
    return LanguageModel(languages, np.concatenate(scores, axis=1).T.astype(np.float32).copy(), candidates.T.copy())


def _evidence(w: Words, model: LanguageModel) -> np.ndarray:
    """words x languages: how much less than the best candidate each language explains a word, bounded."""
    if not len(w.starts):
        return np.zeros((0, len(model.languages)), np.float32)
    score = np.add.reduceat(model.scores[w.grams], w.gram_starts, axis=0) + model.scores[w.word_bucket]
    allowed = model.candidates[w.script]
    none = ~allowed.any(axis=1)
    score = np.where(allowed, score, -np.inf)
    score[none] = 0
    return np.maximum(score - score.max(axis=1, keepdims=True), -LONGEST_EVIDENCE)


def viterbi(evidence: np.ndarray, bounds: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """The state of every row of ``evidence`` on the best path of its text; ties go to the smaller state."""
    states = evidence.shape[1]
    path = np.zeros(len(evidence), STATE)
    n = np.diff(bounds)
    per_text = -(-n // CHUNK)
    chunk_bounds = np.concatenate([[0], np.cumsum(per_text)])
    chunks = int(chunk_bounds[-1])
    if not chunks or states < 2:
        return path
    which = np.arange(chunks) - np.repeat(chunk_bounds[:-1], per_text)
    start = np.repeat(bounds[:-1], per_text) + which * CHUNK
    size = np.minimum(CHUNK, np.repeat(bounds[1:], per_text) - start)
    order = np.argsort(-size, kind="stable")
    active = np.searchsorted(-size[order], -np.arange(1, CHUNK + 1), side="right")
    # Best score from any state before a chunk to any state at its end.
    through = np.full((chunks, states, states), -np.inf, np.float32)
    through[:, np.arange(states), np.arange(states)] = 0
    for t in range(CHUNK):
        a = active[t]
        if not a:
            break
        v = through[:a]
        through[:a] = np.maximum(v, v.max(axis=2, keepdims=True) - penalty) + evidence[start[order[:a]] + t][:, None, :]
    at = np.empty(chunks, np.int64)
    at[order] = np.arange(chunks)
    # Chain the chunks of each text, then walk back to the state before each chunk.
    texts = np.flatnonzero(n > 0)
    texts = texts[np.argsort(-per_text[texts], kind="stable")]
    value = np.zeros((len(texts), states), np.float32)
    enter = np.zeros((chunks, states), STATE)
    longest = int(per_text.max())
    alive = np.searchsorted(-per_text[texts], -np.arange(1, longest + 1), side="right")
    for c in range(longest):
        k = chunk_bounds[texts[: alive[c]]] + c
        both = value[: alive[c], :, None] + through[at[k]]
        enter[k] = both.argmax(axis=1)
        value[: alive[c]] = both.max(axis=1)
    state = value.argmax(axis=1)
    first, last = np.zeros(chunks, np.int64), np.zeros(chunks, np.int64)
    for c in range(longest - 1, -1, -1):
        k = chunk_bounds[texts[: alive[c]]] + c
        last[k] = state[: alive[c]]
        state[: alive[c]] = first[k] = enter[k, state[: alive[c]]]
    # Within the chunks, from the state before to the state at the end.
    v = np.full((chunks, states), -np.inf, np.float32)
    v[np.arange(chunks), first[order]] = 0
    came = np.zeros((len(evidence), states), STATE)
    own = np.arange(states, dtype=STATE)
    for t in range(CHUNK):
        a = active[t]
        if not a:
            break
        rows = start[order[:a]] + t
        best = v[:a].max(axis=1, keepdims=True) - penalty
        came[rows] = np.where(v[:a] >= best, own, v[:a].argmax(axis=1)[:, None])
        v[:a] = np.maximum(v[:a], best) + evidence[rows]
    state = last[order]
    for t in range(CHUNK - 1, -1, -1):
        a = active[t]
        if not a:
            continue
        rows = start[order[:a]] + t
        path[rows] = state[:a]
        state[:a] = came[rows, state[:a]]
    return path


def _label(column: pa.Array, model: LanguageModel, penalty: float) -> tuple[pa.Array, pa.Array, pa.Array]:
    w = _words(column)
    texts, states = len(column), len(model.languages)
    if not states:
        w.bounds, w.starts, w.ends = np.zeros(texts + 1, np.int64), w.starts[:0], w.ends[:0]
        path = np.zeros(0, STATE)
    else:
        path = viterbi(_evidence(w, model), w.bounds, penalty)
    of = np.repeat(np.arange(texts), np.diff(w.bounds))
    letters = np.bincount(of * max(states, 1) + path, weights=w.ends - w.starts, minlength=texts * max(states, 1)).reshape(texts, -1)
    some = np.diff(w.bounds) > 0
    best = letters.argmax(axis=1)
    score = np.where(some, letters.max(axis=1) / np.maximum(letters.sum(axis=1), 1), 0.0)
    names = np.array([*model.languages, "und"], object)
    opens = np.ones(len(path), bool)
    opens[1:] = (path[1:] != path[:-1]) | (of[1:] != of[:-1])
    begin = np.flatnonzero(opens)
    end = np.append(begin[1:], len(path)) - 1
    shift = w.offsets[of[begin]]
    spans = pa.StructArray.from_arrays(
        [pa.array(w.starts[begin] - shift, pa.int64()), pa.array(w.ends[end] - shift if len(begin) else begin, pa.int64()),
         pa.array(names[path[begin]], pa.string())], names=["start", "end", "lang"])
    per_text = np.searchsorted(of[begin], np.arange(texts + 1))
    return (pa.array(np.where(some, names[best], "und"), pa.string()), pa.array(score, pa.float64()),
            pa.ListArray.from_arrays(pa.array(per_text, pa.int32()), spans))


def label(df: DataFrame, model: LanguageModel, column: str = "text", penalty: float = SWITCH_PENALTY) -> DataFrame:
    """Add ``lang_pred`` (the language of most letters), ``score`` (their share) and ``lang_spans`` (start, end, lang)."""
    df = df.drop("lang_pred", "score", "lang_spans")
    shared = df.sparkSession.sparkContext.broadcast(model)
    names = [*df.columns, "lang_pred", "score", "lang_spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, column):
            yield pa.RecordBatch.from_arrays([*piece.columns, *_label(piece.column(column), shared.value, penalty)], names=names)

    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{fields}, lang_pred string, score double, lang_spans array<struct<start:bigint,end:bigint,lang:string>>")
