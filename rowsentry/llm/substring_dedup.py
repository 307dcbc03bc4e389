"""Substring dedup: MinHash banding of paragraphs, exact verification, and removals by connected components.

A paragraph is a line. The 5-word shingles of each are min-hashed into bands (``tune`` picks the fewest rows that reach the wanted
recall at the similarity); paragraphs that collide in a band are verified by the exact Jaccard similarity of their shingles. As
repeated passages also lie inside longer paragraphs, paragraphs are cut where the hash of three words is the least of its
surroundings, a place that depends on the passage alone; such pieces collide when they are equal.

Colliding paragraphs are first compared with the first of about their size and with their neighbour, and then, where they are not
connected, through the count tree of the Jaccard join, so that a line that fills a third of the table is no task's square. Of each component the first
place (smallest id, then start) stays, the others are removals. Repeated pieces are extended word by word, within their line, as
far as another document goes on alike. Neighbouring units of a document then make one passage, also across a changed word. Passages
shorter than ``MIN_CHARACTERS`` that hold no whole paragraph of ``PARAGRAPH_WORDS`` words are not reported, nor are repeats
within one document alone.

Words lie between ASCII white space, A-Z lower-cased; offsets are code points. Null and empty texts have no paragraphs, and units of
fewer than ``MIN_WORDS`` words are not compared. Rows that repeat an id and its text are one document. Rows without an id take
part and are reported with a null id (ids below -2^61 are reserved for them). Other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowsentry.llm.common import discard, drop_shuffles, mix, pieces, ragged, run_hashes, settle, shingle_hashes, span_hashes, utf8, word_spans
from rowsentry.llm.components import components
from rowsentry.llm.jaccard_join import first_of, linked, open_pairs, pick, picked, stand_ins, whole_runs

SIMILARITY = 0.75
RECALL = 0.99
REACH = 4
MIN_WORDS = 4
MIN_CHARACTERS = 140
#: Words of a whole paragraph that is reported whatever its length.
PARAGRAPH_WORDS = 8
#: Characters between two repeated units of one passage, for a short line that is no unit or a changed word.
GAP = 24
#: Words beyond a repeated piece that are compared in the first round, and at most in a later one.
WORDS, MOST_WORDS = 16, 256
NO_ID = 1 << 61


def tune(similarity: float = SIMILARITY, recall: float = RECALL, most_rows: int = 4) -> tuple[int, int]:
    """Bands and rows a band: of the choices that reach ``recall`` at ``similarity``, the one with the fewest bands.

    Each band is a shuffled row of a paragraph. Of equally many bands the one with more rows lets fewer strangers collide.
    """
    best = None
    for rows in range(1, most_rows + 1):
        bands = next(b for b in range(1, 10_000) if 1 - (1 - similarity ** rows) ** b >= recall)
        if best is None or bands <= best[0]:
            best = bands, rows
    return best


class Units:
    """The paragraphs and pieces of some texts: text, first and last character, shingles, id (hash of the words)."""

    def __init__(self, column: pa.Array):
        data, offsets = utf8(column)
        starts, ends, bounds = word_spans(data, offsets)
        words = span_hashes(data, starts, ends)
        n = len(words)
        text = np.repeat(np.arange(len(column)), np.diff(bounds))
        lines = np.cumsum(data == 10)
        line = lines[starts] if n else np.zeros(0, np.int64)
        opens = np.ones(n, bool)
        opens[1:] = (line[1:] != line[:-1]) | (text[1:] != text[:-1])
        number = np.cumsum(opens)
        cuts = opens | self._cuts(words, number)
        first = np.flatnonzero(opens)
        piece = np.flatnonzero(cuts)
        last = np.append(first[1:], n) if n else first
        piece_last = np.append(piece[1:], n) if n else piece
        # A paragraph of one piece is no piece besides.
        inner = ~(opens[piece] & (piece_last == last[number[piece] - 1])) if n else np.zeros(0, bool)
        a = np.concatenate([first, piece[inner]])
        b = np.concatenate([last, piece_last[inner]])
        self.whole = np.arange(len(a)) < len(first)
        long = b - a >= MIN_WORDS
        a, b, self.whole = a[long], b[long], self.whole[long]
        chars = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
        self.text = text[a] if n else np.zeros(0, np.int64)
        begin = chars[offsets[:-1]][self.text]
        self.start = (chars[starts[a]] if n else a) - begin
        self.end = (chars[ends[b - 1]] if n else a) - begin
        self.id = run_hashes(words, a, b).view(np.int64) if n else np.zeros(0, np.int64)
        self.words, self.a, self.b = words, a, b

    @staticmethod
    def _cuts(words: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Words before which a piece begins: the hash of the next three words is the least within ``REACH`` words."""
        n = len(words)
        if n < 3:
            return np.zeros(n, bool)
        top = np.uint64(0xFFFFFFFFFFFFFFFF)
        three = np.full(n, top)
        three[:-2] = mix(words[:-2] + words[1:-1] * np.uint64(0x9E3779B97F4A7C15) + words[2:] * np.uint64(0xC2B2AE3D27D4EB4F))
        three[:-2][number[2:] != number[:-2]] = top
        cut = three != top
        for k in range(1, min(REACH, n - 1) + 1):
            same = number[k:] == number[:-k]
            cut[k:] &= ~same | (three[k:] < three[:-k])
            cut[:-k] &= ~same | (three[:-k] <= three[k:])
        return cut

    def shingles(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The shingle hashes of the units with the given places, and the place of each unit's first."""
        size = self.b[some] - self.a[some]
        cuts = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(self.a[some] - cuts[:-1], size) + np.arange(cuts[-1])
        return shingle_hashes(self.words[at], cuts)


def _rows(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """``key, n, set, id, start, end``: a row for each band of a paragraph and one for each piece.

    A piece's key is its set; it is not moved twice, its ``set`` is 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = mix(np.arange(1, bands * rows + 1, dtype=np.uint64))
        for piece in pieces(batches, "text"):
            u = Units(piece.column("text"))
            if not len(u.id):
                continue
            whole = np.flatnonzero(u.whole)
            hashes, cuts = u.shingles(whole)
            keys = []
            for band in range(bands):
                key = np.full(len(whole), band + 1, np.uint64)
                for r in range(rows):
                    least = np.minimum.reduceat(mix(hashes ^ seeds[band * rows + r]), cuts[:-1])
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) ^ least)
                keys.append(key)
            part = np.flatnonzero(~u.whole)
            keys.append(u.id[part].view(np.uint64))
            place = np.concatenate([*[whole] * bands, part])
            sets = np.concatenate([*[u.id[whole]] * bands, np.zeros(len(part), np.int64)])
            n = np.maximum(u.b - u.a - 4, 1)
            ids = piece.column("id").to_numpy(zero_copy_only=False)
            columns = (np.concatenate(keys).view(np.int64), n[place].astype(np.int32), sets, ids[u.text[place]],
                       u.start[place].astype(np.int32), u.end[place].astype(np.int32))
            for a in range(0, len(place), 65536):
                yield pa.RecordBatch.from_arrays([pa.array(c[a: a + 65536]) for c in columns],
                                                 names=["key", "n", "set", "id", "start", "end"])

    return docs.mapInArrow(run, "key long, n int, set long, id long, start int, end int")


def _collisions(rows: DataFrame) -> DataFrame:
    """The rows whose key others have, too, with the sets they are compared with first, and whether a key has different sets.

    These are the sets that stand for their size and the set before them: in a group of near copies few then stay apart. Where all
    sets of a key are the same, nothing is compared: these rows, the most by far, are their place and no more.
    """
    names = ["key", "n", "set", "id", "start", "end"]
    dealt = rows.repartition("key").sortWithinPartitions("key", "n", "set", "id", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = whole_runs(batches, names, 1)
        for found, open_ in source:
            if found is None:
                continue
            new = np.ones(len(found["key"]), bool)
            new[1:] = np.any([found[c][1:] != found[c][:-1] for c in ("key", "set", "id", "start")], axis=0)
            key, n, ids, *rest = (found[c][new] for c in names)
            ids = np.where(ids == 0, key, ids)
            opens = np.ones(len(key), bool)
            opens[1:] = key[1:] != key[:-1]
            start = first_of(opens)
            many = np.bincount(start, minlength=len(key))[start] > 1
            differ = np.bincount(start, ids != ids[start], minlength=len(key))[start] > 0
            firsts = stand_ins(opens, n)
            before = np.where(opens, ids, np.roll(ids, 1))
            if many.any():
                same = ~differ[many]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(x[many]) for x in (ids, *rest, differ)),
                     *(pa.array(x[many], mask=same) for x in (key, ids[firsts[0]], ids[firsts[1]], before))],
                    names=[*names[2:], "differ", "key", "near", "nearer", "before"])
            if open_:
                some = np.unique(np.concatenate(firsts))
                source.send({c: v[new][some] for c, v in found.items()})

    return dealt.mapInArrow(run, "set long, id long, start int, end int, differ boolean, key long, near long, nearer long, before long")


def _unit_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``set, shingles`` of the units ``set`` that ``wanted`` names with the ``id`` of a text that holds them."""
    found, bitmap = pick(docs, wanted)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(picked(batches, shared.value), "text"):
            u = Units(piece.column("text"))
            whole = np.flatnonzero(u.whole)
            if not len(whole):
                continue
            hashes, cuts = u.shingles(whole)
            of = np.repeat(np.arange(len(whole)), np.diff(cuts))
            order = np.lexsort((hashes, of))
            hashes, of = hashes[order], of[order]
            new = np.ones(len(hashes), bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
            hashes, of = hashes[new], of[new]
            ends = np.searchsorted(of, np.arange(len(whole) + 1))
            ids = piece.column("id").to_numpy(zero_copy_only=False)
            for a in range(0, len(whole), 4096):
                b = min(a + 4096, len(whole))
                part = hashes[ends[a]: ends[b]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[u.text[whole[a:b]]]), pa.array(u.id[whole[a:b]]),
                     pa.ListArray.from_arrays(pa.array(ends[a: b + 1] - ends[a], pa.int32()), pa.array(part.view(np.int64)))],
                    names=["id", "set", "shingles"])

    made = found.mapInArrow(run, "id long, set long, shingles array<long>")
    return made.join(wanted, ["id", "set"], "left_semi").drop("id").dropDuplicates(["set"])


def _strings(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The bytes of each run of equally wide ``values``, one binary per run."""
    ends = np.concatenate([[0], np.cumsum(lengths)]) * values.dtype.itemsize
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(values.tobytes())])


def _beyond(docs: DataFrame, units: DataFrame, offset: int, width: int) -> DataFrame:
    """``key, words, steps, id, start, side, base, more``: a row for each side of a repeated piece that has words beyond it.

    ``words`` are 32-bit hashes of up to ``width`` words before the piece (side -1, backwards) or after it (1) from the
    ``offset``-th on, as far as the far end of the next repeated piece or of the line; ``steps`` are their widths in characters,
    counted from ``base``, and ``more`` says that others follow. ``key`` is the hash of the piece, all words before ``words`` and
    the first of them: only rows of one key can go on alike. Whole paragraphs of ``PARAGRAPH_WORDS`` words have a row of side 0.
    """
    spans = units.groupBy("id").agg(F.collect_list(F.struct("start", "end")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            data, offsets = utf8(piece.column("text"))
            starts, ends, bounds = word_spans(data, offsets)
            if not len(starts):
                continue
            words = span_hashes(data, starts, ends)
            text = np.repeat(np.arange(piece.num_rows), np.diff(bounds))
            chars = np.zeros(len(data) + 1, np.int64)
            np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
            begin = chars[offsets[:-1]][text]
            first_char, last_char = chars[starts] - begin, chars[ends] - begin
            line = np.cumsum(data == 10)[starts]
            opens = np.ones(len(words), bool)
            opens[1:] = (line[1:] != line[:-1]) | (text[1:] != text[:-1])
            number = np.cumsum(opens) - 1
            first = np.flatnonzero(opens)
            last = np.append(first[1:], len(words))
            lists = piece.column("spans")
            of = np.repeat(np.arange(piece.num_rows), lists.value_lengths().to_numpy())
            flat = lists.flatten()
            keys = [(of << 32) + flat.field(k).to_numpy().astype(np.int64) for k in (0, 1)]
            heads, tails = (text << 32) + first_char, (text << 32) + last_char
            a = np.minimum(np.searchsorted(heads, keys[0]), len(words) - 1)
            b = np.minimum(np.searchsorted(tails, keys[1]), len(words) - 1)
            fits = (heads[a] == keys[0]) & (tails[b] == keys[1])  # else it is a place in another text of the same id
            a, b = a[fits], b[fits] + 1
            whole = (a == first[number[a]]) & (b == last[number[a]])
            ids = piece.column("id").to_numpy(zero_copy_only=False)
            long = np.flatnonzero(whole & (b - a >= PARAGRAPH_WORDS)) if not offset else np.zeros(0, np.int64)
            none = np.zeros(len(long), np.int64)
            rows = [(a[long], none, none, none, mix(ids[text[a[long]]].view(np.uint64) ^ a[long].view(np.uint64)), last_char[b[long] - 1])]
            a, b = a[~whole], b[~whole]
            order = np.argsort(a)
            a, b = a[order], b[order]
            low, high = first[number[a]], last[number[a]]
            same = number[a[1:]] == number[a[:-1]]
            low[1:] = np.where(same, a[:-1], low[1:])
            high[:-1] = np.where(same, b[1:], high[:-1])
            for side, reach in ((-1, a - np.minimum(low, a)), (1, np.maximum(high, b) - b)):
                some = reach > offset
                at, to, left = a[some], b[some], reach[some] - offset
                if side < 0:
                    key, base = run_hashes(words, at - offset - 1, to), first_char[at - offset]
                else:
                    key, base = run_hashes(words, at, to + offset + 1), last_char[to + offset - 1]
                rows.append((at, np.full(len(at), side), left, to, mix(key ^ np.uint64(2 + side)), base))
            owner, side, left, to, key, base = (np.concatenate(x) for x in zip(*rows))
            for k in range(0, len(owner), 16384):
                o, s, n, t = (c[k: k + 16384] for c in (owner, side, left, to))
                taken = np.minimum(n, width)
                step, which = ragged(np.zeros(len(o), np.int64), taken), np.repeat(np.arange(len(o)), taken)
                after = s[which] > 0
                word = np.where(after, t[which] + offset + step, o[which] - offset - 1 - step)
                wide = np.where(after, last_char[word] - last_char[word - 1], first_char[np.minimum(word + 1, len(words) - 1)] - first_char[word])
                kind = np.uint16 if not len(wide) or wide.max() < 1 << 16 else np.uint32
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[k: k + 16384].view(np.int64)), _strings((words[word] >> np.uint64(32)).astype(">u4"), taken),
                     _strings(wide.astype(kind), taken), pa.array(ids[text[o]]), pa.array(first_char[o].astype(np.int32)),
                     pa.array(s.astype(np.int32)), pa.array(base[k: k + 16384].astype(np.int32)), pa.array(n > width)],
                    names=["key", "words", "steps", "id", "start", "side", "base", "more"])

    return docs.join(spans, "id").mapInArrow(
        run, "key long, words binary, steps binary, id long, start int, side int, base int, more boolean")


def _matrix(column: pa.Array, n: np.ndarray, kind: str, width: int) -> np.ndarray:
    """The values of each binary as a row, with zeros behind them."""
    out = np.zeros((len(n), width), np.int64)
    out[np.arange(width) < n[:, None]] = np.frombuffer(b"".join(column.to_pylist()), kind)
    return out


def _least(values: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """The running minimum of each run of ``values``, which begin where ``opens``."""
    drop = np.cumsum(opens) << 32
    return np.minimum.accumulate(values - drop) + drop


def _common(beyond: DataFrame, width: int) -> DataFrame:
    """``id, start, side, at, full``: how far the words beyond a piece go on as in another document; ``full`` if they may go on.

    Sorted by their words, the rows that share most with one another are neighbours; a row is compared with the nearest row of
    another document on either side. Words are compared by 32 bits: 1 of 4 billion unequal pairs lengthens a passage by a word.
    """
    names = ["key", "id", "start", "side", "base", "more", "n", "words", "steps"]
    dealt = beyond.repartition("key").sortWithinPartitions("key", "words", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, told = None, 0
        for batch in chain(batches, [None]):
            if batch is not None:
                if not batch.num_rows:
                    continue
                rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names[:6]}
                rows["n"] = pc.binary_length(batch.column("words")).to_numpy() // 4
                rows["words"] = _matrix(batch.column("words"), rows["n"], ">u4", width)
                size = pc.binary_length(batch.column("steps")).to_numpy()
                rows["steps"] = np.zeros((batch.num_rows, width), np.int64)
                for each, kind in ((2, "<u2"), (4, "<u4")):
                    of = np.flatnonzero(size == each * rows["n"]) if each == 2 else np.flatnonzero((size == 4 * rows["n"]) & (rows["n"] > 0))
                    rows["steps"][of] = _matrix(batch.column("steps").take(pa.array(of)), rows["n"][of], kind, width)
                if held is not None:
                    rows = {c: np.concatenate([held[c], rows[c]]) for c in names}
            elif held is None:
                return
            else:
                rows = held
            key, ids, n = rows["key"], rows["id"], rows["n"]
            near = np.zeros(len(key) + 1, np.int64)  # words a row shares with the one before it
            equal = np.cumprod(rows["words"][1:] == rows["words"][:-1], axis=1).sum(axis=1)
            near[1:-1] = np.where(key[1:] == key[:-1], np.minimum(equal, np.minimum(n[1:], n[:-1])), 0)
            opens = np.ones(len(key), bool)
            opens[1:] = (key[1:] != key[:-1]) | (ids[1:] != ids[:-1])
            shuts = np.append(opens[1:], True)
            length = np.maximum(_least(near[:-1], opens), _least(near[:0:-1], shuts[::-1])[::-1])
            # The last document's rows wait for the next one's, with the row before them.
            end = len(key) if batch is None else int(np.flatnonzero(opens)[-1])
            some = np.arange(told, end)
            some = some[(length[some] > 0) | (rows["side"][some] == 0)]
            far = (rows["steps"][some] * (np.arange(width) < length[some, None])).sum(axis=1)
            columns = (ids[some], rows["start"][some], rows["side"][some], (rows["base"][some] + rows["side"][some] * far).astype(np.int32),
                       rows["more"][some] & (length[some] == width))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["id", "start", "side", "at", "full"])
            held, told = {c: v[max(end - 1, 0):] for c, v in rows.items()}, min(end, 1)

    return dealt.mapInArrow(run, "id long, start int, side int, at int, full boolean")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts whose ids ``wanted`` has, and a few others: a round moves the texts it reads, most of which ended in earlier rounds."""
    found, bitmap = pick(docs, wanted)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)
    return found.mapInArrow(lambda batches: picked(batches, shared.value), "id long, text string, cell long").drop("cell")


def _extended(docs: DataFrame, units: DataFrame) -> DataFrame:
    """The units with their ends where the text goes on as in no other document, and whether one is a whole ``paragraph``.

    Words beyond a piece are compared ``WORDS`` at a time first; where all of them go on alike, more follow, four times as many a round.
    """
    found, offset, width, open_, texts = None, 0, WORDS, units, docs
    while True:
        part = settle(_common(_beyond(texts, open_, offset, width), width))
        drop_shuffles(docs.sparkSession)
        found = part if found is None else found.unionAll(part)
        full = part.filter("full").select("id").distinct()
        if full.isEmpty():
            break
        open_ = units.join(full, "id", "left_semi")
        left, texts = texts, settle(_texts(texts, full))
        if left is not docs:
            discard(left)
        offset, width = offset + width, min(width * 4, MOST_WORDS)
    if texts is not docs:
        discard(texts)
    reach = found.filter("side <> 0").groupBy("id", "start").agg(
        F.min(F.when(F.col("side") < 0, F.col("at"))).alias("from"), F.max(F.when(F.col("side") > 0, F.col("at"))).alias("to"))
    paragraphs = found.filter("side = 0").select("id", "start", F.col("at").alias("end"), F.lit(True).alias("paragraph")).distinct()
    found = units.join(paragraphs, ["id", "start", "end"], "left").join(reach, ["id", "start"], "left")
    # A whole paragraph begins where its first piece does; it ends with its line, so the piece's reach is within it.
    return found.select("id", F.coalesce("from", "start").alias("start"), F.greatest("end", "to").alias("end"), "root", "stays",
                        F.coalesce("paragraph", F.lit(False)).alias("paragraph"))


def repeats(df: DataFrame, doc_id: str = "doc_id", column: str = "text", min_characters: int = MIN_CHARACTERS,
            similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """Passages that repeat across documents.

    ``doc_id, start, end`` (code points), ``units`` in it, ``removed`` characters of units that are not their component's
    first place, and ``cluster_id``, the smallest component in it.
    """
    text = F.coalesce(F.col(column), F.lit(""))
    own = F.coalesce(F.col(doc_id).cast("long"), -F.lit(NO_ID) - F.pmod(F.xxhash64(text), F.lit(NO_ID)))
    docs = df.select(own.alias("id"), text.alias("text"))
    met = settle(_collisions(_rows(docs, *tune(similarity, recall))))
    drop_shuffles(df.sparkSession)
    mixed = met.filter("differ")
    wanted = settle(mixed.groupBy("set").agg(F.min("id").alias("id")))
    sets = settle(_unit_sets(docs, wanted))
    stars = mixed.select("set", F.explode(F.array("near", "nearer", "before")).alias("near")).filter("set <> near") \
        .select(F.least("set", "near").alias("a"), F.greatest("set", "near").alias("b")).distinct()
    links = settle(linked(stars, sets))
    drop_shuffles(df.sparkSession)
    classes = sets.join(components(links).withColumnRenamed("node", "set"), "set", "left") \
        .select("set", "shingles", F.coalesce("root", "set").alias("root"))
    sizes = sets.select("set", F.size("shingles").alias("n"))
    meetings = settle(mixed.select("key", "set").distinct().join(sizes, "set").withColumn("place", F.lit(0)))
    more = settle(open_pairs(meetings, classes))
    drop_shuffles(df.sparkSession)
    roots = components(links.unionAll(more)).withColumnRenamed("node", "set")
    places = met.select("set", "id", "start", "end").distinct().join(roots, "set", "left").withColumn("root", F.coalesce("root", "set"))
    places = settle(places)
    shared = places.groupBy("root").agg(F.min(F.struct("id", "start")).alias("first"), F.max("id").alias("last")) \
        .filter(F.col("first.id") < F.col("last")).select("root", "first")
    units = places.join(shared, "root").select(
        "id", "start", "end", "root", ((F.col("first.id") == F.col("id")) & (F.col("first.start") == F.col("start"))).alias("stays"))
    units = settle(units)
    discard(met, wanted, sets, links, meetings, more, places)
    drop_shuffles(df.sparkSession)
    units = _extended(docs, units)
    by_place = Window.partitionBy("id").orderBy("start", "end")
    reached = F.max("end").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    number = F.sum((F.coalesce(F.col("start") - F.col("reached"), F.lit(GAP + 1)) > GAP).cast("int")).over(
        by_place.rowsBetween(Window.unboundedPreceding, 0))
    passages = units.withColumn("reached", reached).withColumn("number", number).groupBy("id", "number").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("units"),
        F.sum(F.when(F.col("stays"), 0).otherwise(
            F.greatest(F.col("end") - F.greatest("start", F.coalesce("reached", F.lit(0))), F.lit(0)))).alias("removed"),
        F.min("root").alias("cluster_id"), F.max("paragraph").alias("paragraph")) \
        .filter((F.col("end") - F.col("start") >= min_characters) | F.col("paragraph"))
    return passages.select(F.when(F.col("id") > -NO_ID, F.col("id")).alias(doc_id), "start", "end", "units", "removed", "cluster_id")
