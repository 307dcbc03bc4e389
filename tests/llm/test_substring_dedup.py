import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rowsentry.llm import substring_dedup


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnoprstuvé") for _ in range(rng.randint(2, 8))) for _ in range(n))


@pytest.mark.parametrize("similarity, recall", [(0.75, 0.99), (0.9, 0.999), (0.5, 0.9)])
def test_bands_reach_the_recall(similarity, recall):
    bands, rows = substring_dedup.tune(similarity, recall)
    assert 1 - (1 - similarity ** rows) ** bands >= recall
    assert rows == 1 or 1 - (1 - similarity) ** (bands - 1) < recall


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(7)
    passages = [words(rng, 60) for _ in range(4)]
    near = words(rng, 70).split()
    rows, holds = [], set()
    for i in range(120):
        body = [words(rng, rng.randint(10, 60)) for _ in range(3)]
        if i % 3 == 0:  # inside a paragraph
            body[1] = f"{words(rng, 7)} {passages[i % 4]} {words(rng, 9)}"
        elif i % 3 == 1 and i % 2:  # a paragraph with a word changed
            copy = list(near)
            copy[rng.randrange(70)] = "changed"
            body.insert(2, " ".join(copy))
        if i % 3 == 0 or (i % 3 == 1 and i % 2):
            holds.add(i)
        rows.append((i, "\n".join(body), "clash"))
    return spark.createDataFrame(rows, "doc_id long, text string, set string"), holds, {r[0]: r[1] for r in rows}, passages


def test_repeated_passages_are_found_and_others_left(corpus):
    df, holds, text, passages = corpus
    rows = substring_dedup.repeats(df).collect()
    assert {r["doc_id"] for r in rows} == holds
    assert all(text[r["doc_id"]][r["start"]: r["end"]] in passages[r["doc_id"] % 4] for r in rows if r["doc_id"] % 3 == 0)
    first = {r["doc_id"] for r in rows if r["removed"] == 0}
    assert min(holds) in first and len(first) <= 6  # each passage stays once


def test_hot_paragraph_and_split_runs(spark, corpus, monkeypatch):
    from rowsentry.llm import jaccard_join

    monkeypatch.setattr(jaccard_join, "RUN_ROWS", 4)
    df, holds, _, _ = corpus
    hot = words(random.Random(1), 40)
    more = df.withColumn("text", F.concat("text", F.lit("\n" + hot)))
    assert {r["doc_id"] for r in substring_dedup.repeats(more).collect()} == set(range(120))


def test_defined_results(spark):
    passage = words(random.Random(3), 50)
    rows = [(1, None), (2, ""), (3, "a b"), (4, passage), (4, passage), (5, f"{passage}\n{passage}"), (None, passage + " more"), (6, "of " * 30_000)]
    got = substring_dedup.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["4", "5", "None"]
    alone = spark.createDataFrame([(5, f"{passage}\n{passage}"), (6, "x")], "doc_id long, text string")
    assert substring_dedup.repeats(alone).count() == 0
    assert substring_dedup.repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_cuts_depend_on_the_passage_alone():
    rng = random.Random(5)
    passage = words(rng, 80)
    units = substring_dedup.Units(pa.array([f"{words(rng, 11)} {passage} {words(rng, 5)}", f"{words(rng, 3)} {passage} {words(rng, 20)}"]))
    ids = [set(units.id[(units.text == t) & ~units.whole].tolist()) for t in (0, 1)]
    assert len(ids[0] & ids[1]) >= 4
    assert np.all(units.end > units.start)


def test_passages_in_longer_lines_are_found_to_their_ends(spark):
    rng = random.Random(11)
    rows, want = [], {}
    for k in range(150):
        passage = words(rng, 51)
        for i in (2 * k, 2 * k + 1):
            before = words(rng, rng.randint(3, 25))
            rows.append((i, f"{words(rng, 20)}\n{before} {passage} {words(rng, rng.randint(3, 25))}"))
            at = rows[-1][1].index(passage)
            want[i] = (at, at + len(passage))
    got = substring_dedup.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["start"], r["end"]) for r in got} == want


def test_short_whole_paragraphs_are_reported(spark):
    line = "one short line of nine words that is repeated"
    rows = [(k, f"{words(random.Random(k), 30)}\n{line}\n{words(random.Random(100 + k), 20)}") for k in range(3)]
    got = substring_dedup.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], rows[r["doc_id"]][1][r["start"]: r["end"]]) for r in got) == [(k, line) for k in range(3)]


def test_edited_passages_in_longer_lines_are_found_whole(spark):
    rng = random.Random(12)
    rows, want = [], {}
    for k in range(100):
        passage = words(rng, 80).split()
        for i in (2 * k, 2 * k + 1):
            copy = " ".join([*passage[:40], "changed", *passage[41:]] if i % 2 else passage)
            rows.append((i, f"{words(rng, 20)}\n{words(rng, rng.randint(3, 25))} {copy} {words(rng, rng.randint(3, 25))}"))
            at = rows[-1][1].index(copy)
            want[i] = (at, at + len(copy))
    got = substring_dedup.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["start"], r["end"]) for r in got} == want


def test_words_beyond_a_piece_agree_with_all_pairs(spark):
    rng = np.random.default_rng(3)
    rows, wanted = [], []
    for i in range(400):
        n = int(rng.integers(0, 7))
        rows.append((int(rng.integers(0, 3)), [int(w) for w in rng.integers(1, 3, n)], int(rng.integers(0, 40)), i, -1 if i % 2 else 1, bool(i % 3)))
    for key, words, doc, i, side, more in rows:
        best = 0
        for other, there, who, *_ in rows:
            if other == key and who != doc:
                best = max(best, next((k for k, (a, b) in enumerate(zip(words, there)) if a != b), min(len(words), len(there))))
        if best:
            wanted.append((doc, i, side, 100 + side * 5 * best, more and best == 6))
    table = [(k, np.array(w, ">u4").tobytes(), np.full(len(w), 5, np.uint16).tobytes(), d, i, s, 100, m) for k, w, d, i, s, m in rows]
    frame = spark.createDataFrame(table, "key long, words binary, steps binary, id long, start int, side int, base int, more boolean")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = [tuple(r) for r in substring_dedup._common(frame, 6).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(found) == sorted(wanted)


def test_rounds_of_few_words_agree_with_one(spark, monkeypatch):
    shared = " ".join(f"w{k * 7919 % 1009}" for k in range(60)) + " " + " ".join(["same"] * 90)
    texts = [(i, " ".join(f"x{i}y{k}" for k in range(12)) + " " + shared + " " + "ä" * (70_000 if i == 2 else 3) + f" z{i}") for i in range(4)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    once = sorted(map(tuple, substring_dedup.repeats(docs).collect()))
    monkeypatch.setattr(substring_dedup, "WORDS", 2)
    monkeypatch.setattr(substring_dedup, "MOST_WORDS", 8)
    assert sorted(map(tuple, substring_dedup.repeats(docs).collect())) == once
    found = {r[0]: texts[r[0]][1][r[1]: r[2]] for r in once}
    # No repeated piece of the third document begins before its first shared word.
    assert found == {i: shared[3:] if i == 2 else shared + " äää" for i in range(4)}


def test_equal_sets_of_a_key_are_places_only(spark):
    names = "key long, n int, set long, id long, start int, end int"
    rows = [(1, 5, 10, 1, 0, 9), (1, 5, 10, 2, 0, 9), (2, 5, 10, 1, 0, 9), (2, 6, 11, 3, 4, 9), (3, 5, 12, 4, 0, 9)]
    met = substring_dedup._collisions(spark.createDataFrame(rows, names)).collect()
    assert sorted((r["set"], r["id"], r["start"], r["end"], r["differ"]) for r in met) == [
        (10, 1, 0, 9, False), (10, 1, 0, 9, True), (10, 2, 0, 9, False), (11, 3, 4, 9, True)]
    assert {(r["key"], r["near"], r["nearer"], r["before"]) for r in met if not r["differ"]} == {(None,) * 4}
    assert all(None not in (r["key"], r["near"], r["nearer"], r["before"]) for r in met if r["differ"])


def test_pieces_are_dealt_without_a_set_of_their_own(spark):
    rng = random.Random(5)
    words = lambda n: " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(n))
    passage = words(80)
    docs = spark.createDataFrame([(i, f"{words(20)} {passage} {words(20)}") for i in range(3)], "id long, text string")
    rows = substring_dedup._rows(docs, *substring_dedup.tune())
    ids = {}
    for r in rows.filter("set = 0").collect():
        ids.setdefault(r["key"], set()).add(r["id"])
    shared = {k for k, v in ids.items() if len(v) > 1}
    found = substring_dedup._collisions(rows).collect()
    assert shared and {r["set"] for r in found if not r["differ"]} == shared
    assert all(r["set"] for r in found)


def test_later_rounds_move_only_texts_that_go_on(spark, monkeypatch):
    rng = random.Random(21)
    short, long = words(rng, 60), words(rng, 60) + " same" * 90
    docs = spark.createDataFrame([(i, f"{words(rng, 12)} {long if i < 2 else short} {words(rng, 12)}") for i in range(12)], "doc_id long, text string")
    moved, beyond = [], substring_dedup._beyond
    monkeypatch.setattr(substring_dedup, "WORDS", 2)
    monkeypatch.setattr(substring_dedup, "MOST_WORDS", 32)
    monkeypatch.setattr(substring_dedup, "_beyond", lambda texts, *a: moved.append(sorted(r["id"] for r in texts.select("id").collect())) or beyond(texts, *a))
    found = substring_dedup.repeats(docs).collect()
    assert {r["doc_id"] for r in found} == set(range(12))
    assert len(moved) > 3 and moved[0] == list(range(12)) and moved[-1] == [0, 1]


def test_tables_of_steps_that_are_done_are_deleted(spark, corpus, monkeypatch):
    from pathlib import Path

    folder, there = [], []
    settle, extended = substring_dedup.settle, substring_dedup._extended

    def settled(df, *a):
        table = settle(df, *a)
        folder.append(Path(table.inputFiles()[0].removeprefix("file:")).parent)
        return table

    monkeypatch.setattr(substring_dedup, "settle", settled)
    monkeypatch.setattr(substring_dedup, "_extended", lambda *a: there.extend(f.exists() for f in folder) or extended(*a))
    assert substring_dedup.repeats(corpus[0]).count()
    assert sum(there) == 1 and there[-1]  # the units
