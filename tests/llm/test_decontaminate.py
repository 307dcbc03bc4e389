import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rowsentry.llm import decontaminate


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnoprstuvé") for _ in range(rng.randint(2, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def items():
    rng = random.Random(1)
    return [(i, words(rng, 12 + 3 * i)) for i in range(12)] + [(50, None), (51, ""), (52, "short"), (53, "tiny words")]


@pytest.fixture(scope="module")
def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def edited(rng, text, share):
    out = list(text)
    for _ in range(int(len(out) * share)):
        at = rng.randrange(len(out))
        out[at: at + 1] = rng.choice(["x", "", out[at] + "y"])
    return "".join(out)


def test_copies_near_copies_and_clean_texts(spark, items, benchmark):
    rng = random.Random(2)
    rows, want = [], {}
    for k in range(60):
        item, text = items[k % 12]
        kind = k % 4
        body = {0: text.upper(), 1: text.replace(" ", " \n\t"), 2: edited(rng, text, 0.04), 3: words(rng, 30)}[kind]
        rows.append((k, f"{words(rng, 20)} {body} {words(rng, 20)}", "clash"))
        want[k] = [] if kind == 3 else [item]
    found = decontaminate.find(spark.createDataFrame(rows, "doc_id int, text string, benchmark_items string"), benchmark).collect()
    assert {r["doc_id"]: [m["item_id"] for m in r["benchmark_items"]] for r in found} == want
    text = dict(items)
    for r in found:
        for m in r["benchmark_items"]:
            if r["doc_id"] % 4 == 1:
                assert r["text"][m["start"]: m["end"]].split() == text[m["item_id"]].split() and m["edits"] == 0


def test_part_of_a_long_item_is_enough(spark, items, benchmark):
    part = items[11][1][40:230]
    found = decontaminate.find(spark.createDataFrame([(f"before {part} after",)], "text string"), benchmark).first()
    assert [m["item_id"] for m in found["benchmark_items"]] == [11]


def test_defined_results(spark, items, benchmark):
    whole = items[3][1]
    texts = [None, "", "short", whole, whole, "z" * 200_000 + " " + whole, f"{whole} {whole}"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r["doc_id"]: [m["item_id"] for m in r["benchmark_items"]] for r in decontaminate.find(df, benchmark).collect()}
    assert got == {0: [], 1: [], 2: [], 3: [3], 4: [3], 5: [3], 6: [3]}
    twice = spark.createDataFrame([(1, whole), (2, whole)], "item_id long, text string")
    assert [m["item_id"] for m in decontaminate.find(df.filter("doc_id = 3"), twice).first()["benchmark_items"]] == [1, 2]
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(r["benchmark_items"] == [] for r in decontaminate.find(df, none).collect())
    assert decontaminate.find(df.filter(F.lit(False)), benchmark).count() == 0


def test_slices_of_a_large_benchmark(spark, items, benchmark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SLICE_CHARACTERS", 100)
    df = spark.createDataFrame([(" - ".join(t for _, t in items[:6]),)], "text string")
    assert [m["item_id"] for m in decontaminate.find(df, benchmark).first()["benchmark_items"]] == [0, 1, 2, 3, 4, 5]


def test_alignment_is_the_edit_distance():
    rng = np.random.default_rng(4)
    for _ in range(30):
        pattern, text = rng.integers(0, 3, 12), rng.integers(0, 3, 20)
        row = np.zeros(21, int)
        for p in pattern:  # any start, any end
            new = np.empty(21, int)
            new[0] = row[0] + 1
            for j in range(1, 21):
                new[j] = min(row[j - 1] + (p != text[j - 1]), row[j] + 1, new[j - 1] + 1)
            row = new
        cost, _ = decontaminate.align(pattern[None].astype(np.uint32), text[None].astype(np.uint32))
        assert cost[0] >= row.min() and (row.min() > 2 or cost[0] == row.min() or row.argmin() < 12)


def test_places_of_normal_characters():
    points, offsets, place, lengths = decontaminate.normal(pa.array(["A  b\n\nC", None, " É"]))
    assert "".join(map(chr, points)) == "a b c é" and offsets.tolist() == [0, 5, 5, 7]
    assert place.tolist() == [0, 1, 3, 4, 6, 0, 1] and lengths.tolist() == [7, 0, 2]
