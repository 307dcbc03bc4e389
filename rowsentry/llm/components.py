"""Connected components by alternating large and small stars, one shuffle of plain node ids each."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsentry.llm.common import settle

MAX_ROUNDS = 60


def _least_first(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows sorted by ``a, b``, repeats left out: a, b, the least b of the same a, and whether the row is that first one.

    Nothing but the last row's values is held from batch to batch, so a node may have any number of neighbours.
    """
    last_a = last_b = least = None
    for batch in batches:
        a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
        if not len(a):
            continue
        opens = np.ones(len(a), bool)
        opens[1:] = a[1:] != a[:-1]
        new = opens.copy()
        new[1:] |= b[1:] != b[:-1]
        if last_a is not None and a[0] == last_a:
            opens[0], new[0] = False, b[0] != last_b
        at = np.maximum.accumulate(np.where(opens, np.arange(len(a)), -1))
        m = np.where(at >= 0, b[np.maximum(at, 0)], least if least is not None else 0)
        last_a, last_b, least = a[-1], b[-1], m[-1]
        yield a[new], b[new], m[new], opens[new]


def _edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node moves to the node's smallest neighbour, or to the node if that is smaller."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, b, least, _ in _least_first(batches):
            above = b > a
            yield _edges(b[above], np.minimum(least, a)[above])

    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.repartition("a").sortWithinPartitions("a", "b").mapInArrow(run, "a long, b long")


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below it move to the smallest of them. ``edges``: a > b."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, b, least, first in _least_first(batches):
            yield _edges(np.where(first, a, b), least)

    return edges.repartition("a").sortWithinPartitions("a", "b").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (two long columns): the root is the smallest node it is connected with.

    Rounds repeat until no edge moves. A node with any number of neighbours is streamed, never held in a task's memory.
    """
    a, b = links.columns
    edges = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b")
    seen = None
    for _ in range(MAX_ROUNDS):
        edges = settle(_small_star(_large_star(edges)))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen or not now[0]:
            nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root")).distinct()
            return nodes.unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = now
    raise RuntimeError("the components did not settle")
