"""Shared helpers: written tables, Arrow batches in bounded pieces, words and shingles as hashes."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

#: Text bytes that one numpy step works on; one longer text is a step of its own.
PIECE_BYTES = 1 << 20
MASK64 = (1 << 64) - 1


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``; its own folder only in a local session that names none."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is unset; name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def settle(df: DataFrame, batch_rows: int | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: later steps start there, also after lost executors.

    ``batch_rows`` bounds the Arrow batches of this write, for rows that hold whole sets.
    """
    spark, path = df.sparkSession, shared_folder(df.sparkSession)
    before = spark.conf.get(_BATCH_ROWS, None)
    try:
        if batch_rows:
            spark.conf.set(_BATCH_ROWS, str(batch_rows))
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if batch_rows and before is not None:
            spark.conf.set(_BATCH_ROWS, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete the files of settled tables that no later step reads."""
    for table in tables:
        jvm, conf = table.sparkSession.sparkContext._jvm, table.sparkSession.sparkContext._jsc.hadoopConfiguration()
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def drop_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps that are done: it does so when the driver collects its garbage."""
    spark.sparkContext._jvm.System.gc()


def release() -> None:
    """Give freed memory back to the system: a Python worker lives on, and its next task may be another operator's."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library has it
        pass


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``limit`` text bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(size, dtype=np.int64) // limit
        cuts = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield batch.slice(a, b - a)
    release()


#: Text bytes of a block of documents that one task answers as a whole (one longer text is a block of its own).
BLOCK = 4 << 20


def in_blocks(df: DataFrame, column: str, name: str, limit: int = BLOCK) -> DataFrame:
    """Add a block number: rows that follow each other, up to about ``limit`` text bytes. Settle the result, then the numbers stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, held = TaskContext.get().partitionId() << 32, 0
        for piece in pieces(batches, column):
            size = pc.fill_null(pc.binary_length(piece.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1
            total = held + np.cumsum(size)
            held = int(total[-1])
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(base + (total - 1) // limit)], names=[*piece.schema.names, name])

    fields = "".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}, " for f in df.schema)
    return df.mapInArrow(run, f"{fields}`{name}` long")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and the offsets of each; nulls are empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, … modulo 2^64, kept for the worker's next batches."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        grown = np.full(size, base, np.uint64)
        grown[0] = 1
        _POWERS[base] = have = np.cumprod(grown, dtype=np.uint64)
    return have[:n]


def byte_codes(lower: bool) -> np.ndarray:
    """A fixed 64-bit code for each byte; with ``lower``, A-Z have those of a-z."""
    codes = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
    if lower:
        codes[65:91] = codes[97:123]
    return codes


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = byte_codes(True)
_PLACES = [pow(0xD6E8FEB86659FD93, k + 1, 1 << 64) for k in range(64)]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words between ASCII white space, and the place of each text's first word."""
    return runs(~SPACE[data], offsets)


def runs(word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of set flags within each text, and the place of each text's first run."""
    before = np.empty_like(word)
    before[1:] = word[:-1]
    after = np.empty_like(word)
    after[:-1] = word[1:]
    edges = offsets[:-1][offsets[:-1] < len(word)]
    before[edges] = False
    if len(word):
        after[-1] = False
        after[edges[edges > 0] - 1] = False
    starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray = _LOWER) -> np.ndarray:
    """A 64-bit hash of each byte span, whatever its place."""
    return run_hashes(codes[data], starts, ends)


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of 64-bit values, whatever its place."""
    return run_sums(values)(starts, ends)


def run_sums(values: np.ndarray) -> Callable[[np.ndarray, np.ndarray | slice], np.ndarray]:
    """``run_hashes`` of the same values for several sets of runs."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(_BASE, len(values)), out=total[1:], dtype=np.uint64)
    inverse = powers(_BASE_INVERSE, len(values) + 1)
    return lambda starts, ends: mix((total[ends] - total[starts]) * inverse[starts])


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words and the place of each text's first; shorter texts have one, of all words.

    ``bounds`` are the places of the texts' first words, the end last. Texts without words have none.
    """
    n = np.diff(bounds)
    count = np.where(n == 0, 0, np.maximum(n - width + 1, 1))
    out = np.zeros(len(bounds), np.int64)
    np.cumsum(count, out=out[1:])
    first = np.repeat(bounds[:-1] - out[:-1], count) + np.arange(out[-1])
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    size = np.repeat(np.minimum(n, width), count)
    sums = size.astype(np.uint64)
    for k in range(width):
        sums = sums + np.where(k < size, padded[first + k], np.uint64(0)) * np.uint64(_PLACES[k])
    return mix(sums), out


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, … of each run, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def free_name(columns: list[str], name: str) -> str:
    """``name``, or with underscores added a name that the columns do not have yet."""
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name


def out_batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c := columns[f.name], pa.Array) else pa.array(c, f.type) for f in schema], schema=schema)
