"""Whitening of vectors by Jacobi-Davidson on a covariance that is never formed.

Vectors are scaled to whole numbers, ``x = floor(scale * c) + shift``, and each distinct one counts once (the fit list, a written
table). The largest eigenpairs of its covariance come from a block Jacobi-Davidson iteration: all that is asked of the data is the
product of the covariance with a few columns, one Spark pass that centres rows exactly (whole numbers less the whole mean, then
less the fraction) before it multiplies. Corrections solve the projected equation by a few MINRES steps for all open pairs at once,
a Rayleigh-Ritz step extracts pairs from the search space, and pairs whose residual has reached double precision are locked from
the top on. The driver holds ``dimensions x search space`` numbers, never a row of the table.

Rows whose vector is null, empty, holds null or non-finite entries, or has another length than most (ties: the longer) take no part.
Entries beyond 2^46 / scale count as that bound. Repeated vectors change nothing but their own rows. Components without variance
(equal vectors, fewer vectors than dimensions, an empty table) do not exist: lists are shorter. Columns that have the name
of an output are replaced, others pass through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsentry.llm.common import free_name, settle

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
#: Columns of the first search space beyond the wanted ones.
GUARDS = 4
#: The search space is cut back to its best part when it would outgrow this many columns for each wanted one.
BASIS = 4
MINRES_STEPS = 6
#: A correction is good enough when its residual has fallen to this share.
MINRES_SHARE = 0.05
ROUNDS = 200
#: Residuals stop at this many units of rounding of the largest eigenvalue, or where rounding alone keeps them below FLOOR.
UNITS = 4.0
FLOOR = 1e-12
BOUND = float(1 << 46)


def scaled(vector: Column, scale: float = SCALE, shift: int = SHIFT) -> Column:
    """The whole numbers of a usable vector, null for any other."""
    whole = F.transform(vector, lambda c: F.floor(F.greatest(F.least(c.cast("double") * F.lit(float(scale)), F.lit(BOUND)), F.lit(-BOUND)))
                        + F.lit(shift).cast("long"))
    usable = (F.size(vector) > 0) & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    return F.when(usable, whole)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


@dataclass
class Centre:
    """n rows with sums S = n * whole + rest, entry by entry: centred rows are exact up to one rounding."""

    n: int
    sums: list[int]

    def __post_init__(self):
        self.whole = np.array([s // self.n for s in self.sums], np.int64)
        self.rest = [s % self.n for s in self.sums]
        self.fraction = np.array([r / self.n for r in self.rest])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.fraction

    def deviations(self, x: np.ndarray) -> list[int]:
        """The exact sum over the entries of (n x - S)^2 of each row."""
        off = x - self.whole
        if len(x) and self.n * (float(np.abs(off).max()) + 1) < 2.0 ** 31 / np.sqrt(2 * x.shape[1]):
            away = self.n * off - np.array(self.rest, np.int64)
            return (away * away).sum(axis=1).tolist()
        away = self.n * off.astype(object) - np.array(self.rest, object)
        return (away * away).sum(axis=1).tolist() if len(x) else []


def _summed(table: DataFrame, shape: tuple[int, ...], part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``part(rows)`` over the blocks of the table, an array of ``shape``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                total += part(_matrix(batch.column("x")))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["cell", "v"])

    out = np.zeros(int(np.prod(shape)))
    for r in table.mapInArrow(run, "cell long, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect():
        out[r["cell"]] = r["v"]
    return out.reshape(shape)


def _orthonormal(vectors: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``vectors`` add to the orthonormal columns ``against``."""
    out = np.zeros((len(vectors), 0))
    for v in vectors.T:
        size = np.linalg.norm(v)
        if not size:
            continue
        v = v / size
        for _ in range(3):
            v = v - against @ (against.T @ v)
            v = v - out @ (out.T @ v)
            left = np.linalg.norm(v)
            if left < 1e-10:
                break
            v = v / left
        else:
            out = np.column_stack([out, v])
    return out


def _corrections(apply, vectors: np.ndarray, values: np.ndarray, residuals: np.ndarray, known: np.ndarray, steps: int) -> np.ndarray:
    """For each column: t orthogonal to ``known`` with (I - QQ')(V - value)(I - QQ') t = -residual, by MINRES.

    The Lanczos bases of all columns grow side by side, one product a step; MINRES minimises each small tridiagonal residual.
    """
    q = np.column_stack([known, vectors])
    project = lambda t: t - q @ (q.T @ t)
    b = project(project(-residuals))
    beta = np.linalg.norm(b, axis=0)
    basis = [b / np.where(beta > 0, beta, 1)]
    columns = b.shape[1]
    small = np.zeros((columns, steps + 1, steps))
    answers = np.zeros_like(b)
    for k in range(steps):
        w = project(apply(basis[k]) - basis[k] * values)
        if k:
            w -= basis[k - 1] * small[:, k, k - 1]
        small[:, k, k] = np.einsum("ij,ij->j", w, basis[k])
        w -= basis[k] * small[:, k, k]
        for v in basis:  # rounding must not let a basis lose its right angles
            w -= v * np.einsum("ij,ij->j", v, w)
        size = np.linalg.norm(w, axis=0)
        small[:, k + 1, k] = size
        if k + 1 < steps:
            small[:, k, k + 1] = size
        basis.append(w / np.where(size > 0, size, 1))
        worst = 0.0
        for j in range(columns):
            right = np.zeros(k + 2)
            right[0] = beta[j]
            y = np.linalg.lstsq(small[j, : k + 2, : k + 1], right, rcond=1e-14)[0]
            answers[:, j] = sum(basis[i][:, j] * y[i] for i in range(k + 1))
            if beta[j]:
                worst = max(worst, float(np.linalg.norm(right - small[j, : k + 2, : k + 1] @ y)) / beta[j])
        if worst <= MINRES_SHARE:
            break
    return project(answers)


def eigenpairs(apply: Callable[[np.ndarray], np.ndarray], size: int, k: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, their unit vectors and residual norms, of a symmetric operator of ``size``."""
    k = min(k, size)
    start = np.random.default_rng(seed).standard_normal((size, min(size, k + GUARDS)))
    locked, images, values, norms = np.zeros((size, 0)), np.zeros((size, 0)), [], []
    space = _orthonormal(start, locked)
    moved = apply(space)
    before = np.full(0, np.inf)
    for _ in range(ROUNDS):
        moved = moved - locked @ (locked.T @ moved)
        small = space.T @ moved
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(-theta, kind="stable")
        theta, turn = theta[order], turn[:, order]
        ritz, image = space @ turn, moved @ turn
        away = image - ritz * theta
        size_of = np.linalg.norm(away, axis=0)
        largest = max([*values, *np.abs(theta[:1])], default=0.0)
        tiny = UNITS * np.finfo(float).eps * np.sqrt(size) * largest
        still = np.ones(len(theta), bool)
        m = min(len(before), len(theta))
        still[:m] = size_of[:m] > 0.5 * before[:m]
        still[m:] = False
        whole = len(theta) + locked.shape[1] >= size
        done = (size_of <= tiny) | ((size_of <= FLOOR * largest) & (still | whole))
        lead = int(np.argmin(done)) if not done.all() else len(done)
        # Of the open pairs only those above the wanted number of locked ones are needed.
        take = min(lead, max(k - len(values), int((theta > min(values, default=np.inf)).sum())))
        if take:
            locked, images = np.column_stack([locked, ritz[:, :take]]), np.column_stack([images, image[:, :take]])
            values += theta[:take].tolist()
            norms += size_of[:take].tolist()
            ritz, image, theta, size_of, away = ritz[:, take:], image[:, take:], theta[take:], size_of[take:], away[:, take:]
        if len(values) >= k and not (theta > min(values)).any():
            break
        if not len(theta):
            space = _orthonormal(np.random.default_rng(seed + 1).standard_normal((size, k)), locked)
            moved, before = apply(space), np.full(0, np.inf)
            continue
        open_pairs = np.flatnonzero(size_of[: max(k - len(values), 1)] > tiny)
        if not len(open_pairs):
            open_pairs = np.arange(1)
        room = BASIS * k
        space, moved, before = ritz, image, size_of
        if space.shape[1] + len(open_pairs) > room and locked.shape[1] + space.shape[1] < size:
            keep = max(k - len(values) + GUARDS, room // 2)
            space, moved, before = space[:, :keep], moved[:, :keep], before[:keep]
        steps = MINRES_STEPS if not whole else 1
        found = _corrections(apply, ritz[:, open_pairs], theta[open_pairs], away[:, open_pairs], locked, steps)
        more = _orthonormal(found, np.column_stack([locked, space]))
        if more.shape[1]:
            space, moved = np.column_stack([space, more]), np.column_stack([moved, apply(more)])
    else:
        raise RuntimeError("the eigenpairs did not reach double precision")
    order = np.argsort(-np.array(values), kind="stable")[:k]
    return np.array(values)[order], locked[:, order], np.array(norms)[order]


@dataclass
class Whitening:
    """What ``fit`` learned: exact mean, eigenvalues and unit vectors, their residuals, trace and identity error."""

    centre: Centre | None
    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    trace: float
    identity_error: float
    passes: int

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace if len(self.values) else self.values

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return centred @ (self.vectors / np.sqrt(self.values))


def usable(df: DataFrame, name: str, vector: str = "embedding", scale: float = SCALE, shift: int = SHIFT) -> tuple[DataFrame, int]:
    """The rows that take part, with their whole numbers in the new column ``name``, and the vectors' length (0 without rows)."""
    rows = df.withColumn(name, scaled(F.col(vector), scale, shift)).filter(F.col(name).isNotNull())
    lengths = rows.groupBy(F.size(name).alias("d")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), F.desc("d")).first()
    length = lengths["d"] if lengths else 0
    return rows.filter(F.size(name) == length), length


def fit(rows: DataFrame, length: int, name: str = "x", components: int = COMPONENTS) -> Whitening:
    """Learn from the distinct whole-number vectors ``name`` of ``rows``, all of ``length`` entries."""
    none = Whitening(None, np.zeros(0), np.zeros((length, 0)), np.zeros(0), 0.0, 0.0, 0)
    if not length:
        return none
    table = settle(rows.select(F.col(name).alias("x")).distinct())

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("x"))
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(length + 1)), pa.array(np.append(x.sum(axis=0), len(x)))], names=["cell", "v"])

    sums = {r["cell"]: int(r["v"]) for r in table.mapInArrow(totals, "cell long, v long").groupBy("cell").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()}
    centre = Centre(sums[length], [sums[i] for i in range(length)])
    passes = 0

    def apply(columns: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1

        def part(x: np.ndarray) -> np.ndarray:
            c = centre.centred(x)
            return c.T @ (c @ columns)

        return _summed(table, columns.shape, part) / centre.n

    trace = float(_summed(table, (1,), lambda x: np.array([(centre.centred(x) ** 2).sum()]))[0]) / centre.n
    if not trace:
        none.centre = centre
        return none
    values, vectors, residuals = eigenpairs(apply, length, components)
    some = values > 8 * length * np.finfo(float).eps * values[0]
    model = Whitening(centre, values[some], vectors[:, some], residuals[some], trace, 0.0, passes)
    k = len(model.values)

    def moments(x: np.ndarray) -> np.ndarray:
        y = model.whitened(centre.centred(x))
        return np.vstack([y.T @ y, y.sum(axis=0)])

    both = _summed(table, (k + 1, k), moments) / centre.n
    model.identity_error = float(np.abs(both[:k] - np.outer(both[k], both[k]) - np.eye(k)).max())
    return model


def whiten(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS, scale: float = SCALE, shift: int = SHIFT) -> DataFrame:
    """The rows that take part, with ``n``, ``deviation`` (null beyond a long), ``whitened``, ``explained`` and ``identity_error``.

    ``whitened`` and ``explained`` list the components by falling eigenvalue.
    """
    df = df.drop("n", "deviation", "whitened", "explained", "identity_error")
    name = free_name(df.columns, "x")
    rows, length = usable(df, name, vector, scale, shift)
    model = fit(rows, length, name, components)
    shared = rows.sparkSession.sparkContext.broadcast(model)
    kept = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        k = len(m.values)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(name))
            lists = lambda v: pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * k, pa.int32()), pa.array(v.ravel()))
            away = [v if v < 1 << 63 else None for v in m.centre.deviations(x)]
            y = m.whitened(m.centre.centred(x)) if k else np.zeros((len(x), 0))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(np.full(len(x), m.centre.n)), pa.array(away, pa.int64()), lists(y),
                 lists(np.broadcast_to(m.explained, y.shape)), pa.array(np.full(len(x), m.identity_error))],
                names=[*kept, "n", "deviation", "whitened", "explained", "identity_error"])

    fields = "".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}, " for f in df.schema)
    return rows.mapInArrow(run, f"{fields}n long, deviation long, whitened array<double>, explained array<double>, identity_error double")
