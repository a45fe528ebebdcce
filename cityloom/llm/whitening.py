"""Whitening of vectors by singular values and directions found with the qd family of algorithms.

Entries are taken in fixed point, so that sums and deviations are whole numbers and exact in any order of the rows.
Blocks of centred rows are reduced to triangles by QR and the triangles to one, in rounds; no covariance is formed.
On the driver is then one triangle, as wide as a vector: Householder reflections make it bidiagonal, dqds finds its
singular values to high relative accuracy, and twisted factorisations of the bidiagonal product give the directions.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import materialise, ship
from .vectors import dimension

# Rows that are reduced at once, and partial results that one task puts together in a round.
BLOCK_ROWS, FAN_IN = 4_096, 16
# Singular values below this share of the largest are taken as zero: their directions hold rounding errors only.
ZERO = 1e-12
# Eigenvalues whose relative gap is smaller have their directions made orthogonal explicitly.
CLUSTER = 1e-3
_EPS = float(np.finfo(float).eps)


@dataclass(frozen=True)
class Whitening:
    """What a fit gives: number of rows, whole sums per dimension, eigenvalues of the covariance (falling) with their
    directions as columns, and the covariance's trace."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    directions: np.ndarray
    trace: float
    scale: int
    offset: int

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace if self.trace else self.values


def finite(vec: Column) -> Column:
    """Not null, not empty, no entry null, NaN or infinite."""
    each = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vec) > 0) & each, F.lit(False))


def _kept(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    vec = F.col(f"`{vector_col}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), vec.alias("vec")).filter(finite(F.col("vec")))
    size = dimension(rows)
    return rows.filter(F.size("vec") == size), size


def _whole(batch: pa.RecordBatch, size: int, scale: int, offset: int) -> np.ndarray:
    """The vectors of a batch in fixed point, a row each."""
    return np.floor(batch.column("vec").flatten().to_numpy().reshape(-1, size) * scale).astype(np.int64) + offset



# Partial results, one per partition, put together in rounds


def _gather(rows: DataFrame, partial: Callable[[Iterator[pa.RecordBatch]], np.ndarray | None],
            combine: Callable[[list[np.ndarray]], np.ndarray], label: str) -> np.ndarray | None:
    """What ``combine`` makes of the partial results of all partitions (None: no rows), ``FAN_IN`` at a time in rounds
    that are written; one array reaches the driver."""
    kind = "part int, value array<double>"

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = partial(batches)
        if made is not None:
            yield pa.RecordBatch.from_pydict({"value": [made]})

    def merge(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        made = combine([v.values.to_numpy() for v in table["value"]])
        return pa.table({"part": pa.array([table["to"][0].as_py()], pa.int32()), "value": [made]})

    parts = rows.mapInArrow(first, "value array<double>").select(F.spark_partition_id().alias("part"), "value")
    parts = materialise(parts, label)
    most = parts.agg(F.max("part")).first()[0]
    if most is None:
        return None
    while most:
        to = (F.col("part") / FAN_IN).cast("int").alias("to")
        parts = materialise(parts.select("part", "value", to).groupBy("to").applyInArrow(merge, kind), label)
        most //= FAN_IN
    return combine([np.array(r["value"]) for r in parts.collect()])  # one row


def _triangle(stacked: np.ndarray) -> np.ndarray:
    """The triangular factor of a QR factorisation, with as many rows as columns."""
    r = np.linalg.qr(stacked, mode="r")
    return np.vstack((r, np.zeros((max(0, r.shape[1] - len(r)), r.shape[1]))))


# Singular values and directions of a triangle


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and upper diagonal of a bidiagonal matrix with the singular values of the square ``r``, and the
    orthogonal matrix that takes its right singular vectors to those of ``r``."""
    a = np.array(r, float)
    d = len(a)
    right = np.eye(d)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        size = np.linalg.norm(x)
        if size == 0 or not np.any(x[1:]):
            return None
        v = x.copy()
        v[0] += math.copysign(size, x[0])
        return v / np.linalg.norm(v)

    for k in range(d):
        if (v := reflector(a[k:, k])) is not None:
            a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k + 2 < d and (v := reflector(a[k, k + 1 :])) is not None:
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
            right[:, k + 1 :] -= 2 * np.outer(right[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float, bool]:
    """One differential qd transform with a shift: the new arrays, the least of the differences, and whether that is
    the last one."""
    d = q[0] - shift
    least, last = d, len(q) == 1
    new_q, new_e = [], []
    for i in range(len(e)):
        up = d + e[i]
        t = q[i + 1] / up if up else 0.0
        new_q.append(up)
        new_e.append(e[i] * t)
        d = d * t - shift
        if d < least:
            least, last = d, i == len(e) - 1
    new_q.append(d)
    return new_q, new_e, least, last


def dqds(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Singular values of an upper bidiagonal matrix, falling. It is parted where the upper diagonal is next to
    nothing; in each part values leave at the lower end once the coupling above them no longer changes them, and a
    shift that makes a difference negative is taken back and lessened."""
    top = max(float(np.abs(diagonal).max(initial=0)), float(np.abs(upper).max(initial=0)))
    if top == 0:
        return np.zeros(len(diagonal))
    q, e = (diagonal / top) ** 2, (upper / top) ** 2
    parted = np.flatnonzero(e <= _EPS**2 * np.minimum(q[:-1], q[1:])) + 1
    found = [x for a, b in zip([0, *parted], [*parted, len(q)], strict=True) for x in _dqds_part(q[a:b].tolist(), e[a : b - 1].tolist())]
    return np.sqrt(np.sort(np.maximum(found, 0.0))[::-1]) * top


def _dqds_part(q: list[float], e: list[float]) -> list[float]:
    """Squared singular values of one part, from the squares of its diagonals."""
    tiny = (10 * _EPS) ** 2
    found: list[float] = []
    total, lost, rounds = 0.0, 0.0, 100 * len(q) + 100  # sum of the shifts, and what it leaves out
    if q[-1] > 1.5 * q[0]:  # small values are to come last
        q, e = q[::-1], e[::-1]
    while q:
        n = len(q)
        if n == 1 or e[-1] <= tiny * (total + q[-1]) or e[-1] <= tiny * _EPS * q[-2]:
            found.append(total + (q.pop() + lost))
            if e:
                e.pop()
            continue
        # The smaller eigenvalue of the last two rows of the product is the aim.
        a, c = q[-2] + (e[-2] if n > 2 else 0.0), q[-1] + e[-1]
        b2 = q[-2] * e[-1]
        half = (a - c) / 2
        shift = max(0.0, c - b2 / (half + math.copysign(math.hypot(half, math.sqrt(b2)), half))) if b2 else 0.0
        shift = min(shift, q[-1])
        for attempt in range(6):
            new_q, new_e, least, last = _sweep(q, e, shift)
            if least >= 0 or shift == 0:
                break
            shift = max(0.0, shift + least) if last and attempt == 0 else (shift / 4 if attempt < 4 else 0.0)
        q, e = [max(x, 0.0) for x in new_q], new_e
        # Compensated sum, as small values rest on many shifts.
        y = shift + lost
        t = total + y
        lost = y - (t - total)
        total = t
        rounds -= 1
        if not rounds:
            raise ArithmeticError("the qd sweeps do not settle")
    return found


def twisted_vectors(diagonal: np.ndarray, upper: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit right singular vectors (columns) of an upper bidiagonal matrix for its singular values (falling).

    For each value the product of the matrix with itself, less the squared value, is factored from above and from
    below; joined where the two factorisations come closest to a singular pivot, they give the vector by products
    alone. Vectors of values next to each other are then made orthogonal, with another start where little is left.
    """
    d, m = len(diagonal), len(values)
    top = float(max(np.abs(diagonal).max(initial=0), np.abs(upper).max(initial=0))) or 1.0
    diagonal, upper, lam = diagonal / top, upper / top, (values / top) ** 2
    q, e, ld = diagonal**2, upper**2, upper * diagonal[:-1]
    floor = np.full(m, _EPS**2)

    def safe(x: np.ndarray) -> np.ndarray:
        return np.where(np.abs(x) < floor, np.where(x < 0, -floor, floor), x)

    down, up = np.empty((d, m)), np.empty((d, m))
    s, p = np.empty((d, m)), np.empty((d, m))
    s[0] = -lam
    for i in range(d):
        down[i] = safe(q[i] + s[i])
        if i + 1 < d:
            s[i + 1] = e[i] * s[i] / down[i] - lam
    p[d - 1] = q[d - 1] - lam
    for i in range(d - 2, -1, -1):
        up[i + 1] = safe(e[i] + p[i + 1])
        p[i] = p[i + 1] * q[i] / up[i + 1] - lam
    twist = np.abs(s + p + lam).argmin(axis=0)
    z = np.zeros((d, m))
    z[twist, np.arange(m)] = 1.0
    for i in range(d - 2, -1, -1):
        z[i] = np.where(i < twist, -(ld[i] / down[i]) * z[i + 1], z[i])
    for i in range(1, d):
        z[i] = np.where(i > twist, -(ld[i - 1] / up[i]) * z[i - 1], z[i])
    z /= np.linalg.norm(z, axis=0)

    main, side = q + np.concatenate(([0.0], e)), ld
    random = np.random.default_rng(0)

    def solve(shift: float, rhs: np.ndarray) -> np.ndarray:
        full = np.diag(main - shift) + np.diag(side, 1) + np.diag(side, -1)
        full[np.diag_indices(d)] += _EPS * (2 + 4 * random.random(d))  # near singular, not singular
        return np.linalg.solve(full, rhs)

    begin = 0
    for j in range(1, m):
        if lam[j - 1] - lam[j] > CLUSTER * lam[j - 1]:
            begin = j
            continue
        near = z[:, begin:j]
        for attempt in range(5):
            size = 1.0
            for _ in range(2):
                z[:, j] -= near @ (near.T @ z[:, j])
                size = min(size, float(np.linalg.norm(z[:, j])))
                z[:, j] /= np.linalg.norm(z[:, j]) or 1.0
            if size > 0.1:
                break
            start = random.standard_normal(d)
            for _ in range(3):
                start -= near @ (near.T @ start)
                start = solve(float(lam[j]), start)
                start /= np.linalg.norm(start)
            z[:, j] = start
    return z


# The operator


def fit(
    vectors: DataFrame, *, components: int = 32, scale: int = 64, offset: int = 1_000_000, id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> Whitening | None:
    """Learn the whitening of all vectors; None if there are none that take part.

    Vectors that are null, empty or hold null, NaN or infinite entries take no part, nor do those of another length than
    the commonest (the smaller one of a tie); zero vectors and repeated rows count like any other. An entry ``c``
    becomes the whole number ``floor(scale * c) + offset``. The covariance has the number of rows as divisor.
    Directions without any spread (singular values below ``ZERO`` of the largest) are no components, so there may be
    fewer than ``components``.
    """
    ship(vectors.sparkSession)
    rows, size = _kept(vectors, id_col, vector_col)
    if not size:
        return None
    rows = rows.select("vec")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(size, np.int64)
        for batch in batches:
            n, sums = n + len(batch), sums + _whole(batch, size, scale, offset).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_pydict({"at": np.arange(-1, size), "s": np.concatenate(([n], sums))})

    found = dict(rows.mapInArrow(add, "at long, s long").groupBy("at").agg(F.sum("s")).collect())  # one row a dimension
    n, sums = found[-1], np.array([found[i] for i in range(size)], np.int64)

    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        r = None
        for batch in batches:
            whole = _whole(batch, size, scale, offset)
            for i in range(0, len(whole), BLOCK_ROWS):
                block = (whole[i : i + BLOCK_ROWS] * n - sums) / n
                r = _triangle(block if r is None else np.vstack((r, block)))
        return None if r is None else r.ravel()

    flat = _gather(rows, reduce_rows, lambda parts: _triangle(np.vstack([p.reshape(-1, size) for p in parts])).ravel(), "whitening-r")
    r = flat.reshape(size, size)
    diagonal, upper, right = bidiagonalise(r)
    values = dqds(diagonal, upper)
    m = min(components, int((values > ZERO * values[0]).sum())) if values[0] > 0 else 0
    directions = right @ twisted_vectors(diagonal, upper, values[:m])
    return Whitening(n, sums, values[:m] ** 2 / n, directions, float((values**2).sum()) / n, scale, offset)


def _apart(batch: pa.RecordBatch, model: Whitening) -> np.ndarray:
    """n * x - S, exactly."""
    return _whole(batch, len(model.sums), model.scale, model.offset) * model.n - model.sums


def _projected(apart: np.ndarray, model: Whitening) -> np.ndarray:
    return (apart / model.n) @ model.directions / np.sqrt(model.values)


def whiten(vectors: DataFrame, model: Whitening | None, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id_col, deviation, whitened``: a row for each vector that takes part (as in :func:`fit`). ``deviation`` is the
    exact sum over the dimensions of (n * x - S) squared, with n rows and sums S; a sum beyond 64 bits is an error.
    ``whitened`` has a number per component. Without a model there are no rows. Other columns are dropped."""
    spark = vectors.sparkSession
    ship(spark)
    rows, size = _kept(vectors, id_col, vector_col)
    kind = T.StructType([rows.schema["id"]]).add("deviation", "long").add("whitened", T.ArrayType(T.DoubleType()))
    if model is None:
        return spark.createDataFrame([], kind).withColumnRenamed("id", id_col)
    if size != len(model.sums):
        raise ValueError(f"vectors have {size} entries, the model has {len(model.sums)}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = _apart(batch, model)
            # Whole numbers of any size where 64 bits might not do.
            wide = len(apart) and size * int(np.abs(apart).max()) ** 2 >= 2**63
            deviation = [sum(x * x for x in row) for row in apart.tolist()] if wide else (apart * apart).sum(axis=1)
            white = _projected(apart, model)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(white) + 1) * white.shape[1], pa.int32()), pa.array(white.ravel(), pa.float64())
            )
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(deviation, pa.int64()), lists], ["id", "deviation", "whitened"])

    return rows.mapInArrow(run, kind).withColumnRenamed("id", id_col)


def identity_error(vectors: DataFrame, model: Whitening, *, id_col: str = "vec_id", vector_col: str = "embedding") -> float:
    """Largest absolute entry of the whitened vectors' covariance less the identity, measured over all vectors that take
    part. Blocks are centred before they are multiplied; blocks with means apart are put together by that distance."""
    ship(vectors.sparkSession)
    rows, _ = _kept(vectors, id_col, vector_col)
    m = len(model.values)
    if not m:
        return 0.0

    def merge(parts: list[np.ndarray]) -> np.ndarray:
        n, mean, spread = 0.0, np.zeros(m), np.zeros((m, m))
        for part in parts:
            k, other, more = part[0], part[1 : m + 1], part[m + 1 :].reshape(m, m)
            gap = other - mean
            spread = spread + more + np.outer(gap, gap) * (n * k / (n + k))
            mean = mean + gap * (k / (n + k))
            n += k
        return np.concatenate(([n], mean, spread.ravel()))

    def measure(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        so_far = None
        for batch in batches:
            if not len(batch):
                continue
            white = _projected(_apart(batch, model), model)
            mean = white.mean(axis=0)
            part = np.concatenate(([len(white)], mean, ((white - mean).T @ (white - mean)).ravel()))
            so_far = part if so_far is None else merge([so_far, part])
        return so_far

    all_of = _gather(rows.select("vec"), measure, merge, "whitening-check")
    return float(np.abs(all_of[m + 1 :].reshape(m, m) / all_of[0] - np.eye(m)).max())
