"""Embedding whitening by spectrum slicing.

Each component ``c`` becomes the integer ``x = floor(64 c) + 1000000``. The
covariance ``V`` of the distinct x-vectors is summed in tasks from centred
rows. Its leading eigenpairs are found one by one: the inertia of ``V - sI``,
read off the pivots of its LDL^T factors, counts the eigenvalues above ``s``;
bisection on these counts isolates each leading eigenvalue, Rayleigh quotient
iteration then converges cubically, and counts just below and above the result
certify its number.

All sums that must be exact are: with ``n`` distinct vectors and sums ``S``,
rows are centred as the integers ``n x - S`` (the constant 1000000 cancels).
"""
from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import materialise
from .topk import scaled, usable

MAX_DIMS = 2048                 # the driver holds one d x d matrix
SLICE = 1 << 20                 # components that a task holds at a time
RANK_TOL = 1e-11                # of the trace: directions with less variance cannot be whitened
_EPS = float(np.finfo(float).eps)
_ALPHA = (1 + 17 ** 0.5) / 8    # bound of element growth in symmetric pivoting


# -- eigenpairs of a symmetric matrix ---------------------------------------------------------------------------------

def count_above(a: np.ndarray, shift: float) -> int:
    """Eigenvalues of symmetric ``a`` above ``shift``: positive pivots of the LDL^T factors of ``a - shift I``
    (Sylvester), with diagonal pivoting in 1x1 and 2x2 blocks; a 2x2 block has one of each sign."""
    m = a - shift * np.eye(len(a))
    above = k = 0
    while k < len(m):
        s = m[k:, k:]
        below = np.abs(s[1:, 0])
        r = 1 + int(below.argmax()) if len(below) else 0
        first, largest = abs(s[0, 0]), (below[r - 1] if r else 0.0)
        if max(first, largest) == 0:                # the shift itself is an eigenvalue
            k += 1
            continue
        size = 1
        if first < _ALPHA * largest:
            row = np.abs(s[r])
            row[r] = 0
            widest = row.max()
            if first * widest < _ALPHA * largest ** 2:
                size, target = (1, 0) if abs(s[r, r]) >= _ALPHA * widest else (2, 1)
                if r != target:
                    s[[target, r]] = s[[r, target]]
                    s[:, [target, r]] = s[:, [r, target]]
        if size == 1:
            above += bool(s[0, 0] > 0)
            s[1:, 1:] -= np.outer(s[1:, 0], s[0, 1:] / s[0, 0])
        else:
            above += 1
            s[2:, 2:] -= s[2:, :2] @ np.linalg.solve(s[:2, :2], s[:2, 2:])
        k += size
    return above


class Slicer:
    """Counts of eigenvalues above probed shifts, kept, as the search for one eigenvalue narrows that for others."""

    def __init__(self, a: np.ndarray):
        self.a = a
        radius = np.abs(a).sum(1) - np.abs(np.diagonal(a))
        low, high = float((np.diagonal(a) - radius).min()), float((np.diagonal(a) + radius).max())
        self.norm = max(abs(low), abs(high))
        margin = max(self.norm, 1e-300) * 1e-12
        self.known = {low - margin: len(a), high + margin: 0}

    def above(self, shift: float) -> int:
        if shift not in self.known:
            self.known[shift] = count_above(self.a, shift)
        return self.known[shift]

    def bounds(self, number: int) -> tuple[float, float]:
        """The narrowest known interval that holds eigenvalue ``number`` (1: the largest)."""
        return (max(s for s, c in self.known.items() if c >= number), min(s for s, c in self.known.items() if c < number))

    def isolate(self, number: int, width: float) -> tuple[float, float]:
        """Bisect until no other eigenvalue is inside, or the interval is below ``width`` (a multiple eigenvalue)."""
        while True:
            low, high = self.bounds(number)
            if (self.known[low] == number and self.known[high] == number - 1) or high - low <= width:
                return low, high
            self.above((low + high) / 2)


def _solve(a: np.ndarray, shift: float, v: np.ndarray, nudge: float) -> np.ndarray:
    for step in range(8):
        try:
            x = np.linalg.solve(a - (shift + nudge * step) * np.eye(len(a)), v)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(x).all():
            return x
    raise ArithmeticError("no shift near an eigenvalue gives a solvable system")


def _unit(v: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for o in others:
            v = v - (o @ v) * o
        v = v / np.linalg.norm(v)
    return v


def leading_pairs(a: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues of symmetric ``a``, falling, and their unit vectors as columns."""
    n, slicer = len(a), Slicer(a)
    if slicer.norm == 0:
        return np.zeros(min(count, n)), np.eye(n)[:, :count]
    tiny = 8 * n * _EPS * slicer.norm
    rng = np.random.default_rng(n)
    values, vectors = [], []
    for number in range(1, min(count, n) + 1):
        low, high = slicer.isolate(number, tiny)
        while True:
            value, v = (low + high) / 2, _unit(rng.normal(size=n), vectors)
            for _ in range(3):                                        # towards the isolated eigenvalue
                v = _unit(_solve(a, value, v, tiny / 8), vectors)
            for _ in range(20):                                       # Rayleigh quotient iteration
                value = float(v @ a @ v)
                if np.linalg.norm(a @ v - value * v) <= tiny / 4:
                    break
                v = _unit(_solve(a, value, v, tiny / 8), vectors)
            if slicer.above(value + tiny) < number <= slicer.above(value - tiny):
                break                                                 # counts certify the number
            if high - low <= tiny:
                raise ArithmeticError(f"eigenvalue {number} was not reached from its interval")
            slicer.above((low + high) / 2)                            # it went to a neighbour: start closer
            low, high = slicer.bounds(number)
        values.append(value)
        vectors.append(v)
    return np.array(values), np.array(vectors).reshape(-1, n).T


# -- exact sums over rows ---------------------------------------------------------------------------------------------

def squares(y: np.ndarray) -> pa.Array:
    """Exact row sums of squares of int64 values below 2^61, as decimal(38, 0) (beyond it: an error)."""
    largest = int(np.abs(y).max(initial=0))
    if largest * largest * max(y.shape[1], 1) < 1 << 62:
        return pa.array((y * y).sum(1)).cast(pa.decimal128(38, 0))
    parts = [y & 0xFFFFFF, y >> 24 & 0xFFFFFF, y >> 48]               # y = p0 + p1 2^24 + p2 2^48
    total = sum(((parts[i] * parts[j]).sum(1).astype(object) << 24 * (i + j) for i in range(3) for j in range(3)), 0)
    from decimal import Decimal
    return pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))


def _integers(batch: pa.RecordBatch, width: int):
    """(first row, matrix of floor(64 c)) of slices of the batch; shorter vectors end in zeros."""
    step = max(1, SLICE // max(width, 1))
    for lo in range(0, batch.num_rows, step):
        col = batch.column("v").slice(lo, step)
        lens = col.value_lengths().to_numpy()
        x = np.floor(col.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * 64).astype(np.int64)
        if (lens == width).all():
            yield lo, x.reshape(-1, width)
        else:
            out = np.zeros((len(lens), width), np.int64)
            out[np.arange(width) < lens[:, None]] = x
            yield lo, out


def _unpacked(batch: pa.RecordBatch, width: int, kind: str):
    step = max(1, SLICE // max(width, 1))
    for lo in range(0, batch.num_rows, step):
        yield np.frombuffer(b"".join(batch.column("x").slice(lo, step).to_pylist()), kind).reshape(-1, width).astype(np.int64)


class Whitening(NamedTuple):
    n: int                      # distinct vectors
    sums: np.ndarray            # of floor(64 c), by dimension (exact, Python integers)
    values: np.ndarray          # leading eigenvalues, falling
    vectors: np.ndarray         # their unit vectors, columns
    trace: float
    identity_error: float
    width: int


def _centre(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return n * x - sums.astype(np.int64)


def _moments(fit: DataFrame, width: int, kind: str, row_values, size: int) -> np.ndarray:
    """Sums over the fit list of 1 and of products of ``row_values(x)``: matrix of (size + 1) x (size + 1),
    added up in tasks, then by cell."""
    def task(batches):
        total = np.zeros((size + 1, size + 1))
        for batch in batches:
            for x in _unpacked(batch, width, kind):
                v = row_values(x)
                total[1:, 1:] += v.T @ v
                total[0, 1:] += v.sum(0)
        i, j = np.triu_indices(size + 1)
        yield pa.record_batch({"i": pa.array(i.astype(np.int32)), "j": pa.array(j.astype(np.int32)), "s": pa.array(total[i, j])})

    cells = fit.mapInArrow(task, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).toArrow()
    out = np.zeros((size + 1, size + 1))
    i, j, s = (cells.column(c).to_numpy() for c in ("i", "j", "s"))
    out[i, j] = s
    out[j, i] = s
    return out


def fit_whitening(vectors: DataFrame, components: int = 16, vec_col: str = "embedding") -> Whitening | None:
    """The whitening of the distinct vectors of ``vec_col``; None if no component takes part.

    Components are at most the dimensions and the directions with variance (over ``RANK_TOL`` of the whole)."""
    kept = vectors.select(F.col(vec_col).alias("v")).filter(usable(F.col("v")))
    ends = (kept.select(F.size("v").alias("d"), scaled(F.col("v"), 64).alias("v"))
            .agg(F.max("d").alias("width"), F.min(F.array_min("v")).alias("low"), F.max(F.array_max("v")).alias("high")).first())
    if not ends["width"]:
        return None
    width, largest = ends["width"], max(abs(ends["low"] or 0), abs(ends["high"] or 0))
    if width > MAX_DIMS:
        raise ValueError(f"vectors of {width} dimensions; at most {MAX_DIMS} are taken")
    if largest >= 1 << 31:
        raise ValueError(f"floor(64 c) reaches {largest}; whitening takes components below 2^31 there")
    kind = "<i2" if largest < 1 << 15 else "<i4"

    def packed(batches):
        for batch in batches:
            rows = [r.tobytes() for _, x in _integers(batch, width) for r in x.astype(kind)]
            yield pa.record_batch({"x": pa.array(rows, pa.binary())})

    fit = materialise(kept.mapInArrow(packed, "x binary").distinct(), "fit-list")

    def added(batches):
        n, total = 0, np.zeros(width, np.int64)
        for batch in batches:
            for x in _unpacked(batch, width, kind):
                n, total = n + len(x), total + x.sum(0)
        yield pa.record_batch({"j": pa.array(np.arange(-1, width, dtype=np.int32)), "s": pa.array(np.append(n, total))})

    sums = fit.mapInArrow(added, "j int, s long").groupBy("j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    sums = {r["j"]: int(r["s"]) for r in sums}
    n, total = sums.pop(-1), np.array([sums[j] for j in range(width)], object)
    if n * 2 * max(largest, 1) >= 1 << 61:
        raise ValueError(f"{n} distinct vectors of components up to {largest} leave the exact range")
    centred = lambda x: _centre(x, n, total) / n                                                              # noqa: E731
    cov = _moments(fit, width, kind, centred, width)[1:, 1:] / n
    trace = float(np.trace(cov))
    values, axes = leading_pairs(cov, components) if trace > 0 else (np.zeros(0), np.zeros((width, 0)))
    whole = values > RANK_TOL * trace
    values, axes = values[whole], axes[:, whole]
    error = 0.0
    if len(values):
        project = lambda x: centred(x) @ axes / np.sqrt(values)                                               # noqa: E731
        mean = _moments(fit, width, kind, project, len(values))[0, 1:] / n
        again = _moments(fit, width, kind, lambda x: project(x) - mean, len(values))[1:, 1:] / n
        error = float(np.abs(again - np.eye(len(values))).max())
    return Whitening(n, total, values, axes, trace, error, width)


def whiten(vectors: DataFrame, components: int = 16, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` of each vector and component.

    ``deviation`` is decimal(38, 0). Vectors that are null or hold a null or
    non-finite component are left out, and other columns are ignored. Repeated
    rows and rows without an id each give their own result rows. Vectors of
    different lengths meet as if the shorter ended in zeros. Directions without
    variance give no component: a table of one distinct vector, or of none,
    gives an empty result."""
    spark = vectors.sparkSession
    kept = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v")).filter(usable(F.col("v")))
    schema = (f"vec_id {dict(kept.dtypes)['id']}, component int, n long, deviation decimal(38,0), whitened double, "
              "explained double, identity_error double")
    found = fit_whitening(vectors, components, vec_col)
    if found is None or not len(found.values):
        return spark.createDataFrame([], schema)
    n, total, values, axes, trace, error, width = found
    k = len(values)

    def task(batches):
        for batch in batches:
            for lo, x in _integers(batch, width):
                y = _centre(x, n, total)
                rows = np.repeat(np.arange(len(x)), k)
                whole = len(rows)
                yield pa.record_batch({
                    "vec_id": batch.column("id").slice(lo, len(x)).take(pa.array(rows)),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    "n": pa.array(np.full(whole, n)), "deviation": squares(y).take(pa.array(rows)),
                    "whitened": pa.array(((y / n) @ axes / np.sqrt(values)).reshape(-1)),
                    "explained": pa.array(np.tile(values / trace, len(x))),
                    "identity_error": pa.array(np.full(whole, error))})

    return kept.mapInArrow(task, schema)


def whiten_digest(vectors: DataFrame) -> DataFrame:
    """``whiten`` with ``deviation`` as long (null beyond its range; ``deviation_exact`` holds every value)."""
    found = whiten(vectors)
    return found.select("vec_id", "component", "n", F.col("deviation").try_cast("long").alias("deviation"), "whitened",
                        "explained", "identity_error", F.col("deviation").alias("deviation_exact"))
