"""Embedding whitening (operator 12).

Vectors are quantised to whole numbers, so counts, sums and deviations are exact.
The covariance is fitted on the distinct vectors: Spark takes them apart (a vector
that a third of the rows share is one row after the map side), one pass adds up
the sums, a second one the products of centred entries, a matrix a task. Matrices
go into the shuffle entry by entry and are added there; what reaches the driver is
one matrix of dimension by dimension, whatever the number of rows.

The leading eigenpairs of that matrix come from ``leading_eigenpairs``:
Householder reflections make it tridiagonal, Sturm counts (how many eigenvalues lie
below a number) bisect for the largest ones down to neighbouring doubles, inverse
iteration on the tridiagonal matrix gives their vectors, those of eigenvalues that
lie close together are made orthogonal to each other in every step, and the
reflections turn them back. Rows are then projected with the components, which
each task gets with the function (dimension times ``TOP`` numbers).

Odd input: rows whose vector is null or empty or holds a null or an entry that is
not finite go. Vectors of another length than most have (the longer of equally
frequent lengths) have no place in the space and go too. Entries beyond 64 bits
stop at their ends. Null and equal ids are rows of their own; equal vectors count
once in the fit. Components whose eigenvalue is zero beside rounding have no
whitened value and are left out: one distinct vector, or none, gives no rows.
``deviation`` is null where it passes 64 bits. Other columns are pruned, so their
names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import map_arrow, materialize

SCALE = 256
TOP = 4
LEAST, MOST = -(2**63), 2**63 - 1
CLOSE = 1e-3  # eigenvalues nearer than this share of the norm are one cluster


# ------------------------------------------------------------ eigenpairs
def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, off-diagonal, unit reflectors) of a symmetric matrix: reflector
    ``k`` acts on the entries from ``k + 1`` on."""
    a = np.array(a, dtype=np.float64)
    n = len(a)
    reflectors = []
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        size = np.abs(x).max()
        v = np.zeros_like(x)
        if size > 0:
            v = x / size
            v[0] += np.copysign(np.sqrt(v @ v), v[0])
            v /= np.sqrt(v @ v)
            rest = a[k + 1 :, k + 1 :]
            p = rest @ v
            w = 2 * (p - (v @ p) * v)
            rest -= np.outer(v, w) + np.outer(w, v)
            a[k + 1 :, k] = a[k, k + 1 :] = x - 2 * v * (v @ x)
        reflectors.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def turned_back(reflectors: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    y = y.copy()
    for k in range(len(reflectors) - 1, -1, -1):
        v = reflectors[k]
        y[k + 1 :] -= 2 * v * (v @ y[k + 1 :])
    return y


def sturm_count(d: np.ndarray, e: np.ndarray, x: float) -> int:
    """How many eigenvalues lie below ``x``: negative pivots of T - x."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    floor = max(tiny, float((e * e).max(initial=0.0)) * tiny)
    count, q = 0, 1.0
    for i in range(len(d)):
        q = d[i] - x - (e[i - 1] ** 2 / q if i else 0.0)
        if abs(q) < floor:
            q = -floor
        count += q < 0
    return count


def largest_eigenvalues(d: np.ndarray, e: np.ndarray, k: int) -> list[float]:
    """The ``k`` largest, falling, each bisected until no double lies between."""
    d, e = [float(x) for x in d], np.asarray(e, dtype=float)
    reach = np.abs(np.append(e, 0.0)) + np.abs(np.append(0.0, e))
    low, high = float((np.array(d) - reach).min()), float((np.array(d) + reach).max())
    margin = np.finfo(float).eps * len(d) * max(abs(low), abs(high)) + np.finfo(float).tiny
    low, high = low - margin, high + margin
    out, n = [], len(d)
    for i in range(k):
        a, b = low, out[-1] if out else high  # fewer than n - i lie below a; at least n - i below or at b
        if out and sturm_count(d, e, b) <= n - 1 - i:
            out.append(b)  # the same eigenvalue again
            continue
        while True:
            middle = a + (b - a) / 2
            if middle <= a or middle >= b:
                break
            if sturm_count(d, e, middle) <= n - 1 - i:
                a = middle
            else:
                b = middle
        out.append(a)
    return out


def _solve(d: np.ndarray, e: np.ndarray, x: float, b: np.ndarray) -> np.ndarray:
    """(T - x) y = b by elimination with row exchanges; a pivot of zero counts as
    the smallest number that matters beside the norm."""
    n = len(d)
    main, up, up2, y = d - x, np.append(e, 0.0), np.zeros(n), b.copy()
    least = np.finfo(float).eps * max(1e-300, np.abs(d).max() + 2 * np.abs(e).max(initial=0.0))
    main, up = main.copy(), up.copy()
    for i in range(n - 1):
        below, nxt = e[i], up[i + 1] if i + 1 < n - 1 else 0.0
        if abs(main[i]) >= abs(below):
            if abs(main[i]) < least:
                main[i] = np.copysign(least, main[i])
            f = below / main[i]
            main[i + 1] -= f * up[i]
            y[i + 1] -= f * y[i]
        else:
            f = main[i] / below
            main[i], up[i], main[i + 1], up2[i] = below, main[i + 1], up[i] - f * main[i + 1], nxt
            if i + 1 < n - 1:
                up[i + 1] = -f * nxt
            y[i], y[i + 1] = y[i + 1], y[i] - f * y[i + 1]
    if abs(main[-1]) < least:
        main[-1] = least
    for i in range(n - 1, -1, -1):
        if i < n - 1:
            y[i] -= up[i] * y[i + 1]
        if i < n - 2:
            y[i] -= up2[i] * y[i + 2]
        y[i] /= main[i]
    return y


def leading_eigenpairs(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and their unit
    vectors as columns."""
    size = float(np.abs(a).max(initial=0.0))
    if size == 0:
        return np.zeros(0), np.zeros((len(a), 0))
    d, e, reflectors = tridiagonal(a / size)
    values = largest_eigenvalues(d, e, min(k, len(a)))
    norm = np.abs(d).max() + 2 * np.abs(e).max(initial=0.0)
    rng = np.random.default_rng(7)
    found: list[np.ndarray] = []
    for i, x in enumerate(values):
        cluster = [y for y, other in zip(found, values, strict=False) if other - x <= CLOSE * norm]
        x -= len([v for v in values[:i] if v == x]) * np.finfo(float).eps * norm  # equal ones a little apart
        y = rng.standard_normal(len(d))
        for _ in range(6):
            for z in cluster * 2:  # twice: the first time leaves rounding
                y -= (z @ y) * z
            y /= np.sqrt(y @ y)
            y = _solve(d, e, x, y)
            y /= np.abs(y).max()
        for z in cluster * 2:
            y -= (z @ y) * z
        found.append(y / np.sqrt(y @ y))
    vectors = np.column_stack([turned_back(reflectors, y) for y in found])
    return np.array(values) * size, vectors


# ------------------------------------------------------------- quantised
def _matrix(column: pa.Array) -> np.ndarray:
    """A list column without nulls, all of one length, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def quantised(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, x array<long>) of the rows whose vector is whole and finite."""
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v")
            whole = batch.filter(pa.compute.and_(v.is_valid(), pa.compute.greater(pa.compute.fill_null(pa.compute.list_value_length(v), 0), 0)))
            v = whole.column("v")
            ends = np.cumsum(pa.compute.list_value_length(v).to_numpy(zero_copy_only=False).astype(np.int64))
            entries = pa.compute.fill_null(v.flatten(), float("nan")).to_numpy(zero_copy_only=False)
            if not len(ends):
                continue
            starts = np.append(0, ends[:-1])
            fine = np.logical_and.reduceat(np.isfinite(entries), starts)
            with np.errstate(invalid="ignore", over="ignore"):
                scaled = np.floor(SCALE * entries)
                x = np.where(scaled >= 2.0**63, MOST, np.where(scaled <= -(2.0**63), LEAST, 0))
                plain = np.abs(scaled) < 2.0**63
                x[plain] = scaled[plain].astype(np.int64)
            offsets = pa.array(np.append(starts, ends[-1:]), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int64)))
            out = pa.RecordBatch.from_arrays([whole.column("vec_id"), lists], ["vec_id", "x"])
            yield out.filter(pa.array(fine))

    return map_arrow(rows, run, "vec_id long, x array<long>")


# ------------------------------------------------------------------- fit
@dataclass(frozen=True)
class Whitening:
    """What a fit is: ``n`` distinct vectors with sums ``sums`` (exact), components
    as columns, eigenvalues, the shares they explain, the error of the identity."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / np.sqrt(self.eigenvalues)


def _fits(x: np.ndarray, n: int, sums: tuple[int, ...], power: int) -> bool:
    """Whether n * x - S, or the sum of its squares, surely fits 64 bits."""
    top = n * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) + max(map(abs, sums), default=0)
    return (top if power == 1 else top * top * max(1, x.shape[1])) <= MOST


def centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """x - S / n as doubles: the difference is taken in whole numbers."""
    if _fits(x, n, sums, 1):
        return (n * x - np.array(sums, dtype=np.int64)) / float(n)
    return ((n * x.astype(object) - np.array(sums, dtype=object)) / n).astype(np.float64)


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Sum over dimensions of (n * x - S) squared, null beyond 64 bits."""
    if _fits(x, n, sums, 2):
        c = n * x - np.array(sums, dtype=np.int64)
        return (c * c).sum(axis=1).tolist()
    c = n * x.astype(object) - np.array(sums, dtype=object)
    return [d if d <= MOST else None for d in (int(s) for s in (c * c).sum(axis=1))]


def _added_up(partials: DataFrame) -> dict[int, float]:
    """Rows (k, value) added up by k; as many numbers as a matrix has entries."""
    return {r.k: r.s for r in partials.groupBy("k").agg(F.sum("value").alias("s")).collect()}


def _products(vectors: DataFrame, make) -> DataFrame:
    """(k, value): a task's sum of ``make(x)``' M M' over its vectors, entry by
    entry of the lower half."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if len(batch):
                m = make(_matrix(batch.column("x")))
                total = m.T @ m if total is None else total + m.T @ m
        if total is not None:
            i, j = np.tril_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i * len(total) + j, pa.int64()), pa.array(total[i, j])], ["k", "value"])

    return map_arrow(vectors.select("x"), run, "k long, value double")


def _square(entries: dict[int, float], size: int, n: int) -> np.ndarray:
    out = np.zeros((size, size))
    for k, s in entries.items():
        i, j = divmod(k, size)
        out[i, j] = out[j, i] = s / n
    return out


def _sums(vectors: DataFrame) -> dict[int, int]:
    """Exact sums by dimension; under -1 the number of vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = None, 0
        for batch in batches:
            if len(batch):
                x = _matrix(batch.column("x"))
                small = max(abs(int(x.max())), abs(int(x.min()))) * len(x) <= MOST
                s = (x if small else x.astype(object)).sum(axis=0).astype(object)
                total, n = s if total is None else total + s, n + len(x)
        if n:
            values = pa.array([n, *(int(v) for v in total)], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(total)), pa.int64()), values], ["k", "value"])

    sums = map_arrow(vectors.select("x"), run, "k long, value decimal(38,0)").groupBy("k").agg(F.sum("value").alias("s"))
    return {r.k: int(r.s) for r in sums.collect()}


def one_length(rows: DataFrame) -> tuple[DataFrame, int]:
    """The rows of the commonest length (the longer one of a tie), and it."""
    size = F.size("x")
    lengths = rows.groupBy(size.alias("d")).agg(F.count(F.lit(1)).alias("n"))
    top = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    d = top.d if top else 0
    return rows.filter(size == d), d


def fit(rows: DataFrame, dimension: int, top: int = TOP) -> Whitening | None:
    """The whitening of ``quantised`` rows of one length, fitted on the distinct
    vectors; None if they have no spread."""
    vectors = materialize(rows.select("x").distinct(), "whitening-vectors")
    sums = _sums(vectors)
    n = sums.pop(-1, 0)
    if n < 2:
        return None
    means = tuple(sums[k] for k in range(dimension))
    cov = _square(_added_up(_products(vectors, lambda x: centred(x, n, means))), dimension, n)
    values, components = leading_eigenpairs(cov, top)
    enough = values > max(values, default=0.0) * dimension * np.finfo(float).eps * 8
    values, components = values[enough], components[:, enough]
    if not len(values):
        return None
    found = Whitening(n, means, components, values, values / np.trace(cov), 0.0)
    white = _square(_added_up(_products(vectors, found.whiten)), len(values), n)
    error = float(np.abs(white - np.eye(len(values))).max())
    return Whitening(n, means, components, values, found.explained, error)


def whitened(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", top: int = TOP) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row
    for each whole vector and component."""
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows, dimension = one_length(quantised(df, id_col, vec_col))
    model = fit(rows, dimension, top)
    if model is None:
        return df.sparkSession.createDataFrame([], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.eigenvalues)
        for batch in batches:
            if not len(batch):
                continue
            x = _matrix(batch.column("x"))
            each = np.repeat(np.arange(len(x)), k)
            deviation = pa.array(deviations(x, model.n, model.sums), pa.int64())
            columns = [
                batch.column("vec_id").take(pa.array(each)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(each), model.n)),
                deviation.take(pa.array(each)),
                pa.array(model.whiten(x).ravel()),
                pa.array(np.tile(model.explained, len(x))),
                pa.array(np.full(len(each), model.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return map_arrow(rows, run, schema)
