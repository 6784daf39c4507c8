"""Whitened embeddings by a pivoted Cholesky factor of the centred scatter and one-sided Jacobi rotations.

Two passes over the table give the sums and then the scatter of the centred vectors; a task holds one
matrix of the vectors' width, never their number. On the driver the scatter, again of that width, is
factored with the largest remaining diagonal entry first. Plane rotations make the columns of the
triangular factor orthogonal: their squared lengths are the eigenvalues and, scaled to length one,
they are the components. The product of the factor with itself is never formed again, which keeps
small eigenvalues accurate.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 1024, 100_000
# Numbers x lie within these bounds; entries of over some 10**9 are held at them.
LIMIT = float(1 << 40)
COMPONENTS = 8
# Vectors of a batch that are centred at a time.
ROWS = 4096
LARGEST = (1 << 63) - 1

WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass
class Whitening:
    """What a fit gives: the number of vectors, their sums, and components (columns) by falling eigenvalue."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float

    def project(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums) @ (self.components / np.sqrt(self.values))


def usable(vector: Column) -> Column:
    """Whether a vector has entries, none of them null or not finite."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def numbers(column: pa.Array, width: int) -> np.ndarray:
    """The whole numbers of all entries of a batch of usable vectors, one row for each."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    scaled = np.clip(np.floor(SCALE * flat) + SHIFT, -LIMIT, LIMIT)
    return scaled.astype(np.int64).reshape(-1, width)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``x`` less the mean: whole numbers up to the last, inexact division."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.float64) / n
    return (x - whole) - rest


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The exact sum over dimensions of (n * x - S) ** 2; None where it doesn't fit a long."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = [s % n for s in sums]
    apart = x - whole
    span = n * (int(np.abs(apart).max(initial=0)) + 1)
    if span**2 * x.shape[1] <= LARGEST:
        step = apart * n - np.array(rest, np.int64)
        return (step * step).sum(axis=1).tolist()
    exact = [sum((n * a - r) ** 2 for a, r in zip(row, rest, strict=True)) for row in apart.tolist()]
    return [v if v <= LARGEST else None for v in exact]


def _sums(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """For each batch and dimension the number of vectors and the sums of the high and low halves of x."""
    for batch in batches:
        x = numbers(batch.column(0), width)
        if len(x):
            parts = [np.arange(width), np.full(width, len(x)), (x >> 20).sum(axis=0), (x & 0xFFFFF).sum(axis=0)]
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int64()) for p in parts], ["i", "n", "high", "low"])


def _upper(scatter: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i, row in enumerate(scatter):
        size = len(row) - i
        yield pa.RecordBatch.from_arrays([pa.array(np.full(size, i)), pa.array(np.arange(i, len(row))), pa.array(row[i:])], ["i", "j", "v"])


def _scatter(batches: Iterator[pa.RecordBatch], n: int, sums: list[int]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((len(sums), len(sums)))
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS):
            y = centred(numbers(batch.column(0).slice(lo, ROWS), len(sums)), n, sums)
            total += y.T @ y
    yield from _upper(total)


def _whitened_moments(batches: Iterator[pa.RecordBatch], model: Whitening) -> Iterator[pa.RecordBatch]:
    """Sums (row 0) and products of the whitened values, in one matrix."""
    k = len(model.values)
    total = np.zeros((k + 1, k + 1))
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS):
            w = model.project(numbers(batch.column(0).slice(lo, ROWS), len(model.sums)))
            w = np.hstack((np.ones((len(w), 1)), w))
            total += w.T @ w
    yield from _upper(total)


def _matrix(parts: DataFrame, width: int) -> np.ndarray:
    """The symmetric matrix of ``width`` that summed parts (i, j, v) make."""
    out = np.zeros((width, width))
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"]
    return out


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, lower trapezoidal factor) with ``a[order][:, order] = factor @ factor.T``.

    The largest remaining diagonal entry, the first of equals, comes next; when none is left above the
    rounding of the largest the factor has as many columns as the matrix has rank.
    """
    width = len(a)
    a, order = a.astype(np.float64).copy(), np.arange(width)
    factor = np.zeros((width, width))
    least = max(float(a.diagonal().max(initial=0)), 0.0) * width * np.finfo(np.float64).eps
    for k in range(width):
        p = k + int(np.argmax(a.diagonal()[k:]))
        if a[p, p] <= least:
            return order, factor[:, :k]
        for rows in (a, factor, order):
            rows[[k, p]] = rows[[p, k]]
        a[:, [k, p]] = a[:, [p, k]]
        factor[k, k] = np.sqrt(a[k, k])
        factor[k + 1 :, k] = a[k + 1 :, k] / factor[k, k]
        a[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
    return order, factor


def _rounds(k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of ``k`` columns, in rounds of disjoint pairs."""
    seats = np.arange(k + k % 2)
    for _ in range(len(seats) - 1):
        a, b = seats[: len(seats) // 2], seats[len(seats) // 2 :][::-1]
        real = (a < k) & (b < k)
        yield np.minimum(a, b)[real], np.maximum(a, b)[real]
        seats = np.concatenate((seats[:1], seats[-1:], seats[1:-1]))


def rotate_columns(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """``factor`` with its columns rotated in pairs until all are orthogonal to double precision."""
    u = factor.copy()
    for _ in range(sweeps):
        turned = False
        for p, q in _rounds(u.shape[1]):
            x, y = u[:, p], u[:, q]
            alpha, beta, gamma = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            skew = np.abs(gamma) > 1e-15 * np.sqrt(alpha * beta)
            if not skew.any():
                continue
            turned = True
            p, q, x, y = p[skew], q[skew], x[:, skew], y[:, skew]
            zeta = (beta[skew] - alpha[skew]) / (2 * gamma[skew])
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1, zeta))
            c = 1 / np.hypot(1, t)
            s = c * t
            u[:, p], u[:, q] = c * x - s * y, s * x + c * y
        if not turned:
            break
    return u


def components(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a scatter, as many as its rank."""
    order, factor = pivoted_cholesky(scatter)
    turned = rotate_columns(factor)
    lengths = np.sqrt((turned * turned).sum(axis=0))
    falling = np.argsort(-lengths, kind="stable")
    vectors = np.zeros_like(turned)
    vectors[order] = turned[:, falling] / lengths[falling]
    return lengths[falling] ** 2, vectors


def fit(vectors: DataFrame, width: int, most: int = COMPONENTS) -> Whitening | None:
    """The whitening of ``vectors`` (one column of usable vectors of one width); None without any."""
    # Sums of halves stay within a long for any number of vectors below 2**43.
    found = vectors.mapInArrow(partial(_sums, width=width), "i long, n long, high long, low long")
    found = found.groupBy("i").agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low")).orderBy("i").collect()
    if not found:
        return None
    n, sums = found[0]["n"], [(r["high"] << 20) + r["low"] for r in found]
    scatter = _matrix(vectors.mapInArrow(partial(_scatter, n=n, sums=sums), "i long, j long, v double"), width)
    values, parts = components(scatter)
    return Whitening(n, sums, values[:most] / n, parts[:, :most], float(np.trace(scatter)) / n)


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened values' covariance minus the identity."""
    k = len(model.values)
    moments = _matrix(vectors.mapInArrow(partial(_whitened_moments, model=model), "i long, j long, v double"), k + 1) / model.n
    covariance = moments[1:, 1:] - np.outer(moments[0, 1:], moments[0, 1:])
    return float(np.abs(covariance - np.eye(k)).max(initial=0))


def _rows(batches: Iterator[pa.RecordBatch], model: Whitening, error: float) -> Iterator[pa.RecordBatch]:
    k = len(model.values)
    explained = model.values / model.trace
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS):
            ids, vectors = (c.slice(lo, ROWS) for c in batch.columns)
            x = numbers(vectors, len(model.sums))
            each, which = np.repeat(np.arange(len(x)), k), np.tile(np.arange(k), len(x))
            columns = [
                ids.take(pa.array(each)),
                pa.array(which + 1, pa.int32()),
                pa.array(np.full(len(each), model.n), pa.int64()),
                pa.array(deviations(x, model.n, model.sums), pa.int64()).take(pa.array(each)),
                pa.array(model.project(x).ravel()),
                pa.array(explained[which]),
                pa.array(np.full(len(each), error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in WHITENED.split(", ")])


def whiten(embeddings: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """One row for each vector and component: the columns of ``WHITENED``.

    ``embeddings`` needs ``vec_id`` and ``embedding`` (array of numbers); other columns are not looked
    at. Vectors that are null or empty, or hold null or non-finite entries, are dropped, and so are
    those of another width than the most frequent one (of equals the larger). An entry c is read as
    floor(1024 c) + 100000, held within plus or minus 2**40. All that remain are fitted. There are
    ``most`` components or as many as the covariance has rank: none, and so no row, if all vectors are
    alike or the table is empty. A component's sign is that of its rotated column, the same for all
    rows; of equal eigenvalues either order may come. ``deviation`` is null where it is over 2**63 - 1.
    Repeated rows and null ids are kept as they are. What reaches the driver is a matrix of the width.
    """
    vectors = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    vectors = vectors.where(usable(F.col("vector")))
    sizes = vectors.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    none = embeddings.sparkSession.createDataFrame([], WHITENED)
    if sizes is None:
        return none
    vectors = vectors.where(F.size("vector") == sizes["width"])
    model = fit(vectors.select("vector"), sizes["width"], most)
    if model is None or not len(model.values):
        return none
    error = identity_error(vectors.select("vector"), model)
    return vectors.mapInArrow(partial(_rows, model=model, error=error), WHITENED)
