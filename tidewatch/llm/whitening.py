"""Embedding whitening: Golub-Kahan-Lanczos bidiagonalisation of the centred vectors, products as Spark jobs.

1. Vectors become integers, and each distinct one is a row of the matrix X once. Rows are written in blocks.
2. Each step multiplies X with a right vector v and Xᵀ with the left vector u that this gives, in one job over the blocks. X is
   centred with exact integer sums before anything is multiplied. A task returns one small row of sums.
3. A left vector has as many entries as X has rows, and is never gathered or stored: with the right vectors V so far and the
   triangle R of their coefficients, U R = X V, so each task makes its own part of U anew from its block. A step is
   reorthogonalised against all of U, with further jobs until nothing is left to correct, and against all of V in the driver.
4. The singular values of the small bidiagonal give eigenvalues, its vectors the components. Steps end when the residuals of
   the wanted components are down at rounding, or when the space is used up.

The driver holds vectors of as many entries as the embedding has, one for each step. A lost executor repeats a task over blocks
that are written in the shared folder.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import opened, share
from tidewatch.llm.vectors import is_finite, lists, longest, matrix, padded
from tidewatch.session import pinned

OUT_SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
_BLOCK_ROWS = 1024
_LARGEST = (1 << 63) - 1
# a product smaller than this share of the largest one is rounding
_NOTHING = 1e-13


@dataclass
class Centre:
    """How many rows X has, and the exact sum of each column."""
    n: int
    sums: list[int]

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exact: 64-bit integers where their squares fit, Python's elsewhere."""
        most = self.n * max(int(x.max(initial=0)), -int(x.min(initial=0))) + max((abs(s) for s in self.sums), default=0)
        kind = np.int64 if most * most * max(1, len(self.sums)) <= _LARGEST else object
        return x.astype(kind) * self.n - np.array(self.sums, dtype=kind)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.scaled(x) / self.n).astype(np.float64)


def _blocks(length: int):
    """Rows of integers, gathered into binary blocks."""
    def blocks(batches):
        for batch in batches:
            x = np.ascontiguousarray(matrix(batch.column(0), length), dtype=np.int64)
            cuts = [x[k:k + _BLOCK_ROWS] for k in range(0, len(x), _BLOCK_ROWS)]
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(c) for c in cuts], pa.int64()),
                                              "block": pa.array([c.tobytes() for c in cuts], pa.binary())})
    return blocks


def _read(batches, length: int):
    for batch in batches:
        for data in batch.column(0):
            yield np.frombuffer(data.as_buffer(), np.int64).reshape(-1, length)


def _column_sums(length: int):
    def column_sums(batches):
        n, sums = 0, [0] * length
        for x in _read(batches, length):
            safe = max(int(x.max()), -int(x.min())) * len(x) <= _LARGEST
            n, sums = n + len(x), [a + int(b) for a, b in zip(sums, (x if safe else x.astype(object)).sum(axis=0), strict=True)]
        yield pa.RecordBatch.from_pydict({"n": [n], "sums": pa.array([[str(s) for s in sums]], pa.list_(pa.string()))})
    return column_sums


def _left_vectors(x: np.ndarray, right: np.ndarray, triangle: np.ndarray) -> np.ndarray:
    """The rows of U that belong to the rows x, from U R = x V. A column without length is left out as zero."""
    u = x @ right
    for k in range(u.shape[1]):
        u[:, k] -= u[:, :k] @ triangle[:k, k]
        u[:, k] = u[:, k] / triangle[k, k] if triangle[k, k] else 0.0
    return u


def _products(shared, length: int):
    """One row of sums for each task: Uᵀw, Xᵀw and wᵀw of w = X v - U r."""
    def products(batches):
        centre, right, triangle, v, r = opened(shared)
        total = np.zeros(len(r) + length + 1)
        for x in _read(batches, length):
            x = centre.centred(x)
            u = _left_vectors(x, right, triangle)
            w = x @ v - u @ r
            total += np.concatenate([u.T @ w, x.T @ w, [w @ w]])
        yield pa.RecordBatch.from_pydict({"total": pa.array([total.tobytes()], pa.binary())})
    return products


def _second_moments(shared, length: int):
    """One row for each task: sums of squares of the centred rows, sums and products of their projections."""
    def second_moments(batches):
        centre, projection = opened(shared)
        k = projection.shape[1]
        total = np.zeros(1 + k + k * k)
        for x in _read(batches, length):
            x = centre.centred(x)
            y = x @ projection
            total += np.concatenate([[(x * x).sum()], y.sum(axis=0), (y.T @ y).ravel()])
        yield pa.RecordBatch.from_pydict({"total": pa.array([total.tobytes()], pa.binary())})
    return second_moments


class Matrix:
    """The centred matrix of distinct vectors; products with it are jobs over its blocks."""

    def __init__(self, distinct: DataFrame, length: int):
        self.length = length
        self.blocks = pinned(distinct.mapInArrow(_blocks(length), "n long, block binary")).select("block")
        parts = self.blocks.mapInArrow(_column_sums(length), "n long, sums array<string>").collect()  # one row a task
        self.centre = Centre(sum(p.n for p in parts), [sum(int(p.sums[d]) for p in parts) for d in range(length)])

    def _summed(self, function, *model) -> np.ndarray:
        shared = share(self.blocks.sparkSession, (self.centre, *model))
        parts = self.blocks.mapInArrow(function(shared, self.length), "total binary").collect()  # one row a task
        shared.destroy()
        return np.sum([np.frombuffer(p.total) for p in parts], axis=0)

    def products(self, right, triangle, v, r) -> tuple[np.ndarray, np.ndarray, float]:
        total = self._summed(_products, right, triangle, v, r)
        return total[:len(r)], total[len(r):-1], float(total[-1])

    def second_moments(self, projection: np.ndarray) -> tuple[float, np.ndarray]:
        """The trace of the covariance of the rows, and the covariance of their projections."""
        k, total = projection.shape[1], self._summed(_second_moments, projection)
        mean = total[1:1 + k] / self.centre.n
        return total[0] / self.centre.n, total[1 + k:].reshape(k, k) / self.centre.n - np.outer(mean, mean)


def _orthogonal(z: np.ndarray, right: np.ndarray) -> np.ndarray:
    for _ in range(2):
        z = z - right @ (right.T @ z)
    return z


def bidiagonalised(x: Matrix, wanted: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray, int]:
    """(right singular vectors as columns, singular values, steps) of the largest `wanted` singular values above zero.

    A step that finds nothing new (the start has no part in some component, or a singular value occurs twice) goes on with a
    new start orthogonal to all steps before, to the end of the space.
    """
    rng, length = np.random.default_rng(seed), x.length
    right, triangle = np.zeros((length, 0)), np.zeros((0, 0))
    diagonal, above, back = [], [], np.zeros((length, 0))  # back: Xᵀu of each step
    v, beta = rng.standard_normal(length), 0.0
    v /= np.linalg.norm(v)
    while True:
        k = len(diagonal)
        r = np.zeros(k)
        if k:
            r[-1] = beta
        for _ in range(4):
            c, t, square = x.products(right, triangle, v, r)
            r = r + c
            if c @ c <= 1e-20 * square:
                break
        alpha, scale = np.sqrt(max(square - c @ c, 0.0)), max(diagonal, default=0.0)
        alpha = 0.0 if alpha <= _NOTHING * scale else float(alpha)
        t = (t - back @ c) / alpha if alpha else np.zeros(length)
        right, back = np.column_stack([right, v]), np.column_stack([back, t])
        triangle = np.block([[triangle, r[:, None]], [np.zeros((1, k)), np.array([[alpha]])]])
        if k:
            above.append(beta)
        diagonal.append(alpha)
        z = _orthogonal(t - alpha * v, right)
        beta = float(np.linalg.norm(z))
        left, values, rows = np.linalg.svd(np.diag(diagonal) + np.diag(above, 1))
        found = beta > _NOTHING * max(values[0], scale)
        first = min(wanted, length)
        if k + 1 == length or (found and k + 1 >= first
                               and (beta * np.abs(left[-1, :first]) <= 2 * np.finfo(float).eps * values[0]).all()):
            some = int((values[:first] > 1e-12 * values[0]).sum()) if values[0] > 0 else 0
            return right @ rows[:some].T, values[:some], k + 1
        if not found:
            z, beta = _orthogonal(rng.standard_normal(length), right), 0.0
        v = z / np.linalg.norm(z)
        v = _orthogonal(v, right)
        v /= np.linalg.norm(v)


def _rows_out(shared, length: int):
    def rows_out(batches):
        centre, projection, explained, error = opened(shared)
        k = projection.shape[1]
        for batch in batches:
            x = matrix(batch.column(1), length).astype(np.int64)
            far = centre.scaled(x)
            square = (far * far).sum(axis=1)
            deviation = [int(s) if s <= _LARGEST else None for s in square]
            m = len(x)
            yield pa.RecordBatch.from_pydict({
                "vec_id": pa.array(batch.column(0)).take(pa.array(np.repeat(np.arange(m), k))),
                "component": pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                "n": pa.array(np.full(m * k, centre.n), pa.int64()),
                "deviation": pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                "whitened": pa.array(((far / centre.n).astype(np.float64) @ projection).ravel(), pa.float64()),
                "explained": pa.array(np.tile(explained, m), pa.float64()),
                "identity_error": pa.array(np.full(m * k, error), pa.float64())})
    return rows_out


def whitened(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = 4,
             grid: int = 256) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for every usable row and component.

    Rows whose vector is null or holds null, NaN or infinite entries are left out. Entries c become floor(grid * c), beyond
    64 bits the nearest 64-bit integer. Vectors shorter than the longest one end in zeros. Equal vectors are fitted once, and
    every row is returned, repeated rows and rows without vec_id too. There are fewer components than asked for where fewer
    eigenvalues are above zero: none for a single vector or an empty table, which give no rows. A deviation that does not fit
    64 bits is null.
    """
    coded = vectors.where(is_finite(vector)).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.transform(F.col(vector).cast("array<double>"), lambda c: F.floor(c * grid) + 0).alias("x"))
    length = longest(coded, "x")
    if not length:
        return vectors.sparkSession.createDataFrame([], OUT_SCHEMA)
    coded = coded.withColumn("x", padded("x", length).cast("array<long>"))
    x = Matrix(coded.select("x").distinct(), length)
    axes, values, _ = bidiagonalised(x, components)
    if not len(values):
        return vectors.sparkSession.createDataFrame([], OUT_SCHEMA)
    eigenvalues = values ** 2 / x.centre.n
    projection = axes / np.sqrt(eigenvalues)
    trace, covariance = x.second_moments(projection)
    error = float(np.abs(covariance - np.eye(len(values))).max())
    shared = share(vectors.sparkSession, (x.centre, projection, eigenvalues / trace, error))
    return coded.mapInArrow(_rows_out(shared, length), OUT_SCHEMA)
