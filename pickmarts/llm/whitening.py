"""Operator 13, embedding whitening by pivoted Cholesky and one-sided Jacobi.

1. One pass adds up the fit list: n and the exact sums S of every dimension
   (integers, one row per task and dimension).
2. A second pass adds up the scatter of the centred vectors, a triangle of D x D
   numbers per task; rows of it are summed in the cluster, so only one matrix,
   bounded by the dimensions, reaches the driver.
3. The driver factors the scatter, P'CP = L L', by Cholesky with diagonal pivots,
   which stops at the rank of the data, and turns the columns of L against each
   other (one-sided Jacobi) until all are orthogonal: L J = U D. Squared column
   norms are the eigenvalues of the scatter, normalised columns its components.
   The scatter is never squared, so small eigenvalues keep their digits.
4. A third pass adds up the covariance of the whitened vectors for
   ``identity_error``, a fourth returns the rows.

Every pass is map-only over Arrow batches; nothing but sums bounded by the
dimensions is shuffled, so neither repeated vectors nor one hot label matter.

Defined cases: the dimension D is the length most vectors have (the greater of
two equally frequent ones). Left out are null vectors, vectors of another length,
and vectors with a null, a non-finite or a greater entry than ``LARGEST`` (whose
integers a double can't hold). Components of no variance have no rows, so one
row, or equal rows only, give an empty result, as an empty table does. Equal
eigenvalues span their space in some basis, the same for all rows. ``deviation``
is null where it exceeds a long. Signs: the entry of a component farthest from
zero is positive. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8
LARGEST = float(1 << 40)
ROWS = 4096  # of a slice worked on at once

_I = np.int64


def _vectors(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the vectors that stay, and their integers x, a row each."""
    length = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(length == dims)
    values = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    values = values.reshape(len(rows), dims)
    whole = (np.abs(values) <= LARGEST).all(axis=1)  # false for nan
    return rows[whole], np.floor(values[whole] * SCALE).astype(_I) + SHIFT


def _slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def _sum_batches(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * dims
        for batch in _slices(batches):
            _, x = _vectors(batch.column(0), dims)
            n += len(x)
            sums = [a + b for a, b in zip(sums, x.sum(axis=0).tolist())]
        if n:
            text = pa.array([str(s) for s in sums])
            yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), text, pa.array([n] * dims)], names=["i", "s", "n"])

    return run


@dataclass(frozen=True)
class Moments:
    """Number of vectors and exact sums of their integers."""

    n: int
    sums: tuple[int, ...]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n: the whole part of the mean goes off exactly, its fraction then."""
        whole = np.array([s // self.n for s in self.sums], _I)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return (x - whole).astype(np.float64) - rest

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n x - S)^2 for every row, exactly."""
        largest = max((abs(int(v)) for v in (x.min(initial=0), x.max(initial=0))), default=0)
        reach = self.n * largest + max(map(abs, self.sums), default=0)
        if reach * reach * x.shape[1] < 1 << 62:
            d = self.n * x - np.array(self.sums, _I)
            return (d * d).sum(axis=1).tolist()
        d = x.astype(object) * self.n - np.array(self.sums, object)
        return [v if v < 1 << 63 else None for v in (d * d).sum(axis=1).tolist()]


def _scatter_batches(dims: int, moments: Moments):
    """(i, row): the rows of the scatter of one task's vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in _slices(batches):
            _, x = _vectors(batch.column(0), dims)
            c = moments.centred(x)
            total += c.T @ c
        yield _matrix_rows(total)

    return run


def _matrix_rows(m: np.ndarray) -> pa.RecordBatch:
    rows = pa.array([r.tobytes() for r in m], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(range(len(m)), pa.int32()), rows], names=["i", "row"])


def _add_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the rows of one number that a task meets."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            total[i] = total.get(i, 0) + np.frombuffer(row)
    if total:
        rows = pa.array([r.tobytes() for r in total.values()], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), rows], names=["i", "row"])


def _summed_matrix(parts: DataFrame, dims: int) -> np.ndarray:
    """The sum of the matrices that the tasks gave row by row."""
    out = np.zeros((dims, dims))
    for r in parts.repartition("i").mapInArrow(_add_rows, "i int, row binary").collect():
        out[r["i"]] += np.frombuffer(r["row"])
    return out


def pivoted_cholesky(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pivots p and the lower factor L with c[p][:, p] = L L', of as many columns as the rank."""
    c = c.copy()
    d = len(c)
    pivots, factor = np.arange(d), np.zeros((d, d))
    least = np.finfo(float).eps * d * max(np.diag(c).max(initial=0.0), 0.0)
    for k in range(d):
        j = k + int(np.argmax(np.diag(c)[k:]))
        if c[j, j] <= least:
            return pivots, factor[:, :k]
        if j != k:
            c[[k, j]] = c[[j, k]]
            c[:, [k, j]] = c[:, [j, k]]
            factor[[k, j]] = factor[[j, k]]
            pivots[[k, j]] = pivots[[j, k]]
        factor[k, k] = np.sqrt(c[k, k])
        factor[k + 1 :, k] = c[k + 1 :, k] / factor[k, k]
        c[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
    return pivots, factor


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The columns of ``factor`` turned in pairs until all are orthogonal."""
    u = factor.copy()
    n = u.shape[1]
    for _ in range(sweeps):
        turned = False
        for p in range(n - 1):
            for q in range(p + 1, n):
                x, y = u[:, p], u[:, q]
                a, b, g = x @ x, y @ y, x @ y
                if abs(g) <= 1e-15 * np.sqrt(a * b):
                    continue
                turned = True
                zeta = (b - a) / (2 * g)
                t = (1.0 if zeta >= 0 else -1.0) / (abs(zeta) + np.hypot(1.0, zeta))
                cos = 1 / np.hypot(1.0, t)
                u[:, p], u[:, q] = cos * x - cos * t * y, cos * t * x + cos * y
        if not turned:
            break
    return u


def principal_components(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a scatter, falling, and its components as columns; only those above the rank's noise."""
    pivots, factor = pivoted_cholesky(scatter)
    turned = one_sided_jacobi(factor)
    norms = np.sqrt((turned * turned).sum(axis=0))
    order = np.argsort(-norms, kind="stable")
    norms = norms[order]
    parts = np.zeros_like(turned)
    parts[pivots] = turned[:, order] / norms
    largest = np.abs(parts).argmax(axis=0)
    parts *= np.sign(parts[largest, np.arange(parts.shape[1])])
    return norms * norms, parts


@dataclass(frozen=True)
class Whitening:
    """A fitted transform: (x - S/n) projected on the components, over the roots of their eigenvalues."""

    moments: Moments
    eigenvalues: np.ndarray  # of the covariance, of the components kept
    components: np.ndarray  # a column each
    explained: np.ndarray

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.moments.centred(x) @ (self.components / np.sqrt(self.eigenvalues))


def dimensions(df: DataFrame, vector: str) -> int:
    """The length most vectors have, 0 without vectors."""
    sizes = df.where(f"{vector} is not null").groupBy(F.size(vector).alias("d")).count().where("d > 0")
    first = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    return first["d"] if first else 0


def fit(df: DataFrame, vector: str, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the vectors of ``df``; None if they do not vary."""
    dims = dimensions(df, vector)
    if not dims:
        return None
    vectors = df.select(vector)
    total = F.sum(F.col("s").cast("decimal(38,0)")).cast("string").alias("s")
    sums = vectors.mapInArrow(_sum_batches(dims), "i int, s string, n long").groupBy("i").agg(total, F.sum("n").alias("n"))
    rows = sorted(sums.collect())  # one row per dimension
    if not rows:
        return None
    moments = Moments(rows[0]["n"], tuple(int(r["s"]) for r in rows))
    scatter = _summed_matrix(vectors.mapInArrow(_scatter_batches(dims, moments), "i int, row binary"), dims)
    scatter = (scatter + scatter.T) / 2
    values, parts = principal_components(scatter)
    k = min(components, len(values))
    if not k:
        return None
    return Whitening(moments, values[:k] / moments.n, parts[:, :k], values[:k] / np.trace(scatter))


def _whitened_sum_batches(dims: int, w: Whitening):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(w.eigenvalues)
        total = np.zeros((k + 1, k + 1))
        for batch in _slices(batches):
            _, x = _vectors(batch.column(0), dims)
            ones = np.column_stack([w.apply(x), np.ones(len(x))])
            total += ones.T @ ones
        yield _matrix_rows(total)

    return run


def identity_error(df: DataFrame, vector: str, w: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    dims, k = len(w.components), len(w.eigenvalues)
    parts = df.select(vector).mapInArrow(_whitened_sum_batches(dims, w), "i int, row binary")
    total = _summed_matrix(parts, k + 1) / w.moments.n
    # the whitened vectors are centred already; their means are the rounding that is left
    mean = total[k, :k]
    return float(np.abs(total[:k, :k] - np.outer(mean, mean) - np.eye(k)).max())


def _whiten_batches(dims: int, w: Whitening):
    """(key, component, deviation, whitened, explained) of every vector and component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(w.eigenvalues)
        for batch in _slices(batches):
            rows, x = _vectors(batch.column(1), dims)
            if not len(rows):
                continue
            deviation = pa.array(w.moments.deviations(x), pa.int64())
            owner = pa.array(np.repeat(np.arange(len(rows)), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows)).take(owner),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                    deviation.take(owner),
                    pa.array(w.apply(x).ravel()),
                    pa.array(np.tile(w.explained, len(rows))),
                ],
                names=["key", "component", "deviation", "whitened", "explained"],
            )

    return run


def whitened(df: DataFrame, key: str, vector: str, w: Whitening) -> DataFrame:
    """key, component, deviation, whitened and explained of every vector of ``df``."""
    kind = df.schema[key].dataType.simpleString()
    return df.select(key, vector).mapInArrow(
        _whiten_batches(len(w.components), w),
        f"key {kind}, component int, deviation long, whitened double, explained double",
    )


def op13_whiten(df: DataFrame) -> DataFrame:
    """The contract's columns for an embeddings table."""
    w = fit(df, "embedding")
    if w is None:
        empty = df.where("false").select("vec_id")
        for name, kind in (("component", "int"), ("n", "long"), ("deviation", "long")):
            empty = empty.withColumn(name, F.lit(None).cast(kind))
        for name in ("whitened", "explained", "identity_error"):
            empty = empty.withColumn(name, F.lit(None).cast("double"))
        return empty
    error = identity_error(df, "embedding", w)
    return whitened(df, "vec_id", "embedding", w).select(
        F.col("key").alias("vec_id"),
        "component",
        F.lit(w.moments.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        "explained",
        F.lit(error).alias("identity_error"),
    )
