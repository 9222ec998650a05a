"""Embedding whitening: a two-pass covariance and the projection on its leading components.

An entry c becomes the integer x = floor(1024 * c) + 100000. The first pass sums x exactly, so
the mean is exact; the second sums outer products of x minus the mean, a matrix product (GEMM)
for each batch, and `treeAggregate` merges the tasks' matrices. The symmetric eigenproblem is
solved by LAPACK on the driver, whose matrix has the square of the dimensions whatever the rows,
and the projection is broadcast. A third pass measures the covariance of what was projected.

Cases: rows whose vector is null or empty, or holds null or non-finite entries, are dropped. So
are vectors of another length than most have (of equally many, the longer). Entries beyond +-2^40 count
as that. Repeated rows and ids are rows of their own. Components
whose eigenvalue isn't above the rounding of the largest have no whitened values and are left
out: of a single vector, or of copies of one, nothing remains. Empty tables give no rows; other
columns play no part. A deviation that a 64-bit integer can't hold is null in `deviation` and whole
in `deviation_exact`.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FACTOR, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Dimensions at most: the driver's matrix has their square of doubles.
DIMENSIONS = 4096
#: Floats of a batch that are handled at once.
CHUNK = 1 << 20
_LIMIT = float(1 << 40)
_LOW = (1 << 20) - 1


def integers(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of vectors, by length: (their places in the batch, x as a matrix), of those without null or non-finite entries."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.asarray(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), np.int64)
    flat = column.flatten()  # leaves null vectors out, as sizes does
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # a null entry becomes NaN
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else sizes
    for size in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == size)
        for k in range(0, len(rows), max(1, CHUNK // int(size))):
            own = rows[k : k + max(1, CHUNK // int(size))]
            m = values[starts[own][:, None] + np.arange(size)]
            good = np.isfinite(m).all(axis=1)
            if good.any():
                yield own[good], np.floor(np.clip(FACTOR * m[good], -_LIMIT, _LIMIT)).astype(np.int64) + SHIFT


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(size, n, high, low): exact sums of a task's vectors, in two halves that can't overflow."""
    found: dict[int, list] = {}
    for batch in batches:
        for _, x in integers(batch.column(0)):
            own = found.setdefault(x.shape[1], [0, np.zeros(x.shape[1], np.int64), np.zeros(x.shape[1], np.int64)])
            own[0] += len(x)
            own[1] += (x >> 20).sum(axis=0)
            own[2] += (x & _LOW).sum(axis=0)
    if found:
        cols = [pa.array(list(found), pa.int32()), pa.array([x[0] for x in found.values()], pa.int64()), *(pa.array([x[k].tolist() for x in found.values()], pa.list_(pa.int64())) for k in (1, 2))]
        yield pa.RecordBatch.from_arrays(cols, names=["size", "n", "high", "low"])


def exact_sums(vectors: DataFrame) -> tuple[int, int, list[int]]:
    """(dimensions, n, sums) of the vectors of the commonest length."""
    parts = vectors.mapInArrow(_sums, "size int, n long, high array<long>, low array<long>")
    sizes = parts.groupBy("size").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("size")).limit(1).collect()
    if not sizes:
        return 0, 0, []
    size, n = sizes[0]
    if size > DIMENSIONS:
        raise ValueError(f"vectors of {size} dimensions; {DIMENSIONS} at most")
    big = lambda c: F.sum(F.col(f"x.{c}").cast("decimal(38,0)")).alias(c)
    each = parts.where(F.col("size") == size).select(F.posexplode(F.arrays_zip("high", "low")).alias("at", "x"))
    rows = each.groupBy("at").agg(big("high"), big("low")).collect()  # a row for each dimension
    return size, n, [int(r.high) * (_LOW + 1) + int(r.low) for r in sorted(rows, key=lambda r: r.at)]


class Centred:
    """n * x - S as exact integers, and the centred entries as doubles, rounded once."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.small = n * (int(_LIMIT) + SHIFT) < 1 << 62

    def deviations(self, x: np.ndarray) -> np.ndarray:
        if self.small or self.n * int(np.abs(x).max()) < 1 << 61:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def entries(self, d: np.ndarray) -> np.ndarray:
        return d.astype(np.float64) / self.n


def _products(n: int, sums: list[int], basis: np.ndarray | None = None):
    """A task's sum of outer products of centred vectors, or of their projections."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centred = Centred(n, sums)
        size = len(sums) if basis is None else basis.shape[1]
        total, seen = np.zeros((size, size)), False
        for batch in batches:
            for _, x in integers(batch.column(0)):
                if x.shape[1] == len(sums):
                    c = centred.entries(centred.deviations(x))
                    c = c if basis is None else c @ basis
                    total += c.T @ c
                    seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["m"])

    return run


def covariance(vectors: DataFrame, n: int, sums: list[int], basis: np.ndarray | None = None) -> np.ndarray:
    """Divided by n; of the projections on `basis`, if given."""
    size = len(sums) if basis is None else basis.shape[1]
    parts = vectors.mapInArrow(_products(n, sums, basis), "m binary").rdd
    add = lambda a, r: a + np.frombuffer(r.m, np.float64).reshape(size, size)
    return parts.treeAggregate(np.zeros((size, size)), add, np.add, depth=2) / n


def components(v: np.ndarray, count: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, falling; eigenvectors as columns, the largest entry of each positive)."""
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:count], u[:, ::-1][:, :count]
    keep = e > max(0.0, float(e[0])) * len(v) * np.finfo(np.float64).eps if len(e) else e > 0
    e, u = e[keep], u[:, keep]
    signs = np.sign(u[np.abs(u).argmax(axis=0), np.arange(u.shape[1])]) if u.shape[1] else np.ones(0)
    return e, u * signs


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """id, component, n, deviation, deviation_exact, whitened, explained, identity_error."""
    vectors = df.select(F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    kept = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    kind = kept.schema["id"].dataType.simpleString()
    schema = f"`{id_col}` {kind}, component int, n long, deviation long, deviation_exact decimal(38,0), whitened double, explained double, identity_error double"
    size, n, sums = exact_sums(vectors)
    v = covariance(vectors, n, sums) if n else np.zeros((0, 0))
    e, u = components(v, count) if n else (np.zeros(0), np.zeros((0, 0)))
    if not len(e):
        return df.sparkSession.createDataFrame([], schema)
    basis = u / np.sqrt(e)
    error = float(np.abs(covariance(vectors, n, sums, basis) - np.eye(len(e))).max())
    explained = e / np.trace(v)
    shared = df.sparkSession.sparkContext.broadcast((n, sums, basis, explained))
    k = len(e)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, basis, explained = shared.value
        centred = Centred(n, sums)
        for batch in batches:
            for rows, x in integers(batch.column(1)):
                if x.shape[1] != len(sums):
                    continue
                d = centred.deviations(x)
                if d.dtype == np.int64 and int(np.abs(d).max()) ** 2 * size < 1 << 63:
                    exact = (d * d).sum(axis=1).tolist()
                else:
                    exact = (d.astype(object) ** 2).sum(axis=1).tolist()
                times = lambda values, kind: pa.array(values, kind).take(pa.array(np.repeat(np.arange(len(x)), k)))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(np.repeat(rows, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(x) * k, n, np.int64)),
                        times([y if y < 1 << 63 else None for y in exact], pa.int64()), times([Decimal(y) if y < 10**38 else None for y in exact], pa.decimal128(38, 0)),
                        pa.array((centred.entries(d) @ basis).ravel()), pa.array(np.tile(explained, len(x))), pa.array(np.full(len(x) * k, error)),
                    ],
                    names=[id_col, "component", "n", "deviation", "deviation_exact", "whitened", "explained", "identity_error"],
                )

    return kept.mapInArrow(run, schema)
