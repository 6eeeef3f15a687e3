"""Principal components of wide, sparse rows without a d x d matrix.

A randomised range finder: a random subspace of ``k`` and some more directions
is multiplied by the centred rows and their transpose a few times, then holds
the leading components. A pass streams the sparse rows of each task; sums of
tasks are added by Spark, block by block. At the end the rows are projected and
their QR is taken task by task and level by level (a stack of triangles gives
the triangle of them all); the singular values of the last one are those of the
projected rows. The driver holds the subspace alone, d x (k + oversample) numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import ship_package, write_shared

_ENTRIES = 1 << 14  # non-zero entries multiplied at once
_BLOCK = 256  # rows of the subspace summed together
_FAN = 16  # triangles stacked at once
_FULL = 64  # rows with one entry or more in so many places are multiplied as a full matrix


def _sparse(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row starts, columns, values) of the batch's vectors, some rows at a time."""
    kind, indices, values = (batch.column("v").field(f) for f in ("type", "indices", "values"))
    size = values.value_lengths().to_numpy(zero_copy_only=False)
    ends = np.cumsum(size)
    sparse = np.repeat(kind.to_numpy(zero_copy_only=False) == 0, size)
    cols = np.arange(len(sparse)) - np.repeat(ends - size, size)  # a dense vector's entries in turn
    cols[sparse] = indices.flatten().to_numpy(zero_copy_only=False)
    values = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    row = 0
    while row < len(size):
        first = int(ends[row] - size[row])
        to = min(len(size), int(np.searchsorted(ends, first + _ENTRIES)) + 1)
        yield ends[row:to] - size[row:to] - first, cols[first : ends[to - 1]], values[first : ends[to - 1]]
        row = to


def _full(width: int, starts: np.ndarray, cols: np.ndarray, values: np.ndarray) -> np.ndarray | None:
    """The rows with their zeros, unless these are too many."""
    if len(cols) * _FULL < len(starts) * width:
        return None
    out = np.zeros((len(starts), width))
    out[np.repeat(np.arange(len(starts)), np.diff(starts, append=len(cols))), cols] = values
    return out


def _projected(q: np.ndarray, shift: np.ndarray, starts: np.ndarray, cols: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Centred rows times the subspace."""
    full = _full(len(q), starts, cols, values)
    if full is not None:
        return full @ q - shift
    out = np.zeros((len(starts), q.shape[1]))
    size = np.diff(starts, append=len(cols))
    some = size > 0  # a row without entries is minus the mean
    if some.any():
        out[some] = np.add.reduceat(q[cols] * values[:, None], starts[some], axis=0)
    return out - shift


def _multiplied(q: np.ndarray, mean: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The task's share of (centred rows)^T (centred rows) q, in blocks of rows."""
    total, ones, shift = np.zeros_like(q), np.zeros(q.shape[1]), mean @ q
    for batch in batches:
        for starts, cols, values in _sparse(batch):
            full = _full(len(q), starts, cols, values)
            z = _projected(q, shift, starts, cols, values) if full is None else full @ q - shift
            ones += z.sum(axis=0)
            if full is not None:
                total += full.T @ z
                continue
            row = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(cols)))
            order = np.argsort(cols, kind="stable")
            held, first = np.unique(cols[order], return_index=True)
            if len(held):
                total[held] += np.add.reduceat(z[row[order]] * values[order, None], first, axis=0)
    total -= np.outer(mean, ones)
    for at in range(0, len(total), _BLOCK):
        yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([total[at : at + _BLOCK].tobytes()], pa.binary())], ["at", "sum"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, total = None, None
    for batch in batches:
        for place, raw in zip(*batch.columns, strict=True):
            at, part = place.as_py(), np.frombuffer(raw.as_py())
            total = part.copy() if total is None else total + part
    yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([total.tobytes()], pa.binary())], ["at", "sum"])


def _triangle(rows: np.ndarray) -> np.ndarray:
    """R of a QR of ``rows``, square: fewer rows than columns are filled up with zeros."""
    size = rows.shape[1]
    if len(rows) < size:
        rows = np.concatenate([rows, np.zeros((size - len(rows), size))])
    return np.linalg.qr(rows, mode="r")


def _triangles(q: np.ndarray, mean: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """R of the task's projected rows."""
    from pyspark import TaskContext

    r, shift = np.zeros((q.shape[1], q.shape[1])), mean @ q
    for batch in batches:
        for part in _sparse(batch):
            r = _triangle(np.concatenate([r, _projected(q, shift, *part)]))
    yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([r.tobytes()], pa.binary())], ["part", "r"])


def _stacked(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """R of some triangles on top of one another."""
    part, r = None, np.zeros((size, size))
    for batch in batches:
        for place, raw in zip(*batch.columns, strict=True):
            part = place.as_py()
            r = _triangle(np.concatenate([r, np.frombuffer(raw.as_py()).reshape(size, size)]))
    yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([r.tobytes()], pa.binary())], ["part", "r"])


def randomised_pca(
    df: DataFrame, k: int, features: str = "features", oversample: int = 100, rounds: int = 4, seed: int = 1
) -> tuple[np.ndarray, np.ndarray]:
    """(components d x k, shares of the total variance) of a vector column.

    With ``k + oversample`` of d or more the result is exact but for rounding;
    below, each of the ``rounds`` sharpens it. Signs are as they fall. Null vectors
    are left out. Fewer rows or dimensions than ``k`` give fewer components, no
    rows none. As in Spark's PCA the covariance is centred.
    """
    spark = df.sparkSession
    ship_package(spark)
    rows = write_shared(df.where(F.col(features).isNotNull()).select(F.col(features).alias("v")), "pca-rows")
    if rows.isEmpty():
        return np.zeros((0, 0)), np.zeros(0)
    s = rows.agg(Summarizer.metrics("mean", "variance", "count").summary(F.col("v")).alias("s"))
    first = s.select("s.count", vector_to_array("s.mean").alias("mean"), vector_to_array("s.variance").alias("variance")).first()
    n, mean, total = first["count"], np.array(first["mean"]), float(np.sum(first["variance"]))
    size = min(len(mean), k + oversample)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(mean), size)))[0]

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _added(batches)

    def stacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _stacked(size, batches)

    for _ in range(rounds if size < len(mean) else 0):
        parts = rows.mapInArrow(partial(_multiplied, q, mean), "at long, sum binary")
        blocks = parts.groupBy("at").applyInArrow(added, "at long, sum binary").collect()  # d x (k + oversample) numbers
        q = np.linalg.qr(np.concatenate([np.frombuffer(b["sum"]).reshape(-1, size) for b in sorted(blocks, key=lambda b: b["at"])]))[0]
    triangles = write_shared(rows.mapInArrow(partial(_triangles, q, mean), "part int, r binary"), "pca-triangles")
    last = triangles.agg(F.max("part")).first()[0]
    while True:
        triangles = triangles.select(F.expr(f"part div {_FAN}").cast("int").alias("part"), "r").groupBy("part").applyInArrow(stacked, "part int, r binary")
        last //= _FAN
        if last == 0:
            break
    r = np.frombuffer(triangles.first()["r"]).reshape(size, size)
    _, values, turn = np.linalg.svd(r)
    k = min(k, size, n)
    return q @ turn[:k].T, values[:k] ** 2 / max(n - 1, 1) / (total or 1.0)
