"""Exact integer k-means with a LAESA pivot table.

The distances of every vector to a few fixed pivots are computed once and stored
beside it. In each round the differences of pivot distances bound a vector's
distance to every centroid from below (triangle inequality); centroids whose
bound exceeds the best distance found so far are skipped, the others get their
exact integer distance. Sums and counts of a round are added up by Spark, the
centroids (``k`` rows) are all that the driver holds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import staged
from quarry.session import ship_package

CENTROIDS = 40
ROUNDS = 5
PIVOTS = 8
SCALE = 256
ROUNDING = 1e-15
"""More than the share of two distances by which their difference is wrong, each a rounded root of a rounded square."""
_AT_ONCE = 4096  # vectors whose bounds are held at once


def start_order(id_col: str, k: int = 2) -> Column:
    """Order in which vectors become the first centroids: sha256 of ``k:<id>``, null ids last."""
    return F.coalesce(F.sha2(F.concat(F.lit(f"{k}:"), F.col(id_col).cast("long").cast("string")), 256), F.lit("~"))


def largest(size: int) -> int:
    """Largest integer of a component with which any squared distance of ``size`` components fits a long."""
    return math.isqrt(((1 << 63) - 1) // max(1, size)) // 2


def integers(vectors: DataFrame, id_col: str, vector_col: str, size: int) -> DataFrame:
    """``vec_id, v``: floor(256 x) of the vectors with ``size`` finite components; others are left out."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    kept = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("x")).where((F.size(v) == size) & finite)
    scaled = F.transform("x", lambda x: F.floor(x.cast("double") * SCALE))
    within = F.forall("v", lambda x: F.abs(x) <= largest(size))
    name = F.coalesce(F.col("vec_id").cast("string"), F.lit("without id"))
    too_large = F.raise_error(F.concat(F.lit(f"component beyond {largest(size) / SCALE:.0f} in vector "), name))
    return kept.select("vec_id", scaled.alias("v")).withColumn("v", F.when(within, F.col("v")).otherwise(too_large.cast("array<long>")))


def _matrix(batch: pa.RecordBatch, column: str, kind: type) -> np.ndarray:
    values = batch.column(column)
    return values.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(values), -1)


def _lists(rows: np.ndarray) -> pa.Array:
    ends = np.arange(0, rows.size + 1, max(1, rows.shape[1]), dtype=np.int32)[: len(rows) + 1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel()))


def squares(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of ``v`` and ``w`` (or one ``w``)."""
    d = v - w
    return np.einsum("ij,ij->i", d, d)


def _measure(pivots: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pivot table: vectors with their distances to the pivots."""
    for batch in batches:
        if not batch.num_rows:
            continue
        v = _matrix(batch, "v", np.int64)
        far = np.sqrt(np.stack([squares(v, p) for p in pivots], axis=1).astype(np.float64))
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), _lists(far)], ["vec_id", "v", "pivots"])


def nearest(v: np.ndarray, far: np.ndarray, centroids: np.ndarray, centre_far: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of the nearest centroid (of equal ones the
    smallest number), and how many exact distances that took."""
    n = len(v)
    bound = np.zeros((n, len(centroids)))
    for j in range(far.shape[1]):
        x, y = far[:, j, None], centre_far[None, :, j]
        # Of two long distances that are nearly equal little but rounding is left: it is taken off.
        np.maximum(bound, np.abs(x - y) - ROUNDING * (x + y), out=bound)
    # The square and the comparison with a long are wrong by far less than this share.
    bound = np.square(bound * (1 - 1e-9)) * (1 - 1e-9)
    which = bound.argmin(axis=1)
    best = squares(v, centroids[which])
    exact = n
    for c, centroid in enumerate(centroids):
        near = np.flatnonzero((bound[:, c] <= best) & (which != c))
        if not len(near):
            continue
        d = squares(v[near], centroid)
        exact += len(near)
        better = (d < best[near]) | ((d == best[near]) & (c < which[near]))
        best[near[better]], which[near[better]] = d[better], c
    return which, best, exact


def _assigned(pivots: np.ndarray, centroids: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    centre_far = np.sqrt(np.stack([squares(centroids, p) for p in pivots], axis=1).astype(np.float64))
    for whole in batches:
        for at in range(0, whole.num_rows, _AT_ONCE):
            batch = whole.slice(at, _AT_ONCE)
            v, far = _matrix(batch, "v", np.int64), _matrix(batch, "pivots", np.float64)
            yield batch.column("vec_id"), v, *nearest(v, far, centroids, centre_far)[:2]


def _sums(pivots: np.ndarray, centroids: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count and componentwise sum of each centroid's vectors in this task."""
    k, size = centroids.shape
    n, total = np.zeros(k, dtype=np.int64), np.zeros((k, size), dtype=np.int64)
    for _, v, which, _ in _assigned(pivots, centroids, batches):
        n += np.bincount(which, minlength=k)
        order = np.argsort(which, kind="stable")
        some, first = np.unique(which[order], return_index=True)
        total[some] += np.add.reduceat(v[order], first, axis=0)
    some = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some]), _lists(total[some])], ["cluster", "n", "total"])


def _places(pivots: np.ndarray, centroids: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, _, which, best in _assigned(pivots, centroids, batches):
        yield pa.RecordBatch.from_arrays([ids, pa.array(which.astype(np.int32)), pa.array(best)], ["vec_id", "cluster", "distance"])


def cluster(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    size: int = 64,
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    pivots: int = PIVOTS,
) -> DataFrame:
    """Nearest centroid of every vector after ``rounds`` rounds, exactly.

    ``vec_id, cluster, distance, cluster_inertia, inertia, centroid``, a row per
    vector with ``size`` components, none null or non-finite; others are left
    out, and without any the result is empty. Components x count as floor(256 x),
    of which ``largest(size)`` is the bound (an error beyond: a squared distance would not fit a long).
    The first centroids are the ``k`` vectors (or all, if fewer) with the smallest
    sha256 of ``2:<vec_id>``; null ids come last, and rows of one id by their
    components. Of equally near centroids the smaller number counts; an empty
    one stays where it is. Repeated rows are vectors of their own. ``distance`` is squared, the inertias
    are its sums over the cluster and over all. Other columns are not read.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    whole = integers(vectors, id_col, vector_col, size)
    first = whole.orderBy(start_order("vec_id"), "vec_id", "v").limit(k).collect()
    centroids = np.array([r.v for r in first], dtype=np.int64).reshape(-1, size)
    fixed = spread(centroids, pivots)
    table = staged(whole.mapInArrow(partial(_measure, fixed), "vec_id long, v array<long>, pivots array<double>"), "laesa-pivots")
    for _ in range(rounds if len(first) else 0):
        parts = table.mapInArrow(partial(_sums, fixed, centroids), "cluster long, n long, total array<long>")
        counts = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *(F.sum(F.get("total", F.lit(j))).alias(f"s{j}") for j in range(size)))
        for r in counts.collect():  # a row per centroid
            centroids[r.cluster] = np.array(r[2:], dtype=np.int64) // r.n
    shape = "vec_id long, cluster int, distance long"
    placed = table.mapInArrow(partial(_places, fixed, centroids), shape) if len(first) else spark.createDataFrame([], shape)
    placed = staged(placed, "laesa-placed")
    sums = {r.cluster: r.s for r in placed.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    total = sum(sums.values())
    rows = [(c, s, total, centroids[c].tolist()) for c, s in sums.items()]
    shape = "cluster int, cluster_inertia long, inertia long, centroid array<long>"
    return placed.join(F.broadcast(spark.createDataFrame(rows, shape)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )


def spread(centroids: np.ndarray, pivots: int) -> np.ndarray:
    """Some of the first centroids, each as far as can be from those before it."""
    chosen = list(range(min(1, len(centroids))))
    far = squares(centroids, centroids[0]) if chosen else None
    while chosen and len(chosen) < min(pivots, len(centroids)):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, squares(centroids, centroids[chosen[-1]]))
    return centroids[chosen].reshape(len(chosen), centroids.shape[1])
