"""Toxicity: a linear model over character n-grams scaled by naive Bayes ratios.

A text's features are the character n-grams it holds, hashed to buckets. On a
bounded sample of labelled rows the log-count ratio of every bucket is taken
(how much likelier the bucket is in texts of label 1), the buckets that tell the
labels apart best are kept, and a logistic regression is fitted on presence
times ratio. Scoring is one pass over whole texts with a fixed weight table;
nothing is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm import labelled
from quarry.llm.common import free_name, staged, values, worker_state
from quarry.session import ship_package

ORDERS = (4, 6)
BUCKETS = 1 << 22
SAMPLE_ROWS = 4000
"""Bound on the labelled documents of each label that the model is fitted on."""
FEATURES = 4096
"""Buckets that keep a weight."""
FOLDS, FOLD = 3, 1
"""Labels of ids on this fold are never learned."""
REGULARISATION = 1e-4
_STEP = 1 << 18  # characters of a text taken at once


def buckets_of(text: str | None) -> Iterator[np.ndarray]:
    """Buckets of the character n-grams of a text in lower case, with repeats."""
    lowered = (text or "").lower()
    longest = max(ORDERS)
    for at in range(0, len(lowered), _STEP):
        # Code points, so that an n-gram is as many characters in any script.
        part = np.frombuffer(lowered[at : at + _STEP + longest - 1].encode("utf-32-le"), dtype="<u4")
        h = np.zeros(len(part), dtype=np.uint32)
        for n in range(1, longest + 1):
            if len(part) < n:
                break
            h = h[: len(part) - n + 1] * np.uint32(0x01000193) + part[n - 1 :]
            if n in ORDERS:
                mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
                yield (mixed ^ (mixed >> np.uint32(13))) & np.uint32(BUCKETS - 1)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of either label that hold each bucket, among those of this task."""
    worker_state("toxicity-counts")
    held = np.zeros((2, BUCKETS), dtype=np.int32)
    for batch in batches:
        for text, y in zip(values(batch.column("text")), values(batch.column("y")), strict=True):
            parts = list(buckets_of(text))
            if parts:
                held[y, np.unique(np.concatenate(parts))] += 1
    some = np.flatnonzero(held.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(some, pa.int64()), pa.array(held[1, some], pa.int64()), pa.array(held[0, some], pa.int64())],
        ["bucket", "pos", "neg"],
    )


@dataclass(frozen=True)
class Model:
    """Buckets in ascending order, their weights (ratio times coefficient) and the intercept."""

    buckets: tuple[int, ...]
    weights: tuple[float, ...]
    intercept: float


def _places(buckets: tuple[int, ...]) -> np.ndarray:
    """Number of the feature of each bucket, or -1."""
    place = np.full(BUCKETS, -1, dtype=np.int16 if len(buckets) < 1 << 15 else np.int32)
    place[list(buckets)] = np.arange(len(buckets))
    return place


def features_of(text: str | None, buckets: tuple[int, ...]) -> np.ndarray:
    place = worker_state("toxicity", buckets, partial(_places, buckets))
    hits = [f[f >= 0] for f in (place[b] for b in buckets_of(text))]
    return np.unique(np.concatenate(hits)) if hits else np.empty(0, dtype=np.int32)


_VECTORS = T.StructType([T.StructField("features", VectorUDT()), T.StructField("y", T.DoubleType())])


def _vectors(buckets: tuple[int, ...], ratios: list[float], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse vectors of the ratios of the features that each text holds, as Spark stores vectors."""
    ratio = np.array(ratios)
    for batch in batches:
        found = [features_of(t, buckets) for t in values(batch.column("text"))]
        n = len(found)
        vectors = pa.StructArray.from_arrays(
            [
                pa.array(np.zeros(n, dtype=np.int8)),
                pa.array([len(buckets)] * n, pa.int32()),
                pa.array([f.tolist() for f in found], pa.list_(pa.int32())),
                pa.array([ratio[f].tolist() for f in found], pa.list_(pa.float64())),
            ],
            ["type", "size", "indices", "values"],
        )
        yield pa.RecordBatch.from_arrays([vectors, batch.column("y").cast(pa.float64())], ["features", "y"])


def fit_model(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
    rows: int = SAMPLE_ROWS,
    features: int = FEATURES,
) -> Model:
    """Fit on up to ``rows`` learnable documents of each label.

    Without documents of both labels the model has no weights and every score is 0.
    """
    ship_package(docs.sparkSession)
    ids, odds = labelled.sample(labels, label_col, id_col, FOLDS, FOLD, rows)
    # 2 * rows ids at most: the broadcast is bounded.
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "id")
    known = staged(known.select("text", "y"), "toxic-sample")
    size = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    if not size.get(0) or not size.get(1):
        return Model((), (), -math.inf)
    pos, neg = float(size[1]), float(size[0])
    counts = known.mapInArrow(_counts, "bucket long, pos long, neg long").groupBy("bucket").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    p, q = F.col("pos") / pos, F.col("neg") / neg
    both = (F.col("pos") + F.col("neg")) / (pos + neg)
    clear = (p - q) * (p - q) / (both * (1 - both) + 1 / (pos + neg))
    ratio = F.log((F.col("pos") + 1) / (pos + 2)) - F.log((F.col("neg") + 1) / (neg + 2))
    best = counts.select("bucket", clear.alias("clear"), ratio.alias("ratio")).orderBy(F.desc("clear"), "bucket").limit(features)
    best = sorted((r.bucket, r.ratio) for r in best.collect())  # ``features`` rows at most
    buckets, ratios = tuple(b for b, _ in best), [r for _, r in best]

    train = known.mapInArrow(partial(_vectors, buckets, ratios), _VECTORS)
    train = staged(train, "toxic-features").persist()
    try:
        weights, intercept = labelled.fit(train, odds, REGULARISATION)
    finally:
        train.unpersist()
    return Model(buckets, tuple(w * r for w, r in zip(weights, ratios, strict=True)), intercept)


def scorer(model: Model) -> Callable[[str], Column]:
    """Score of a text column, 0 to 1. Null counts as empty; an empty text has the score of no feature."""

    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weights = np.array(model.weights)
        for part in texts:
            if not model.buckets:
                yield pa.array(np.zeros(len(part)))
                continue
            z = np.array([model.intercept + weights[features_of(t, model.buckets)].sum() for t in values(part)])
            yield pa.array(1 / (1 + np.exp(-np.clip(z, -700, 700))))

    return F.arrow_udf(score, "double")


def toxicity(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score of every row of ``docs``: ``doc_id, held_out, score, predicted``.

    Rows with equal texts get equal scores, whatever their ids; other columns
    are not read. ``predicted`` is 1 from a score of 0.7.
    """
    score = scorer(fit_model(docs, labels, label_col, id_col, text_col))
    out = docs.select(
        F.col(id_col).alias("doc_id"), labelled.held_out(id_col, FOLDS, FOLD).alias("held_out"), score(text_col).alias("score")
    )
    return out.withColumn("predicted", labelled.predicted("score"))


def drop_toxic(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with their columns."""
    score, name = scorer(fit_model(docs, labels, label_col, id_col, text_col)), free_name(docs, "_score")
    return docs.withColumn(name, score(text_col)).where(labelled.predicted(name) == 0).drop(name)
