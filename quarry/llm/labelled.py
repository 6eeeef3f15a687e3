"""Bounded samples of labelled documents, and the logistic fit on them."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.7


def held_out(id_col: str, folds: int, fold: int) -> Column:
    """Whether the row's label may not be learned: crc32 of the id as text falls on ``fold``."""
    crc = F.crc32(F.col(id_col).cast("string").cast("binary"))
    return F.coalesce(crc % folds == fold, F.lit(False))


def sample(labels: DataFrame, label_col: str, id_col: str, folds: int, fold: int, rows: int) -> tuple[DataFrame, float]:
    """``id, y`` of up to ``rows`` learnable documents of each label, by hash of
    the id, and the log-odds of label 1 among all learnable ones.

    Null ids and labels are left out; of several labels of an id the largest counts.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col, folds, fold))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("y"))
    some = known.where("y = 0").orderBy(F.xxhash64("id"), "id").limit(rows)
    some = some.unionByName(known.where("y = 1").orderBy(F.xxhash64("id"), "id").limit(rows))
    n = known.agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg")).first()
    odds = ((n.pos or 0) + 0.5) / ((n.neg or 0) + 0.5)
    return some, odds


def fit(rows: DataFrame, odds: float, reg: float) -> tuple[list[float], float]:
    """Weights and intercept of a logistic regression on ``rows(features, y)``,
    the intercept moved from the sample's odds to ``odds``. Without both labels
    the weights are empty: nothing can be told apart."""
    import math

    n = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    if not n.get(0) or not n.get(1):
        return [], -math.inf
    model = LogisticRegression(featuresCol="features", labelCol="y", regParam=reg, maxIter=60, standardization=False).fit(rows)
    shift = math.log(odds) - math.log((n[1] + 0.5) / (n[0] + 0.5))
    return model.coefficients.toArray().tolist(), model.intercept + shift


def predicted(score: str) -> Column:
    return F.when(F.col(score) >= THRESHOLD, 1).otherwise(0)
