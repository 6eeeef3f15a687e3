"""Classification: missing values, deterministic split, F1, tree grid search."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from itertools import product

from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from quarry.functions.numeric import fraction_cut, key_hash_prefix
from quarry.session import reliable, write_shared

# Fixed grid of the reference: depth 2..11 x minimum rows per leaf 2..6.
MAX_DEPTHS = [2, 3, 4, 5, 6, 7, 8, 9, 10, 11]
MIN_INSTANCES = [2, 3, 4, 5, 6]


def _all_not_null(cols: list[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def drop_missing(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows with a value in every column of ``cols``."""
    return df.where(_all_not_null(cols))


def missing_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows missing a value in any column of ``cols``."""
    return df.where(~_all_not_null(cols))


def class_counts(df: DataFrame, label: str, out: str = "n") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias(out))


def stable_split(
    df: DataFrame, key: str, train_fraction: float = 0.75, seed: int = 1234, out: str = "split"
) -> DataFrame:
    """Tag each row 'train' or 'test' from a hash of (seed, key).

    Unlike randomSplit the tag depends only on the key, not on partitioning
    or row order, so recomputing a lost partition gives the same split.
    """
    cut = fraction_cut(train_fraction)
    return df.withColumn(
        out, F.when(key_hash_prefix(key, seed) < F.lit(cut), F.lit("train")).otherwise(F.lit("test"))
    )


def unkeyed_split(df: DataFrame, train_fraction: float = 0.75, seed: int = 1234, out: str = "split") -> DataFrame:
    """``stable_split`` of rows without a key: they are numbered once, in storage, and
    split by a hash of their number. A lost executor's rows are read again with
    the same numbers, so no row changes sides; equal rows are split each by itself.
    """
    number = "_row"
    while number in df.columns:
        number = "_" + number
    numbered = write_shared(df.withColumn(number, F.monotonically_increasing_id()), "numbered")
    return stable_split(numbered, number, train_fraction, seed, out).drop(number)


def weighted_f1(df: DataFrame, label: str, prediction: str, by: str | None = None) -> DataFrame:
    """``f1``: F1 per true class weighted by class frequency (one row, or one
    row per value of ``by``).

    Equal to MulticlassClassificationEvaluator(metricName="f1"): per class
    F1 = 2 tp / (true + predicted), 0 when tp = 0. The data is read and
    aggregated once into confusion cells (classes x classes rows per group);
    each cell counts for its true and for its predicted class.
    """
    keys = [by] if by else []
    cells = confusion_counts(df, label, prediction, by)
    t, p, c = F.col("t"), F.col("p"), F.col("c")
    sides = F.array(
        F.struct(t.alias("cls"), c.alias("n_true"), F.lit(0).cast("long").alias("n_pred"), F.when(t == p, c).otherwise(0).alias("tp")),
        F.struct(p.alias("cls"), F.lit(0).cast("long").alias("n_true"), c.alias("n_pred"), F.lit(0).cast("long").alias("tp")),
    )
    per_class = cells.select(*keys, F.inline(sides)).groupBy(*keys, "cls").agg(
        F.sum("n_true").alias("n_true"), F.sum("n_pred").alias("n_pred"), F.sum("tp").alias("tp")
    )
    f1 = F.when(F.col("tp") > 0, 2 * F.col("tp") / (F.col("n_true") + F.col("n_pred"))).otherwise(0.0)
    return per_class.groupBy(*keys).agg((F.sum(F.col("n_true") * f1) / F.sum("n_true")).alias("f1"))


def confusion_counts(df: DataFrame, label: str, prediction: str, by: str | None = None) -> DataFrame:
    """(by, t, p, c): rows per (true, predicted) class pair, one aggregate."""
    keys = [by] if by else []
    return df.groupBy(
        *keys, F.col(label).cast("double").alias("t"), F.col(prediction).cast("double").alias("p")
    ).agg(F.count(F.lit(1)).alias("c"))


def f1_from_confusion(cells: list[tuple[float, float, int]]) -> float:
    """Weighted F1 from (true, predicted, count) cells; same rule as
    :func:`weighted_f1`. The input has at most classes x classes cells."""
    n_true: dict[float, int] = {}
    n_pred: dict[float, int] = {}
    tp: dict[float, int] = {}
    for t, p, c in cells:
        n_true[t] = n_true.get(t, 0) + c
        n_pred[p] = n_pred.get(p, 0) + c
        if t == p:
            tp[t] = tp.get(t, 0) + c
    total = sum(n_true.values())
    if total == 0:
        return 0.0
    score = 0.0
    for cls, nt in n_true.items():
        hit = tp.get(cls, 0)
        f1 = 2.0 * hit / (nt + n_pred.get(cls, 0)) if hit > 0 else 0.0
        score += nt * f1
    return score / total


GRID_SCHEMA = T.StructType(
    [
        T.StructField("grid_index", T.IntegerType()),
        T.StructField("max_depth", T.IntegerType()),
        T.StructField("min_instances_per_node", T.IntegerType()),
        T.StructField("train_f1", T.DoubleType()),
        T.StructField("test_f1", T.DoubleType()),
        T.StructField("is_best", T.BooleanType()),
    ]
)


def tree_grid(
    data: DataFrame,
    feature_cols: list[str],
    label: str,
    key: str,
    max_depths: list[int] = MAX_DEPTHS,
    min_instances: list[int] = MIN_INSTANCES,
    train_fraction: float = 0.75,
    split_seed: int = 1234,
    tree_seed: int = 37,
    parallelism: int = 8,
    fit_partitions: int | None = None,
) -> DataFrame:
    """Scores of every grid point; see :func:`search_trees`."""
    return search_trees(
        data, feature_cols, label, key, max_depths, min_instances, train_fraction, split_seed, tree_seed, parallelism, fit_partitions
    )[0]


def search_trees(
    data: DataFrame,
    feature_cols: list[str],
    label: str,
    key: str,
    max_depths: list[int] = MAX_DEPTHS,
    min_instances: list[int] = MIN_INSTANCES,
    train_fraction: float = 0.75,
    split_seed: int = 1234,
    tree_seed: int = 37,
    parallelism: int = 8,
    fit_partitions: int | None = None,
) -> tuple[DataFrame, PipelineModel]:
    """Fit a decision tree for every grid point; report train and test F1.

    The label indexer is fitted on all clean rows (a class absent from the
    training part cannot break scoring); indexing and assembly run once, and
    the clean rows and then the tagged training/test set are checkpointed
    (the latter also cached) before the fits, which run a few at a time. The best row is the highest test
    F1, first in grid order on ties (strictly-greater rule); its fitted tree is
    returned beside the scores, with the step from index back to label.
    ``fit_partitions`` sets the parts of the cached set (default: as read).
    """
    # Features are computed once, into a checkpoint that the missing-value
    # filter, the indexer fit and the split all read. (Filtering first would
    # let Catalyst push the not-null tests below the projection and evaluate
    # every feature expression twice.)
    computed = reliable(data.select(key, label, *feature_cols))
    clean = drop_missing(computed, [key] + feature_cols + [label])
    indexer = StringIndexer(inputCol=label, outputCol="indexedLabel").fit(clean)
    assembler = VectorAssembler(inputCols=feature_cols, outputCol="features")
    prepared = assembler.transform(indexer.transform(clean)).select(key, "features", "indexedLabel")
    tagged = reliable(stable_split(prepared, key, train_fraction, split_seed, out="_split"))
    if fit_partitions:
        tagged = tagged.coalesce(fit_partitions)
    tagged = tagged.persist(StorageLevel.MEMORY_AND_DISK)
    train = tagged.where(F.col("_split") == "train")
    converter = IndexToString(inputCol="prediction", outputCol="predictedClass", labels=indexer.labels)
    grid = list(product(max_depths, min_instances))

    def fit_one(point):
        depth, min_inst = point
        tree = DecisionTreeClassifier(
            labelCol="indexedLabel", featuresCol="features", maxDepth=depth, minInstancesPerNode=min_inst, seed=tree_seed
        )
        model = tree.fit(train)
        # Train and test F1 from one confusion-count aggregate over the tagged
        # rows (at most 2 x classes x classes cells come back).
        cells: dict[str, list] = {"train": [], "test": []}
        for r in confusion_counts(model.transform(tagged), "indexedLabel", "prediction", "_split").collect():
            cells[r["_split"]].append((r["t"], r["p"], r["c"]))
        return f1_from_confusion(cells["train"]), f1_from_confusion(cells["test"]), model

    try:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            scores = list(pool.map(fit_one, grid))
    finally:
        tagged.unpersist()
    best = None
    for i, (_, te, _) in enumerate(scores):
        if best is None or te > scores[best][1]:
            best = i
    rows = [
        (i, d, mi, float(tr), float(te), i == best) for i, ((d, mi), (tr, te, _)) in enumerate(zip(grid, scores))
    ]
    model = PipelineModel(stages=[assembler, scores[best][2], converter])
    return data.sparkSession.createDataFrame(rows, GRID_SCHEMA), model
