"""A grid of decision trees from nested fits, and trees kept for later rows.

A greedy tree of depth d is the top of the same tree grown deeper: a node's
split depends on its own rows alone. So one fit of the greatest depth for each
minimum of rows per node holds every shallower tree. The nodes of the saved
model are read back as a table; every row walks down once and notes the
prediction of the node it stands on at each depth.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from quarry.operators.classify import MAX_DEPTHS, MIN_INSTANCES, drop_missing, stable_split, weighted_f1
from quarry.session import claimed, ensure_checkpoint_dir, reliable, ship_package, write_shared


def _model_folder(spark) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/models/{uuid.uuid4().hex}"


def tree_nodes(model: DecisionTreeClassificationModel, spark) -> DataFrame:
    """(id, prediction, feature, threshold, left, right) of a tree's nodes, read
    back from the saved model. Ids count from 0 at the root; a leaf has ``left`` -1.
    Splits must be on numbers: a categorical one is an error.
    """
    folder = claimed(_model_folder(spark))
    model.write().save(folder)
    split = F.col("split")
    cut = F.when(split.numCategories < 0, F.element_at(split.leftCategoriesOrThreshold, 1)).otherwise(
        F.raise_error(F.lit("a split on categories has no threshold")).cast("double")
    )
    inner = F.col("leftChild") >= 0
    return spark.read.parquet(f"{folder}/data").select(
        "id", "prediction", F.when(inner, split.featureIndex).alias("feature"), F.when(inner, cut).alias("threshold"),
        F.col("leftChild").alias("left"), F.col("rightChild").alias("right"),
    )


def _walk(trees: list[dict[str, np.ndarray]], depth: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's predictions, tree by tree, at the depths 1 to ``depth``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        rows, seen = np.arange(batch.num_rows), []
        for tree in trees:
            at = np.zeros(batch.num_rows, dtype=np.int64)
            for _ in range(depth):
                lower = x[rows, tree["feature"][at]] <= tree["threshold"][at]
                below = np.where(lower, tree["left"][at], tree["right"][at])
                at = np.where(tree["left"][at] < 0, at, below)
                seen.append(tree["prediction"][at])
        ends = np.arange(0, (batch.num_rows + 1) * len(seen), len(seen), dtype=np.int32)
        predictions = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.stack(seen, axis=1).ravel()))
        yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("test"), predictions], ["label", "test", "predictions"])


def predictions_by_depth(rows: DataFrame, nodes: list[DataFrame], depth: int) -> DataFrame:
    """(label, test, predictions) of rows (label, test, x): by each tree, cut off at depth 1, 2 .. ``depth``.

    The nodes (fewer than 2^(depth + 1) a tree) go to every task.
    """
    ship_package(rows.sparkSession)
    trees = []
    for tree in nodes:
        held = tree.orderBy("id").collect()
        of = {c: np.array([r[c] if r[c] is not None else 0 for r in held]) for c in ("prediction", "feature", "threshold", "left", "right")}
        trees.append(of | {"prediction": of["prediction"].astype(np.float64), "threshold": of["threshold"].astype(np.float64)})
    return rows.select("label", "test", "x").mapInArrow(partial(_walk, trees, depth), "label double, test int, predictions array<double>")


def nested_grid(
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
    """The scores of ``classify.tree_grid`` from one fit per entry of ``min_instances``.

    ``grid_index, max_depth, min_instances_per_node, train_f1, test_f1,
    is_best``, the best being the highest test F1, first in grid order on ties.
    Rows with a missing value are left out, as there. One pass scores all rows at all points, one
    aggregate counts the confusion cells of the whole grid.
    """
    spark = data.sparkSession
    computed = reliable(data.select(key, label, *feature_cols))
    clean = drop_missing(computed, [key] + feature_cols + [label])
    indexer = StringIndexer(inputCol=label, outputCol="indexedLabel").fit(clean)
    prepared = VectorAssembler(inputCols=feature_cols, outputCol="features").transform(indexer.transform(clean))
    tagged = reliable(stable_split(prepared.select(key, "features", "indexedLabel"), key, train_fraction, split_seed, out="_split"))
    if fit_partitions:
        tagged = tagged.coalesce(fit_partitions)
    tagged = tagged.persist(StorageLevel.MEMORY_AND_DISK)
    train, deepest = tagged.where(F.col("_split") == "train"), max(max_depths)

    def fit(least: int) -> DataFrame:
        tree = DecisionTreeClassifier(
            labelCol="indexedLabel", featuresCol="features", maxDepth=deepest, minInstancesPerNode=least, seed=tree_seed
        )
        return tree_nodes(tree.fit(train), spark)

    try:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            trees = list(pool.map(fit, min_instances))
        x = tagged.select(F.col("indexedLabel").alias("label"), (F.col("_split") == "test").cast("int").alias("test"), vector_to_array("features").alias("x"))
        points = [
            F.struct(F.lit(d * len(min_instances) + m).alias("point"), F.get("predictions", F.lit(m * deepest + depth - 1)).alias("prediction"))
            for d, depth in enumerate(max_depths) for m in range(len(min_instances))
        ]
        rows = predictions_by_depth(x, trees, deepest).select("label", "test", F.inline(F.array(*points)))
        rows = rows.withColumn("_by", F.col("point") * 2 + F.col("test"))
        f1 = write_shared(weighted_f1(rows, "label", "prediction", "_by"), "grid-scores")  # a row per point and side
    finally:
        tagged.unpersist()
    grid = [(i, d, m) for i, (d, m) in enumerate((d, m) for d in max_depths for m in min_instances)]
    out = spark.createDataFrame(grid, "grid_index int, max_depth int, min_instances_per_node int")
    for side, name in enumerate(("train_f1", "test_f1")):
        one = f1.where(F.col("_by") % 2 == side).select(F.expr("_by div 2").cast("int").alias("grid_index"), F.col("f1").alias(name))
        out = out.join(one, "grid_index", "left").withColumn(name, F.coalesce(name, F.lit(0.0)))
    best = out.agg(F.max(F.struct("test_f1", -F.col("grid_index"))).alias("b")).select((-F.col("b.col2")).alias("i")).scalar()
    return out.withColumn("is_best", F.col("grid_index") == best)


def fit_and_save(
    rows: DataFrame, feature_cols: list[str], label: str, max_depth: int, min_instances: int = 1, seed: int = 37, folder: str | None = None
) -> str:
    """Fit indexer, assembler, tree and the step back to labels; save them and return the folder.

    Null labels are left out of the fit. At prediction a label never seen, or
    a null one, takes no part: the model reads features alone. The folder is one
    of the shared folder's own unless given.
    """
    folder = folder or _model_folder(rows.sparkSession)
    known = rows.where(F.col(label).isNotNull())
    # Labels that come up later but not here get an index of their own, which no tree predicts.
    indexer = StringIndexer(inputCol=label, outputCol="indexedLabel", handleInvalid="keep").fit(known)
    steps = [
        indexer,
        VectorAssembler(inputCols=feature_cols, outputCol="features"),
        DecisionTreeClassifier(labelCol="indexedLabel", featuresCol="features", maxDepth=max_depth, minInstancesPerNode=min_instances, seed=seed),
        IndexToString(inputCol="prediction", outputCol="predictedClass", labels=[*indexer.labels, "__unknown"]),
    ]
    Pipeline(stages=steps).fit(known).write().save(folder)
    return folder


def apply_saved(folder: str, rows: DataFrame) -> DataFrame:
    """``rows`` with ``predictedClass`` by the pipeline saved in ``folder``."""
    model = PipelineModel.load(folder)
    out = PipelineModel(stages=model.stages[1:]).transform(rows)  # without the label's indexer
    return out.select(*rows.columns, "predictedClass")
