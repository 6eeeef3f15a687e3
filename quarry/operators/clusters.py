"""K-means clustering, silhouette and per-cluster profiles.

Profiles are ONE aggregate keyed by cluster (size, label share and the mean
of every feature), where the reference ran a driver loop of 2-3 jobs per
cluster and per feature. The mean of a 0/1 feature inside a cluster is the
cluster's centre in the original one-hot space, with or without PCA.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from quarry.operators.features import feature_names, ranked_top_k
from quarry.session import claimed, ensure_checkpoint_dir, write_shared

REPEATED = 32  # rows of a vector, on average, from which rounds run on weighted vectors
SPARED = 1 << 21  # and rows of all, worth the fixed time of such a round


def _with_centers(start: KMeansModel, folder: str, centers: np.ndarray) -> KMeansModel:
    """The saved model ``start`` with other centres, in the form Spark saves models in."""
    spark = SparkSession.active()
    saved = spark.read.parquet(f"{folder}/start/data").schema
    rows = [(i, Vectors.dense(c)) for i, c in enumerate(centers)]
    path = f"{folder}/{uuid.uuid4().hex}"
    spark.read.text(f"{folder}/start/metadata").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame(rows, saved).coalesce(1).write.parquet(f"{path}/data")
    return type(start).load(path)


def _rounds(start: KMeansModel, points: DataFrame, features: str, max_iter: int, tol: float) -> KMeansModel:
    """Lloyd rounds from a fitted start over distinct vectors and their ``_weight``: sums, and so centres, are those of the rows."""
    folder = claimed(f"{ensure_checkpoint_dir(points.sparkSession).rstrip('/')}/models/kmeans-{uuid.uuid4().hex}")
    start.write().save(f"{folder}/start")
    model, centers = start, np.array(start.clusterCenters(), dtype=float)
    for _ in range(max_iter):
        placed = model.transform(points).select(F.col(model.getPredictionCol()).alias("_c"), "_weight", F.posexplode(vector_to_array(features)).alias("_at", "_x"))
        sums = placed.groupBy("_c", "_at").agg(F.sum(F.col("_weight") * F.col("_x")).alias("_sum"), F.sum("_weight").alias("_n"))
        new = centers.copy()  # a cluster without rows keeps its centre
        for r in sums.collect():  # k x d sums
            new[r["_c"], r["_at"]] = r["_sum"] * (1.0 / r["_n"])
        still = bool((((new - centers) ** 2).sum(axis=1) <= tol * tol).all())
        model, centers = _with_centers(start, folder, new), new
        if still:
            break
    return model


def fit_kmeans(
    df: DataFrame,
    k: int,
    seed: int = 123,
    features: str = "features",
    prediction: str = "prediction",
    max_iter: int = 20,
    checkpoint: bool = True,
    order_key: str | None = None,
    partitions: int | None = None,
    collapse_duplicates: bool = False,
) -> KMeansModel:
    """Fit k-means (k-means|| start).

    By default k-means runs on the rows. Its start always does; where the vectors of ``SPARED`` rows or more
    repeat ``REPEATED`` times on average, the rounds after it run on distinct vectors weighted by their rows. A round's sums are the
    same, but a model found so has no ``summary``. With ``collapse_duplicates`` identical
    feature vectors become one point whose weight is their row count: a Lloyd
    step on them is the same as on all rows, for far fewer points where one-hot
    rows repeat. The start is not the same: it draws points, not rows, so a
    vector of many copies is drawn no more often than another and the cost can
    be worse. On dense features nothing collapses and the grouping is wasted.

    The seeded start depends on the layout of the rows. ``order_key`` with
    ``partitions`` fixes it: rows are hashed by the key into that many parts
    and sorted in them, so equal rows give the same model under any session
    settings. With ``checkpoint`` the prepared points are written once to the
    shared folder; they are kept in memory for the iterations either way.
    """
    weight_col = None
    if collapse_duplicates:
        data = (
            df.groupBy(vector_to_array(F.col(features)).alias("_point"))
            .agg(F.count(F.lit(1)).cast("double").alias("_weight"))
            .select(array_to_vector("_point").alias(features), "_weight")
        )
        weight_col = "_weight"
    elif order_key:
        n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        data = df.select(order_key, features).repartition(n, order_key).sortWithinPartitions(order_key)
    else:
        data = df.select(features)
    if checkpoint and not order_key:  # read back, files would be dealt anew
        data = write_shared(data, "kmeans-points")
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        km = KMeans(featuresCol=features, predictionCol=prediction, k=k, seed=seed, maxIter=max_iter)
        if weight_col:
            return km.setWeightCol(weight_col).fit(data)
        seen = data.agg(
            F.count(F.lit(1)).alias("rows"), F.approx_count_distinct(F.xxhash64(vector_to_array(features))).alias("vectors")
        ).first()
        if seen["rows"] < max(REPEATED * seen["vectors"], SPARED):
            return km.fit(data)
        points = data.groupBy(features).agg(F.count(F.lit(1)).cast("double").alias("_weight")).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return _rounds(km.copy({km.maxIter: 0}).fit(data), points, features, max_iter, km.getTol())
        finally:
            points.unpersist()
    finally:
        data.unpersist()


def assign(model: KMeansModel, df: DataFrame) -> DataFrame:
    """Add the nearest-centre column (a narrow map, no shuffle)."""
    return model.transform(df)


def cluster_sizes(pred: DataFrame, prediction: str = "prediction", k: int | None = None) -> DataFrame:
    """(cluster, size). With ``k`` empty clusters are listed with size 0."""
    sizes = pred.groupBy(F.col(prediction).cast("int").alias("cluster")).agg(F.count(F.lit(1)).alias("size"))
    if k is None:
        return sizes
    ids = pred.sparkSession.range(k).select(F.col("id").cast("int").alias("cluster"))
    return ids.join(sizes, "cluster", "left").select("cluster", F.coalesce("size", F.lit(0)).alias("size"))


def centers_frame(spark: SparkSession, model: KMeansModel) -> DataFrame:
    """(cluster, feature, center): the model's centres (k x d values)."""
    rows = [
        (c, j, float(v))
        for c, center in enumerate(model.clusterCenters())
        for j, v in enumerate(center.tolist())
    ]
    schema = T.StructType(
        [
            T.StructField("cluster", T.IntegerType()),
            T.StructField("feature", T.IntegerType()),
            T.StructField("center", T.DoubleType()),
        ]
    )
    return spark.createDataFrame(rows, schema)


def silhouette(df: DataFrame, prediction: str = "prediction", features: str = "features") -> float:
    """Mean silhouette, squared Euclidean distance (Spark's evaluator: per
    cluster sums are aggregated once and broadcast; no pairwise distances)."""
    ev = ClusteringEvaluator(predictionCol=prediction, featuresCol=features, distanceMeasure="squaredEuclidean")
    return float(ev.evaluate(df))


def group_profile(
    df: DataFrame,
    group: str,
    label: str | None,
    feature_cols: list[str],
    group_alias: str | None = None,
    digits: int | None = None,
) -> DataFrame:
    """(group, size, label_ratio, one mean per feature) in one aggregate.

    Means are partial aggregates (sum and count per map task), so a group
    holding a third of all rows costs one row per task in the shuffle. Boolean
    columns count as 0 and 1, numbers as they are.
    """

    def mean(name):
        c = F.col(name)
        if isinstance(df.schema[name].dataType, T.BooleanType):
            c = c.cast("int")
        c = F.avg(c.cast("double"))
        return F.round(c, digits) if digits is not None else c

    aggs = [F.count(F.lit(1)).alias("size")]
    if label is not None:
        aggs.append(mean(label).alias("label_ratio"))
    aggs += [mean(f).alias(f) for f in feature_cols]
    return df.groupBy(F.col(group).alias(group_alias or group)).agg(*aggs)


def profile_totals(profile: DataFrame, feature_cols: list[str], size: str = "size") -> DataFrame:
    """(feature, groups, rows, total): what the members of all groups of a
    :func:`group_profile` have of each feature, from its sizes and unrounded means.

    Equal to the feature's plain sum, whatever the grouping, if the profile
    misses no row and takes none twice.
    """
    sums = [F.sum(F.col(size) * F.col(f)).alias(f) for f in feature_cols]
    wide = profile.agg(F.count(F.lit(1)).alias("groups"), F.sum(size).alias("rows"), *sums)
    pairs = F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f).alias("total")) for f in feature_cols))
    return wide.select(F.explode(pairs).alias("f"), "groups", "rows").select("f.feature", "groups", "rows", "f.total")


def profile_in_long_form(df: DataFrame, group: str, items: str = "items") -> DataFrame:
    """(group, item, share): share of the group's rows holding each item.

    For vocabularies too wide for one column per item. Each row is exploded
    into its items plus one marker entry for the row itself; one aggregate
    counts both, and a window over the counted table (one row per group and
    item) hands the group's size to its items. A null group keeps its profile.
    """
    entries = F.concat(
        F.transform(F.coalesce(F.col(items), F.array().cast("array<string>")), lambda x: F.struct(x.alias("item"), F.lit(False).alias("is_row"))),
        F.array(F.struct(F.lit(None).cast("string").alias("item"), F.lit(True).alias("is_row"))),
    )
    counted = (
        df.select(F.col(group).alias("_g"), F.inline(entries))
        .where(F.col("is_row") | F.col("item").isNotNull())
        .groupBy("_g", "item", "is_row")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    size = F.max(F.when(F.col("is_row"), F.col("_n"))).over(Window.partitionBy("_g"))
    sized = counted.withColumn("_size", size).where(~F.col("is_row"))
    return sized.select(F.col("_g").alias(group), "item", (F.col("_n") / F.col("_size")).alias("share"))


def top_k_profile(
    df: DataFrame,
    group: str,
    label: str | None,
    items: str,
    k: int,
    prefix: str = "f",
    digits: int | None = None,
    rank_source: DataFrame | None = None,
) -> DataFrame:
    """Profile per group over the top-k items, without reading the vocabulary
    back to the driver.

    (group, size, label_ratio, f01..fk) where f_i is the share of the
    group's rows holding the i-th most frequent item (ties by item).

    Rows are exploded into their items plus one marker entry that stands for
    the row itself and carries the label; ONE aggregate counts by (group,
    rank), with the ranks joined from the k items (broadcast: k rows). The
    small counted table is then pivoted. ``rank_source`` (same rows and items,
    fewer columns, e.g. without a join that only adds the group and label) may
    be given for the ranking branch.
    """
    names = feature_names([""] * k, prefix, by_rank=True)
    top = ranked_top_k(rank_source if rank_source is not None else df, k, items).select(F.col("item").alias("_item"), F.col("rank").alias("_rank"))
    lab = F.col(label).cast("int") if label is not None else F.lit(None).cast("int")
    # The null entry is the row itself, rank 0; items beyond the top k find no rank and go.
    own = F.filter(F.array_distinct(F.coalesce(F.col(items), F.array().cast("array<string>"))), lambda x: x.isNotNull())
    entries = F.concat(F.array(F.lit(None).cast("string")), own)
    exploded = df.select(group, lab.alias("_label"), F.explode(entries).alias("_item")).join(F.broadcast(top), "_item", "left")
    exploded = exploded.where(F.col("_item").isNull() | F.col("_rank").isNotNull()).withColumn("_rank", F.coalesce("_rank", F.lit(0)))
    counted = exploded.groupBy(group, "_rank").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_label").alias("_sum"), F.count("_label").alias("_known")
    )

    def rnd(c):
        return F.round(c, digits) if digits is not None else c

    def at(i, c):
        return F.max(F.when(F.col("_rank") == i, F.col(c)))

    size = at(0, "_n")
    aggs = [size.alias("size")]
    if label is not None:
        ratio = F.when(at(0, "_known") > 0, at(0, "_sum") / at(0, "_known"))
        aggs.append(rnd(ratio).alias("label_ratio"))
    aggs += [rnd(F.coalesce(at(i, "_n"), F.lit(0)) / size).alias(name) for i, name in enumerate(names, 1)]
    return counted.groupBy(group).agg(*aggs)


def vector_profile(
    df: DataFrame, group: str, names: list[str], features: str = "features", group_alias: str | None = None, digits: int | None = None
) -> DataFrame:
    """(group, size, feature, mean) of a vector column, one row per group and feature.

    The means are one aggregate per group over vectors, sparse ones as they
    are: no column per feature, so tens of thousands of features plan like
    one. A task holds one sum per feature and group; a hot group is one row per task in the
    shuffle. ``names`` gives the features in order (read back or known: a bounded
    list). Rows with a null vector are left out; a null group is a group.
    """
    key = group_alias or group
    known = df.where(F.col(features).isNotNull())
    means = known.groupBy(F.col(group).alias(key)).agg(Summarizer.metrics("mean", "count").summary(F.col(features)).alias("_s"))
    flat = means.select(key, F.col("_s.count").alias("size"), F.posexplode(vector_to_array("_s.mean")).alias("_at", "mean"))
    named = df.sparkSession.createDataFrame(list(enumerate(names)), "_at int, feature string")
    out = flat.join(named, "_at")
    return out.select(key, "size", "feature", (F.round("mean", digits) if digits is not None else F.col("mean")).alias("mean"))
