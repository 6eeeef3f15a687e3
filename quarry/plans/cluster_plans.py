"""Feature and clustering queries: one-hot top-k, profiles, silhouette,
k-means with and without PCA.

The scanner-clustering flow of the reference on the basket stand-in: cut
rare large baskets, one-hot the top-k items, k-means (k=200, seed 123),
silhouette, per-cluster profile; then PCA and the same again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from quarry.operators import clusters, features, outliers
from quarry.plans.basket_plans import BASKETS_SQL, parsed_baskets
from quarry.plans.registry import register
from quarry.session import reliable
from quarry.sources import driver_tables as dt

ONE_HOT_K = 10
TOP_K_FEATURES = 20
K_CLUSTERS = 200
KMEANS_SEED = 123
PCA_K = 10
DIGITS = 6


def _rank_cols(k: int) -> list[str]:
    return features.feature_names([""] * k, "f", by_rank=True)


_TOPK_SQL = (
    ", counts AS (SELECT item, count(*) AS n FROM bi GROUP BY item), "
    "topk AS (SELECT item, row_number() OVER (ORDER BY n DESC, item) AS rk FROM counts QUALIFY rk <= {k}) "
)


def _one_hot_sql(k: int) -> str:
    cols = ", ".join(
        f"list_contains(items, (SELECT item FROM topk WHERE rk = {i + 1})) AS {name}"
        for i, name in enumerate(_rank_cols(k))
    )
    return BASKETS_SQL.rstrip() + _TOPK_SQL.format(k=k) + f", onehot AS (SELECT basket_id, priority, flag, {cols} FROM baskets) "


@register("one_hot_top_k", oracle=_one_hot_sql(ONE_HOT_K) + "SELECT basket_id, " + ", ".join(_rank_cols(ONE_HOT_K)) + " FROM onehot")
def one_hot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baskets with one boolean column per top-10 item (f01 = most frequent),
    in one narrow projection."""
    return features.one_hot_by_rank(parsed_baskets(spark, sf_dir), "basket_id", ONE_HOT_K, "items", prefix="f")


@register(
    "group_profile",
    oracle=_one_hot_sql(ONE_HOT_K)
    + "SELECT priority, count(*) AS size, round(avg(flag::INT), 6) AS label_ratio, "
    + ", ".join(f"round(avg({c}::INT), 6) AS {c}" for c in _rank_cols(ONE_HOT_K))
    + " FROM onehot GROUP BY priority",
    bench=True,
)
def group_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order priority: size, share of finished orders, share of each
    top-10 item (the cluster-profile aggregate on a known grouping), in one
    plan over one basket shuffle."""
    b = parsed_baskets(spark, sf_dir, with_orders=True)
    items_only = parsed_baskets(spark, sf_dir, with_orders=False)
    return clusters.top_k_profile(
        b, "priority", "flag", "items", ONE_HOT_K, prefix="f", digits=DIGITS, rank_source=items_only
    )


@register(
    "group_profile_long",
    oracle=BASKETS_SQL
    + ", sizes AS (SELECT priority, count(*) AS size FROM baskets GROUP BY priority), "
    "hits AS (SELECT b.priority, u.item, count(*) AS n FROM baskets b, unnest(b.items) AS u(item) "
    "GROUP BY b.priority, u.item) "
    "SELECT hits.priority, hits.item, round(hits.n / sizes.size, 6) AS share "
    "FROM hits JOIN sizes ON hits.priority IS NOT DISTINCT FROM sizes.priority",
)
def group_profile_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order priority and item: share of the priority's baskets holding
    the item (the long-form profile used for wide vocabularies)."""
    b = parsed_baskets(spark, sf_dir, with_orders=True)
    prof = clusters.profile_in_long_form(b, "priority", "items")
    return prof.select("priority", "item", F.round("share", DIGITS).alias("share"))


_SILHOUETTE_SQL = """
WITH u AS (
  SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, unnest(range(len(embedding))) AS j FROM embeddings
), d AS (
  SELECT a.vec_id AS i, b.vec_id AS o, sum((a.v - b.v) * (a.v - b.v)) AS dist
  FROM u a JOIN u b ON a.j = b.j AND a.vec_id <> b.vec_id
  GROUP BY 1, 2
), lab AS (
  SELECT vec_id, label FROM embeddings
), m AS (
  SELECT d.i, li.label AS la, lo.label AS lb, avg(dist) AS md
  FROM d JOIN lab li ON d.i = li.vec_id JOIN lab lo ON d.o = lo.vec_id
  GROUP BY 1, 2, 3
), s AS (
  SELECT i, max(CASE WHEN la = lb THEN md END) AS a, min(CASE WHEN la <> lb THEN md END) AS b FROM m GROUP BY i
), pts AS (
  SELECT lab.vec_id, s.a, s.b FROM lab LEFT JOIN s ON lab.vec_id = s.i
)
SELECT round(avg(CASE WHEN a IS NULL THEN 0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END), 6)
  AS silhouette
FROM pts
"""


@register("silhouette", oracle=_SILHOUETTE_SQL, bench=True)
def silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silhouette (squared Euclidean) of the embeddings grouped by label."""
    emb = dt.embedding_vectors(spark, sf_dir).withColumn("prediction", F.col("label").cast("double"))
    score = clusters.silhouette(emb, "prediction", "features")
    return spark.createDataFrame([(round(score, DIGITS),)], "silhouette double")


def clustering_input(spark: SparkSession, sf_dir: str, top_k: int = TOP_K_FEATURES):
    """Non-extreme multi-item baskets with top-k one-hot columns and a
    ``features`` vector. Returns (data, feature names).

    The baskets are written once as a reliable checkpoint; the rarity-cut
    subquery, the top-k list, the fit, the assignment and the profile all
    read that copy instead of recomputing the joins and the grouping.
    """
    b = parsed_baskets(spark, sf_dir, with_orders=True).select("basket_id", "flag", "items", "n_items")
    b = reliable(b)
    _, kept = outliers.split_by_rarity(b, "n_items", min_group_count=2)
    vocab = features.top_k_vocabulary(kept, top_k)
    names = features.feature_names(vocab, "Port")
    onehot = features.one_hot(kept, vocab, "items", names)
    data = features.assemble(onehot, names, "features").select("basket_id", "flag", "features", *names)
    return data, names


def _kmeans(spark: SparkSession, sf_dir: str, prepared=None):
    data, names = prepared or clustering_input(spark, sf_dir)
    model = clusters.fit_kmeans(data, K_CLUSTERS, KMEANS_SEED, "features", "prediction")
    return model, clusters.assign(model, data), names


@register("kmeans_sizes", bench=True)
def kmeans_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster sizes of k-means (k=200, seed 123) on top-20 one-hot baskets."""
    _, pred, _ = _kmeans(spark, sf_dir)
    return clusters.cluster_sizes(pred, "prediction")


@register("kmeans_profile")
def kmeans_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per cluster: size, share of finished orders, member mean per feature."""
    _, pred, names = _kmeans(spark, sf_dir)
    return clusters.group_profile(pred, "prediction", "flag", names, group_alias="cluster", digits=DIGITS)


@register("kmeans_centers")
def kmeans_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model's centres as (cluster, feature, center)."""
    model, _, _ = _kmeans(spark, sf_dir)
    return clusters.centers_frame(spark, model)


@register("pca_variance")
def pca_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Explained variance of each of the 10 principal components."""
    data, _ = clustering_input(spark, sf_dir)
    model, _ = features.reduce_pca(data.select("features"), PCA_K)
    rows = features.explained_variance(model)
    return spark.createDataFrame(rows, "component int, explained_variance double")


def _pca_kmeans(spark: SparkSession, sf_dir: str, prepared=None):
    data, names = prepared or clustering_input(spark, sf_dir)
    _, projected = features.reduce_pca(data, PCA_K, "features", "pca_features")
    model = clusters.fit_kmeans(projected, K_CLUSTERS, KMEANS_SEED, "pca_features", "pca_prediction")
    return clusters.assign(model, projected), names


@register("pca_kmeans_profile", bench=True)
def pca_kmeans_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k-means on 10 PCA components; profile in the original one-hot space."""
    pred, names = _pca_kmeans(spark, sf_dir)
    return clusters.group_profile(pred, "pca_prediction", "flag", names, group_alias="cluster", digits=DIGITS)


@register("clustering_compare")
def clustering_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per method (plain, PCA): silhouette, clusters used, spread of
    the finished-order share across clusters."""
    rows = []
    prepared = clustering_input(spark, sf_dir)
    _, pred, _ = _kmeans(spark, sf_dir, prepared)
    ppred, _ = _pca_kmeans(spark, sf_dir, prepared)
    for method, df, pcol, fcol in (("one_hot", pred, "prediction", "features"), ("pca", ppred, "pca_prediction", "pca_features")):
        # The evaluator reads the assignments twice and the profile once:
        # keep them (only the columns used) for these three passes.
        held = df.select(pcol, fcol, "flag").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            score = clusters.silhouette(held, pcol, fcol)
            prof = clusters.group_profile(held, pcol, "flag", [], group_alias="cluster")
            stats = prof.agg(
                F.count(F.lit(1)).alias("n_clusters"),
                F.min("label_ratio").alias("lo"),
                F.max("label_ratio").alias("hi"),
            ).first()
        finally:
            held.unpersist()
        rows.append((method, round(score, DIGITS), int(stats["n_clusters"]), stats["lo"], stats["hi"]))
    return spark.createDataFrame(
        rows, "method string, silhouette double, n_clusters int, label_ratio_min double, label_ratio_max double"
    )


_KEPT_SQL = (
    BASKETS_SQL.rstrip()
    + """, cut AS (
  SELECT max(n_items) AS cut FROM (SELECT n_items, count(*) AS c FROM baskets WHERE n_items >= 2 GROUP BY n_items) WHERE c >= 2
), kept AS (
  SELECT * FROM baskets WHERE n_items >= 2 AND n_items <= coalesce((SELECT cut FROM cut), n_items)
), counts AS (
  SELECT item, count(*) AS n FROM (SELECT unnest(items) AS item FROM kept) GROUP BY item
)"""
)


@register(
    "clustering_totals",
    oracle=_KEPT_SQL
    + f"""
SELECT 'Port' || item AS feature, r.n AS baskets, c.n AS one_hot_total, c.n AS pca_total,
       r.finished AS one_hot_finished, r.finished AS pca_finished, TRUE AS within_k
FROM (SELECT item, n FROM counts ORDER BY n DESC, item LIMIT {TOP_K_FEATURES}) c,
     (SELECT count(*) AS n, count(*) FILTER (WHERE flag) AS finished FROM kept) r""",
)
def clustering_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Side by side, from the cluster profiles of k-means (k=200) with and without PCA, both in the
    original features: baskets that hold each feature, and finished ones. SQL counts them without any cluster."""
    prepared = clustering_input(spark, sf_dir)
    _, plain, names = _kmeans(spark, sf_dir, prepared)
    reduced, _ = _pca_kmeans(spark, sf_dir, prepared)

    def totals(pred: DataFrame, prediction: str, method: str) -> DataFrame:
        prof = clusters.group_profile(pred, prediction, "flag", names, group_alias="cluster")
        sums = clusters.profile_totals(prof, [*names, "label_ratio"])
        sums = sums.select("feature", F.round("total").cast("long").alias("total"), "groups", "rows")
        finished = sums.where(F.col("feature") == "label_ratio").select("total").scalar()
        return sums.where(F.col("feature") != "label_ratio").select(
            "feature",
            F.col("total").alias(f"{method}_total"),
            finished.alias(f"{method}_finished"),
            F.col("groups").alias(f"{method}_groups"),
            F.col("rows").alias(f"{method}_rows"),
        )

    both = totals(plain, "prediction", "one_hot").join(totals(reduced, "pca_prediction", "pca"), "feature")
    within = (F.col("one_hot_groups") <= K_CLUSTERS) & (F.col("pca_groups") <= K_CLUSTERS) & (F.col("one_hot_rows") == F.col("pca_rows"))
    return both.select(
        "feature", F.col("one_hot_rows").alias("baskets"), "one_hot_total", "pca_total", "one_hot_finished", "pca_finished", within.alias("within_k")
    )
