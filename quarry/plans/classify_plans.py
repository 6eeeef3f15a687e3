"""Classification queries: missing labels, class counts, split, F1, tree grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import classify, features, trees
from quarry.plans.registry import register
from quarry.plans.wide_plans import STUMP_WORDS, _flags_sql, word_sets
from quarry.session import write_shared
from quarry.sources import driver_tables as dt

SPLIT_SEED = 1234
TRAIN_FRACTION = 0.75

_LABELED_SQL = "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id "


@register(
    "drop_missing",
    oracle="SELECT d.doc_id, l.quality " + _LABELED_SQL + "WHERE l.quality IS NOT NULL",
)
def drop_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that carry a quality label."""
    return classify.drop_missing(dt.labeled_documents(spark, sf_dir), ["quality"]).select("doc_id", "quality")


@register(
    "missing_count",
    oracle="SELECT count(*) AS n_missing " + _LABELED_SQL + "WHERE l.quality IS NULL",
)
def missing_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of documents without a quality label."""
    return classify.missing_rows(dt.labeled_documents(spark, sf_dir), ["quality"]).agg(
        F.count(F.lit(1)).alias("n_missing")
    )


@register(
    "class_counts",
    oracle="SELECT l.quality, count(*) AS n " + _LABELED_SQL + "WHERE l.quality IS NOT NULL GROUP BY l.quality",
)
def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per class after dropping unlabelled documents."""
    clean = classify.drop_missing(dt.labeled_documents(spark, sf_dir), ["quality"])
    return classify.class_counts(clean, "quality")


@register(
    "class_counts_before_drop",
    oracle="SELECT l.quality, count(*) AS n " + _LABELED_SQL + "GROUP BY l.quality",
)
def class_counts_before_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per class before dropping missing labels (null is its own group)."""
    return classify.class_counts(dt.labeled_documents(spark, sf_dir), "quality")


@register(
    "stable_split",
    oracle="SELECT CASE WHEN substr(md5('1234:' || CAST(doc_id AS VARCHAR)), 1, 8) < 'c0000000' "
    "THEN 'train' ELSE 'test' END AS split, count(*) AS n FROM documents GROUP BY 1",
)
def stable_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train/test sizes of the 75/25 key-hash split of documents."""
    docs = dt.table(spark, sf_dir, "documents").select("doc_id")
    tagged = classify.stable_split(docs, "doc_id", TRAIN_FRACTION, SPLIT_SEED)
    return tagged.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@register("unkeyed_split", oracle="SELECT count(*) AS n, TRUE AS near_three_quarters, 0::BIGINT AS moved FROM documents")
def unkeyed_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents split without their key: rows of both sides together, whether three quarters
    (to a fifth) train, and rows that change sides when the split is read again in other parts."""
    split = classify.unkeyed_split(dt.table(spark, sf_dir, "documents"))
    again = split.repartition(5).select(F.col("doc_id").alias("id"), F.col("split").alias("later"))
    both = split.join(again, F.col("doc_id") == F.col("id"), "left")
    share = F.count_if(F.col("split") == "train") / F.count(F.lit(1))
    return both.agg(
        F.count(F.lit(1)).alias("n"), share.between(0.6, 0.9).alias("near_three_quarters"), F.count_if(~F.col("split").eqNullSafe(F.col("later"))).alias("moved")
    )


@register(
    "weighted_f1",
    oracle="""
WITH conf AS (
  SELECT quality::DOUBLE AS t, (1 - toxic)::DOUBLE AS p, count(*)::DOUBLE AS c
  FROM labels WHERE quality IS NOT NULL AND toxic IS NOT NULL GROUP BY 1, 2
), truth AS (
  SELECT t AS cls, sum(c) AS n_true, sum(CASE WHEN t = p THEN c ELSE 0 END) AS tp FROM conf GROUP BY 1
), pred AS (
  SELECT p AS cls, sum(c) AS n_pred FROM conf GROUP BY 1
)
SELECT round(sum(n_true * CASE WHEN tp > 0 THEN 2 * tp / (n_true + n_pred) ELSE 0 END) / sum(n_true), 6) AS f1
FROM truth LEFT JOIN pred ON truth.cls = pred.cls
""",
)
def weighted_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted F1 of the rule 'quality = 1 - toxic' on the labels table."""
    lab = dt.table(spark, sf_dir, "labels").where(F.col("quality").isNotNull() & F.col("toxic").isNotNull())
    scored = lab.select(F.col("quality").alias("label"), (1 - F.col("toxic")).alias("prediction"))
    return classify.weighted_f1(scored, "label", "prediction").select(F.round("f1", 6).alias("f1"))


@register("tree_grid", bench=True)
def tree_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decision-tree grid (depth 2..11 x min rows 2..6) on text features of
    labelled documents; train/test F1 per grid point, best row flagged."""
    data = dt.diagnosis_like(spark, sf_dir, labeled_only=True)
    return trees.nested_grid(data, dt.TEXT_FEATURES, "class", "id", split_seed=SPLIT_SEED)


@register("tree_grid_check", oracle="SELECT 50::BIGINT AS points, 0::BIGINT AS differing, 1::BIGINT AS best")
def tree_grid_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid of nested trees against fifty fits of their own: points, those whose scores or
    flag differ, and points flagged best."""
    data = dt.diagnosis_like(spark, sf_dir, labeled_only=True)
    nested, single = (f(data, dt.TEXT_FEATURES, "class", "id", split_seed=SPLIT_SEED) for f in (trees.nested_grid, classify.tree_grid))
    keys = ["grid_index", "max_depth", "min_instances_per_node"]
    both = nested.alias("x").join(single.alias("y"), keys, "full")
    same = [F.coalesce(F.abs(F.col(f"x.{c}") - F.col(f"y.{c}")) < 1e-12, F.lit(False)) for c in ("train_f1", "test_f1")]
    same.append(F.col("x.is_best").eqNullSafe(F.col("y.is_best")))
    return both.agg(
        F.count(F.lit(1)).alias("points"), F.count_if(~(same[0] & same[1] & same[2])).alias("differing"), F.count_if("x.is_best").alias("best")
    )


_WORDS = features.feature_names([""] * STUMP_WORDS, "f", by_rank=True)
_TRAIN = "md5('1234:' || CAST(doc_id AS VARCHAR))[1:8] < 'c0000000'"
_SAVED_SQL = (
    _flags_sql(STUMP_WORDS)
    + f", train AS (SELECT * FROM onehot WHERE lang IS NOT NULL AND {_TRAIN}), "
    "labels_ AS (SELECT lang, row_number() OVER (ORDER BY count(*) DESC, lang) AS idx FROM train GROUP BY lang), "
    "long AS (UNPIVOT (SELECT lang, " + ", ".join(f"{n}::INT AS {n}" for n in _WORDS) + " FROM train) ON COLUMNS(* EXCLUDE (lang)) INTO NAME feature VALUE v), "
    "cells AS (SELECT feature, v, lang, count(*) AS c FROM long GROUP BY ALL), "
    "sides AS (SELECT feature, v, sum(c) AS n, sum(c) - sum(c * c) / sum(c) AS impurity FROM cells GROUP BY 1, 2), "
    "best AS (SELECT feature FROM sides GROUP BY feature HAVING count(*) = 2 ORDER BY round(sum(impurity), 6), feature LIMIT 1), "
    "leaf AS (SELECT v, arg_max(lang, c * 100 - idx) AS said FROM cells JOIN best USING (feature) JOIN labels_ USING (lang) GROUP BY v), "
    "rows_ AS (UNPIVOT (SELECT doc_id, " + ", ".join(f"{n}::INT AS {n}" for n in _WORDS) + " FROM onehot) ON COLUMNS(* EXCLUDE (doc_id)) INTO NAME feature VALUE v) "
    'SELECT doc_id, said AS "predictedClass" FROM rows_ JOIN best USING (feature) JOIN leaf USING (v)'
)


@register("saved_tree_classes", oracle=_SAVED_SQL)
def saved_tree_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language that a tree of depth one, fitted on three quarters of the documents, saved and
    loaded again, predicts for every document from ten word flags."""
    sets = word_sets(spark, sf_dir)
    flags = features.one_hot_by_rank(sets.withColumn("k", F.struct("doc_id", "lang")), "k", STUMP_WORDS, rank_source=sets)
    rows = write_shared(flags.select("k.doc_id", "k.lang", *_WORDS), "tree-flags")
    train = classify.stable_split(rows, "doc_id", TRAIN_FRACTION, SPLIT_SEED).where("split = 'train'")
    folder = trees.fit_and_save(train, _WORDS, "lang", max_depth=1)
    return trees.apply_saved(folder, rows.drop("lang")).select("doc_id", "predictedClass")
