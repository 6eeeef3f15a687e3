"""Outlier-cut queries: size histogram, rarity cut, extreme and kept rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import outliers, ranks
from quarry.plans.basket_plans import BASKETS_SQL, parsed_baskets
from quarry.plans.registry import register
from quarry.sources import driver_tables as dt

MIN_GROUP_COUNT = 10
FIXED_CUT = 10

_SIZES_SQL = """
WITH s AS (
  SELECT l_orderkey AS basket_id, count(DISTINCT l_partkey) AS size FROM lineitem GROUP BY l_orderkey
), cut AS (
  SELECT max(size) AS cut FROM (SELECT size, count(*) AS c FROM s WHERE size >= 2 GROUP BY size) WHERE c >= {mgc}
)
"""


@register(
    "size_histogram",
    oracle=BASKETS_SQL + "SELECT n_items, count(*) AS n FROM baskets WHERE n_items >= 2 GROUP BY n_items",
)
def size_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baskets per size (sizes above one), largest count first."""
    hist = outliers.size_histogram(parsed_baskets(spark, sf_dir), "n_items")
    return hist.orderBy(hist.n.desc(), hist.n_items.asc())


@register(
    "size_histogram_places",
    oracle=_SIZES_SQL.format(mgc=MIN_GROUP_COUNT)
    + "SELECT size, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, size) AS place FROM s GROUP BY size",
)
def size_histogram_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per number of distinct parts, with each size's place in the sorted table."""
    hist = outliers.size_histogram(dt.order_part_sizes(spark, sf_dir), "size", min_size=1)
    return ranks.with_places(hist, F.col("n").desc(), F.col("size").asc())


@register(
    "rarity_cut",
    oracle=BASKETS_SQL
    + "SELECT max(n_items) AS cut FROM (SELECT n_items, count(*) AS c FROM baskets "
    "WHERE n_items >= 2 GROUP BY n_items) WHERE c >= 2",
)
def rarity_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Largest basket size shared by more than one basket."""
    return outliers.rarity_cut_frame(parsed_baskets(spark, sf_dir), "n_items", min_group_count=2)


@register(
    "extreme_rows",
    oracle=_SIZES_SQL.format(mgc=MIN_GROUP_COUNT) + "SELECT basket_id, size FROM s WHERE size > (SELECT cut FROM cut)",
    bench=True,
)
def extreme_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose distinct-part count is above the largest count shared
    by at least 10 orders."""
    sizes = dt.order_part_sizes(spark, sf_dir)
    extreme, _ = outliers.split_by_rarity(sizes, "size", MIN_GROUP_COUNT)
    return extreme


@register(
    "non_extreme_rows",
    oracle=_SIZES_SQL.format(mgc=MIN_GROUP_COUNT)
    + "SELECT basket_id, size FROM s WHERE size >= 2 AND ((SELECT cut FROM cut) IS NULL "
    "OR size <= (SELECT cut FROM cut))",
)
def non_extreme_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders kept for clustering: more than one part, not extreme."""
    sizes = dt.order_part_sizes(spark, sf_dir)
    _, kept = outliers.split_by_rarity(sizes, "size", MIN_GROUP_COUNT)
    return kept


@register(
    "fixed_cut_extremes",
    oracle=_SIZES_SQL.format(mgc=MIN_GROUP_COUNT) + f"SELECT basket_id, size FROM s WHERE size > {FIXED_CUT}",
)
def fixed_cut_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with more than 10 distinct parts (fixed cut)."""
    extreme, _ = outliers.split_by_value(dt.order_part_sizes(spark, sf_dir), "size", FIXED_CUT)
    return extreme


@register(
    "fixed_cut_kept",
    oracle=_SIZES_SQL.format(mgc=MIN_GROUP_COUNT) + f"SELECT basket_id, size FROM s WHERE size BETWEEN 2 AND {FIXED_CUT}",
)
def fixed_cut_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with two to ten distinct parts, the side that the fixed cut keeps."""
    _, kept = outliers.split_by_value(dt.order_part_sizes(spark, sf_dir), "size", FIXED_CUT)
    return kept
