"""Basket queries: item counts, ranks, membership, frequent sets.

Input is the scanner-profile stand-in ``driver_tables.baskets`` (one basket
of part brands per order), parsed from its dash-joined string exactly as the
reference parses ``ports_scanned_str``. Thresholds are minimum supports (a
share of all baskets), so they scale with the tables; the comparison
"count > support * baskets" is decimal and exact in both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.operators import baskets as bk
from quarry.operators import itemsets
from quarry.plans.registry import register
from quarry.sources import driver_tables as dt

ITEM_SUPPORT = "0.15"
PAIR_SUPPORT = "0.02"
TRIPLE_SUPPORT = "0.003"
TOP_K = 10
WANTED = ("Brand#12", "Brand#23")

BASKETS_SQL = """
WITH b0 AS (
  SELECT l.l_orderkey AS basket_id, list_sort(list_distinct(list(p.p_brand))) AS items
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  GROUP BY l.l_orderkey
), baskets AS (
  SELECT b0.basket_id, b0.items, array_to_string(b0.items, '-') AS items_str,
         len(b0.items) AS n_items, o.o_orderstatus = 'F' AS flag, o.o_orderpriority AS priority
  FROM b0 LEFT JOIN orders o ON b0.basket_id = o.o_orderkey
), bi AS (
  SELECT basket_id, unnest(items) AS item FROM baskets
), nb AS (
  SELECT count(*) AS n FROM baskets
)
"""


def parsed_baskets(spark: SparkSession, sf_dir: str, with_orders: bool = False) -> DataFrame:
    """Baskets as the reference reads them: split the dash-joined string.

    The order status / priority columns are joined only when asked for.
    """
    base = dt.baskets(spark, sf_dir, with_orders).select("basket_id", "items_str", "n_items", "flag", "priority")
    return bk.to_items(base, "items_str", "-", "items")


@register("item_counts", oracle=BASKETS_SQL + "SELECT item, count(*) AS n FROM bi GROUP BY item", bench=True)
def item_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item, n) over all baskets, ranked."""
    return bk.rank_items(bk.item_counts(parsed_baskets(spark, sf_dir)))


@register(
    "distinct_item_count",
    oracle=BASKETS_SQL + "SELECT count(DISTINCT item) AS n_items FROM bi",
)
def distinct_item_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of distinct items."""
    return bk.distinct_item_count(parsed_baskets(spark, sf_dir))


@register(
    "top_k_items",
    oracle=BASKETS_SQL
    + "SELECT item, n, row_number() OVER (ORDER BY n DESC, item) AS place FROM "
    f"(SELECT item, count(*) AS n FROM bi GROUP BY item) QUALIFY place <= {TOP_K}",
)
def top_k_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 most frequent items with their place, ties by item."""
    top = bk.top_k_items(parsed_baskets(spark, sf_dir), TOP_K)
    # Numbered in the order that the plan gives: TOP_K rows in one partition.
    return top.withColumn("place", F.row_number().over(Window.orderBy(F.monotonically_increasing_id())).cast("long"))


@register(
    "baskets_with_all",
    oracle=BASKETS_SQL
    + f"SELECT basket_id, items_str FROM baskets WHERE list_contains(items, '{WANTED[0]}') "
    f"AND list_contains(items, '{WANTED[1]}')",
)
def baskets_with_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baskets holding both of two given items."""
    return bk.containing_all(parsed_baskets(spark, sf_dir), WANTED).select("basket_id", "items_str")


@register(
    "multi_item_count",
    oracle=BASKETS_SQL
    + "SELECT count(*) AS n_baskets, count(*) FILTER (WHERE len(items) > 1) AS n_multi, "
    "count(*) FILTER (WHERE len(items) <= 1) AS n_removed FROM baskets",
)
def multi_item_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baskets before and after dropping one-item baskets, in one pass."""
    b = parsed_baskets(spark, sf_dir)
    multi = bk.is_multi_item()
    return b.agg(
        F.count(F.lit(1)).alias("n_baskets"),
        F.count_if(multi).alias("n_multi"),
        F.count_if(~multi).alias("n_removed"),
    )


@register(
    "frequent_items",
    oracle=BASKETS_SQL
    + f"SELECT item, count(*) AS n FROM bi GROUP BY item HAVING count(*) > {ITEM_SUPPORT} * (SELECT n FROM nb)",
    bench=True,
)
def frequent_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items in more than 15% of baskets."""
    return bk.rank_items(bk.frequent_items(parsed_baskets(spark, sf_dir), min_support=ITEM_SUPPORT))


@register(
    "frequent_pairs",
    oracle=BASKETS_SQL
    + "SELECT x.item AS item_1, y.item AS item_2, count(*) AS n "
    "FROM bi x JOIN bi y ON x.basket_id = y.basket_id AND x.item < y.item "
    f"GROUP BY 1, 2 HAVING count(*) > {PAIR_SUPPORT} * (SELECT n FROM nb)",
    bench=True,
)
def frequent_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item pairs in more than 2% of baskets."""
    return itemsets.frequent_pairs(parsed_baskets(spark, sf_dir), min_support=PAIR_SUPPORT)


@register(
    "frequent_triples",
    oracle=BASKETS_SQL
    + "SELECT x.item AS item_1, y.item AS item_2, z.item AS item_3, count(*) AS n "
    "FROM bi x JOIN bi y ON x.basket_id = y.basket_id AND x.item < y.item "
    "JOIN bi z ON z.basket_id = x.basket_id AND y.item < z.item "
    f"GROUP BY 1, 2, 3 HAVING count(*) > {TRIPLE_SUPPORT} * (SELECT n FROM nb)",
    bench=True,
)
def frequent_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item triples in more than 0.3% of baskets."""
    return itemsets.frequent_triples(parsed_baskets(spark, sf_dir), min_support=TRIPLE_SUPPORT)
