"""Sink round trips: results are written the way the reference saves them
(pair text, CSV with and without header, result tables), into the shared
checkpoint folder, and read back. Each query checks a writer end to end."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quarry.operators import baskets as bk
from quarry.operators import itemsets, outliers, tokens
from quarry.plans.basket_plans import BASKETS_SQL, PAIR_SUPPORT, parsed_baskets
from quarry.plans.outlier_plans import _SIZES_SQL, MIN_GROUP_COUNT
from quarry.plans.registry import register
from quarry.plans.token_plans import _TOKENS_SQL, PREFIX
from quarry.session import claimed, ensure_checkpoint_dir
from quarry.sources import driver_tables as dt
from quarry.sources import sinks


def _out_dir(spark: SparkSession, name: str) -> str:
    return claimed(f"{ensure_checkpoint_dir(spark).rstrip('/')}/sinks/{name}-{uuid.uuid4().hex[:12]}")


_REPR_SQL = (
    "CASE WHEN contains(token, '''') AND NOT contains(token, '\"') "
    "THEN '\"' || replace(replace(replace(replace(token, '\\', '\\\\'), chr(9), '\\t'), chr(10), '\\n'), chr(13), '\\r') || '\"' "
    "ELSE '''' || replace(replace(replace(replace(replace(token, '\\', '\\\\'), chr(9), '\\t'), chr(10), '\\n'), chr(13), '\\r'), "
    "'''', '\\''') || '''' END"
)


@register(
    "pair_text_sink",
    oracle=f"SELECT '(' || {_REPR_SQL} || ', ' || CAST(n AS VARCHAR) || ')' AS value FROM ({_TOKENS_SQL})",
)
def pair_text_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """'th' token counts saved as "('token', n)" text lines, read back."""
    counts = tokens.text_prefix_counts(dt.document_text(spark, sf_dir), PREFIX)
    path = _out_dir(spark, "pair_text")
    sinks.write_pairs_text(tokens.rank(counts), path, "token", "n")
    return spark.read.text(path)


@register(
    "size_histogram_csv_sink",
    oracle=BASKETS_SQL + "SELECT n_items, count(*) AS n FROM baskets WHERE n_items >= 2 GROUP BY n_items",
)
def size_histogram_csv_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Basket size histogram saved as header-less CSV, read back."""
    hist = outliers.size_histogram(parsed_baskets(spark, sf_dir), "n_items")
    path = _out_dir(spark, "size_histogram")
    sinks.write_csv(hist.orderBy(hist.n.desc()), path, header=False)
    return spark.read.schema("n_items int, n long").csv(path)


@register(
    "extremes_csv_sink",
    oracle=_SIZES_SQL.format(mgc=MIN_GROUP_COUNT) + "SELECT basket_id, size FROM s WHERE size > (SELECT cut FROM cut)",
)
def extremes_csv_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extreme orders saved as CSV with a header, read back."""
    extreme, _ = outliers.split_by_rarity(dt.order_part_sizes(spark, sf_dir), "size", MIN_GROUP_COUNT)
    path = _out_dir(spark, "extremes")
    sinks.write_csv(extreme, path, header=True)
    return spark.read.option("header", True).schema("basket_id long, size long").csv(path)


@register(
    "port_sets_csv_sink",
    oracle=BASKETS_SQL
    + "SELECT x.item || '-' || y.item AS items, count(*) AS n "
    "FROM bi x JOIN bi y ON x.basket_id = y.basket_id AND x.item < y.item "
    f"GROUP BY x.item, y.item HAVING count(*) > {PAIR_SUPPORT} * (SELECT n FROM nb)",
)
def port_sets_csv_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequent pairs saved as a result table (items dash-joined), read back."""
    pairs = itemsets.as_item_sets(itemsets.frequent_pairs(parsed_baskets(spark, sf_dir), min_support=PAIR_SUPPORT))
    path = _out_dir(spark, "port_sets")
    sinks.write_result(bk.rank_items(pairs, "n", "items"), path)
    return spark.read.option("header", True).schema("items string, n long").csv(path)
