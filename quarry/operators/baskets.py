"""Item baskets: parse, count, rank, filter by membership.

A basket is one row with an array of distinct items (scanner -> ports,
order -> brands). Counting explodes the array and aggregates with a partial
(map-side) hash aggregate, so a very popular item costs one row per task in
the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.arrays import contains_all, split_items
from quarry.session import write_shared


def to_items(df: DataFrame, col: str = "items_str", sep: str = "-", out: str = "items") -> DataFrame:
    """Add the duplicate-free item array parsed from a delimited string."""
    return df.withColumn(out, split_items(col, sep))


def explode_items(df: DataFrame, items: str = "items", out: str = "item") -> DataFrame:
    """One row per (basket, item); null baskets and null items are skipped."""
    return df.select(F.explode(F.col(items)).alias(out)).where(F.col(out).isNotNull())


def item_counts(df: DataFrame, items: str = "items", out: str = "n") -> DataFrame:
    """(item, n): number of baskets holding each item (one-item baskets too)."""
    return explode_items(df, items).groupBy("item").agg(F.count(F.lit(1)).alias(out))


def distinct_item_count(df: DataFrame, items: str = "items", approx_rsd: float | None = None) -> DataFrame:
    """One row: number of distinct items (the size of the reduced pair table).

    Exact by default (a partial aggregate per item, then a count). With
    ``approx_rsd`` a HyperLogLog++ sketch with that relative standard
    deviation is merged instead: fixed-size state per task, for item spaces
    too large to group.
    """
    if approx_rsd is not None:
        return explode_items(df, items).agg(F.approx_count_distinct("item", approx_rsd).alias("n_items"))
    return item_counts(df, items).agg(F.count(F.lit(1)).alias("n_items"))


def rank_items(counts: DataFrame, value: str = "n", key: str = "item") -> DataFrame:
    """Order by count descending, ties by item ascending (a fixed order)."""
    return counts.orderBy(F.col(value).desc(), F.col(key).asc())


def top_k_items(df: DataFrame, k: int, items: str = "items") -> DataFrame:
    """The k most frequent items; planned as TakeOrderedAndProject."""
    return rank_items(item_counts(df, items)).limit(k)


def containing_all(df: DataFrame, wanted: Iterable[str], items: str = "items") -> DataFrame:
    """Baskets that hold every item of ``wanted``."""
    return df.where(contains_all(items, wanted))


def is_multi_item(items: str = "items") -> Column:
    """Whether the basket has more than one item (only then it can form a pair)."""
    return F.size(F.col(items)) > 1


def multi_item(df: DataFrame, items: str = "items") -> DataFrame:
    """Baskets with more than one item."""
    return df.where(is_multi_item(items))


def support_threshold(df: DataFrame, min_support: float | str | Decimal) -> Column:
    """Count threshold ``min_support * number of baskets`` as a Column.

    The basket count is a scalar subquery (no driver round trip) and the
    product is decimal, so "n > threshold" is exact in Spark and in SQL.
    """
    support = Decimal(str(min_support))
    n_baskets = df.agg(F.count(F.lit(1))).scalar()
    return F.lit(support) * n_baskets


def threshold_column(df: DataFrame, threshold: int | None, min_support: float | None) -> Column:
    if (threshold is None) == (min_support is None):
        raise ValueError("give exactly one of threshold and min_support")
    if threshold is not None:
        return F.lit(int(threshold))
    return support_threshold(df, min_support)


def item_counts_with_total(df: DataFrame, items: str = "items") -> DataFrame:
    """(item, is_total, n): item counts plus one row (is_total = true) that
    counts the baskets, from ONE explode and ONE aggregate.

    Each basket contributes its items and one marker entry, so the basket
    count needed for a support threshold comes out of the same shuffle.
    """
    entries = F.concat(
        F.transform(F.col(items), lambda x: F.struct(x.alias("item"), F.lit(False).alias("is_total"))),
        F.array(F.struct(F.lit(None).cast("string").alias("item"), F.lit(True).alias("is_total"))),
    )
    exploded = df.select(F.inline(entries)).where(F.col("is_total") | F.col("item").isNotNull())
    return exploded.groupBy("item", "is_total").agg(F.count(F.lit(1)).alias("n"))


def frequent_items(
    df: DataFrame, threshold: int | None = None, min_support: float | None = None, items: str = "items"
) -> DataFrame:
    """(item, n) with n strictly above the threshold.

    With ``min_support`` the basket count comes from the same aggregate as the
    item counts: the input is read, exploded and counted once.
    """
    if min_support is None:
        return item_counts(df, items).where(F.col("n") > threshold_column(df, threshold, None))
    if threshold is not None:
        raise ValueError("give exactly one of threshold and min_support")
    # The counted table is small next to the baskets; written once, so that the
    # filter on its marker row cannot be pushed into a second count.
    counted = write_shared(item_counts_with_total(df, items), "item-counts")
    n_baskets = counted.where(F.col("is_total")).agg(F.sum("n")).scalar()
    t = F.lit(Decimal(str(min_support))) * F.coalesce(n_baskets, F.lit(0))
    return counted.where(~F.col("is_total") & (F.col("n") > t)).select("item", "n")
