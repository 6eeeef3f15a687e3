"""Frequent item pairs and triples, level-wise (Apriori), in DataFrame operations.

Plan
----
1. Frequent single items by a partial/final count; baskets lose all others by a
   semi-join of their exploded items. The pruned baskets are written once, as
   (basket, sorted items).
2. Pairs: narrow baskets emit their item pairs with ``explode`` over the sorted
   array, and Spark's partial aggregate counts them. A basket of s items has
   s (s - 1) / 2 of them: where that is more than ``EMITTED`` rows for each item of a
   basket, pairs are counted in tiles of the pair table instead (``pair_tiles``), and
   step 1 is done there, on items of chunks of baskets.
3. Triples extend frequent pairs only (downward closure): baskets keep the pairs
   that are frequent, and two such pairs with the same first item in the same
   basket make a triple. The frequent pairs stay a table.

No item is read back to the driver, so an absolute threshold that leaves many
items or pairs is only more rows. A hot item is one row per task in the counts;
in the semi-joins it sits on the row side, which AQE splits.

Items inside a set are in ascending value order: item_1 < item_2 < item_3.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators import pair_tiles
from quarry.operators.baskets import frequent_items, threshold_column
from quarry.session import shared_folder, write_shared

EMITTED = 16  # pairs emitted for each item of a basket, on average; beyond, tiles


def _numbered(df: DataFrame, items: str, folder: str | None = None) -> DataFrame:
    """(basket, items): distinct items of each basket, written once.

    The number of a basket is only a grouping key; stored, so that a retried
    task cannot number it again.
    """
    distinct = F.array_distinct(F.filter(F.col(items), lambda x: x.isNotNull()))
    return write_shared(
        df.select(F.monotonically_increasing_id().alias("basket"), distinct.alias("items")).where(F.size("items") > 1),
        "baskets",
        folder,
    )


def _pruned(numbered: DataFrame, singles: DataFrame) -> DataFrame:
    """(basket, items): the frequent items of each basket in order, two at least."""
    rows = numbered.select("basket", F.explode("items").alias("item")).join(singles, "item", "left_semi")
    kept = rows.groupBy("basket").agg(F.sort_array(F.collect_list("item")).alias("items"))
    return write_shared(kept.where(F.size("items") > 1), "pruned-baskets")


def _pairs_in_baskets(pruned: DataFrame) -> DataFrame:
    """(basket, item_1, item_2), one row for each pair of a basket."""
    first = pruned.select("basket", "items", F.posexplode("items").alias("at", "item_1"))
    rest = F.slice("items", F.col("at") + 2, F.greatest(F.size("items") - F.col("at") - 1, F.lit(0)))
    return first.select("basket", "item_1", F.explode(rest).alias("item_2"))


def _counted(rows: DataFrame, keys: list[str], t: Column) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > t)


def least(df: DataFrame, t: Column) -> int:
    """The threshold ``t`` as a whole number: counts above the one are above the other."""
    return math.floor(df.sparkSession.range(1).select(t).first()[0])


def _wide(baskets: DataFrame) -> bool:
    """Whether the baskets hold so many pairs that they are not emitted."""
    size = F.size("items").cast("double")
    held = baskets.agg(F.sum(size).alias("items"), F.sum(size * (size - 1) / 2).alias("pairs")).first()
    return (held["pairs"] or 0) > EMITTED * (held["items"] or 0)


def frequent_pairs(
    df: DataFrame, threshold: int | None = None, min_support: float | None = None, items: str = "items"
) -> DataFrame:
    """(item_1, item_2, n): pairs held by more than ``threshold`` baskets."""
    t = threshold_column(df, threshold, min_support)
    folder = shared_folder(df.sparkSession, "baskets")
    numbered = _numbered(df, items, folder)
    if _wide(numbered):
        return pair_tiles.frequent_pairs(numbered, least(df, t), spent=folder)
    singles = frequent_items(df, threshold, min_support, items).select("item")
    return _counted(_pairs_in_baskets(_pruned(numbered, singles)), ["item_1", "item_2"], t)


def frequent_triples(
    df: DataFrame, threshold: int | None = None, min_support: float | None = None, items: str = "items"
) -> DataFrame:
    """(item_1, item_2, item_3, n): triples held by more than ``threshold``."""
    t = threshold_column(df, threshold, min_support)
    pruned = _pruned(_numbered(df, items), frequent_items(df, threshold, min_support, items).select("item"))
    counted = pair_tiles.frequent_pairs(pruned, least(df, t)) if _wide(pruned) else _counted(_pairs_in_baskets(pruned), ["item_1", "item_2"], t)
    pairs = write_shared(counted.select("item_1", "item_2"), "pairs")
    held = _pairs_in_baskets(pruned).join(pairs, ["item_1", "item_2"], "left_semi")
    # All frequent pairs of a basket with one first item, as an array: no longer than the basket.
    stars = held.groupBy("basket", "item_1").agg(F.sort_array(F.collect_list("item_2")).alias("items"))
    second = stars.where(F.size("items") > 1).select("item_1", "items", F.posexplode("items").alias("at", "item_2"))
    rest = F.slice("items", F.col("at") + 2, F.greatest(F.size("items") - F.col("at") - 1, F.lit(0)))
    triples = second.select("item_1", "item_2", F.explode(rest).alias("item_3"))
    return _counted(triples, ["item_1", "item_2", "item_3"], t)


def as_item_sets(df: DataFrame) -> DataFrame:
    """Reference-style output: ``items`` array plus ``n``."""
    cols = [c for c in ("item_1", "item_2", "item_3") if c in df.columns]
    return df.select(F.array(*cols).alias("items"), "n")
