"""Mergeable summaries: frequent items in two passes, distinct counts per period."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.baskets import explode_items, item_counts, rank_items
from quarry.session import ship_package, write_shared

COUNTERS = 10_000
"""Items that a task's summary keeps."""
LG_REGISTERS = 12
"""Base-2 logarithm of a sketch's registers; the relative error is 1.04 / sqrt(registers)."""


def _summary(counters: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The task's frequent items with counts too small by ``lost`` at most, and a row (null, lost).

    Counts are added batch by batch; when more than ``counters`` items are held, the count of the largest
    one beyond them is taken off all, and those without a rest go.
    """
    held: dict[str, int] = {}
    lost = 0
    for batch in batches:
        for entry in batch.column("items").flatten().drop_null().value_counts():
            item = entry["values"].as_py()
            held[item] = held.get(item, 0) + entry["counts"].as_py()
        if len(held) > counters:
            n = np.fromiter(held.values(), dtype=np.int64, count=len(held))
            cut = int(np.partition(n, len(n) - counters - 1)[len(n) - counters - 1])
            held = {k: v - cut for k, v in held.items() if v > cut}
            lost += cut
    items = [*held, None]
    yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array([*held.values(), lost], pa.int64())], ["item", "n"])


def heavy_hitters(df: DataFrame, k: int, items: str = "items", counters: int = COUNTERS) -> DataFrame:
    """``baskets.top_k_items`` without a count of every item: the ``k`` most frequent
    items with their exact counts, ties by item.

    The first pass leaves a summary of each task, ``counters`` rows whatever the
    number of items; summed, a count is too small by the sum of what tasks lost at
    most. The second counts only the items that may be among the ``k``. If the
    last of them does not exceed what an item outside the summaries could have, the
    bound fails and all items are counted.
    """
    ship_package(df.sparkSession)
    parts = df.select(F.col(items).cast("array<string>").alias("items")).where(F.col("items").isNotNull())
    summed = write_shared(
        parts.mapInArrow(partial(_summary, counters), "item string, n long").groupBy("item").agg(F.sum("n").alias("n")), "summaries"
    )
    lost = summed.where("item IS NULL").agg(F.max("n")).first()[0] or 0
    known = rank_items(summed.where("item IS NOT NULL")).limit(k).collect()  # k rows
    least = known[-1]["n"] if len(known) == k else 0
    maybe = summed.where(F.col("item").isNotNull() & (F.col("n") + lost >= least)).select("item")
    exact = explode_items(df, items).select(F.col("item").cast("string").alias("item")).join(maybe, "item", "left_semi")
    top = write_shared(rank_items(exact.groupBy("item").agg(F.count(F.lit(1)).alias("n"))).limit(k), "heavy")
    worst = top.agg(F.count(F.lit(1)).alias("rows"), F.min("n").alias("n")).first()
    if lost and (worst["rows"] < k or worst["n"] <= lost):
        return rank_items(item_counts(df, items)).limit(k)
    return rank_items(top)


def distinct_sketches(df: DataFrame, by: str, value: str, lg_registers: int = LG_REGISTERS) -> DataFrame:
    """(by, sketch): a sketch of the distinct values of each period, to be stored and united."""
    return df.groupBy(by).agg(F.hll_sketch_agg(value, F.lit(lg_registers)).alias("sketch"))


def united_distinct(sketches: DataFrame, out: str = "distinct") -> DataFrame:
    """One row: distinct values of all the given periods together, estimated from their sketches."""
    return sketches.agg(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).alias(out))
