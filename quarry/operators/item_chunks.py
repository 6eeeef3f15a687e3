"""Wide baskets in item numbers, by chunks of baskets.

The baskets of a chunk are stored by item: each item with the chunk's baskets that
hold it, two bytes for a basket. Items are counted in that table, numbered in
ascending order, and joined to their numbers there, so no item of a basket is ever
a row of its own. A chunk in item numbers is put together by basket again by one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, MapType, StructType

from quarry.operators.ranks import with_places
from quarry.session import ship_package, write_shared

_ENTRIES = 1 << 21  # items of a chunk of baskets
_BASKETS = 1 << 16  # baskets of a chunk at most: two bytes number them
_SOME = 1 << 10  # baskets added to a chunk at once
_ROWS = 1 << 16
_BROADCAST = 1 << 19  # numbered items at most that are sent to every executor


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[pa.Array]]]:
    """(chunk number, baskets) of some baskets at a time, from a column ``items``."""
    from pyspark import TaskContext

    number, lists, baskets, held = TaskContext.get().partitionId() << 32, [], 0, 0
    for batch in batches:
        for at in range(0, batch.num_rows, _SOME):
            some = batch.column("items").slice(at, _SOME)
            if held >= _ENTRIES or baskets + len(some) > _BASKETS:
                yield number, lists
                number, lists, baskets, held = number + 1, [], 0, 0
            lists.append(some)
            baskets += len(some)
            held += len(some.flatten())
    if lists:
        yield number, lists


def _by_item(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(name, chunk, n, at): the items of each chunk with the baskets that hold them."""
    for number, lists in _chunks(batches):
        sizes = np.concatenate([x.value_lengths().to_numpy(zero_copy_only=False) for x in lists])
        coded = pa.concat_arrays([x.flatten() for x in lists]).dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False)
        at = np.repeat(np.arange(len(sizes)), sizes)[np.argsort(code, kind="stable")].astype("<u2")
        n = np.bincount(code, minlength=len(coded.dictionary))
        ends = np.concatenate([[0], np.cumsum(n)])
        for k in range(0, len(n), _ROWS):
            cuts = ends[k : k + _ROWS + 1]
            held = [None, pa.py_buffer(((cuts - cuts[0]) * 2).astype("<i4")), pa.py_buffer(at[cuts[0] : cuts[-1]])]
            some = len(cuts) - 1
            cols = [coded.dictionary.slice(k, some), pa.array(np.full(some, number)), pa.array(n[k : k + some]), pa.Array.from_buffers(pa.binary(), some, held)]
            yield pa.RecordBatch.from_arrays(cols, ["name", "chunk", "n", "at"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The baskets of an item, a list, in two bytes each."""
    for batch in batches:
        lists = batch.column("at")
        held = [np.asarray(x.values, dtype="<u2").tobytes() for x in lists]
        n = lists.value_lengths().cast(pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("name"), batch.column("chunk"), n, pa.array(held, pa.binary())], ["name", "chunk", "n", "at"])


def by_item(baskets: DataFrame) -> DataFrame:
    """(name, chunk, n, at): the items of each chunk of baskets with the baskets that hold
    them, written once. ``items`` has no item twice and no null."""
    ship_package(baskets.sparkSession)
    kind = baskets.schema["items"].dataType.elementType
    schema = StructType().add("name", kind).add("chunk", LongType()).add("n", LongType()).add("at", BinaryType())
    if isinstance(kind, (ArrayType, MapType, StructType)):  # Arrow can't code them
        ids = baskets.select(F.monotonically_increasing_id().alias("id"), "items")
        rows = ids.select(F.explode("items").alias("name"), F.shiftright("id", 12).alias("chunk"), F.col("id").bitwiseAND(4095).alias("at"))
        lists = rows.groupBy("name", "chunk").agg(F.sort_array(F.collect_list("at")).alias("at"))
        return write_shared(lists.mapInArrow(_packed, schema), "items-of-chunks")
    return write_shared(baskets.select("items").mapInArrow(_by_item, schema), "items-of-chunks")


def numbered(held: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """Of the chunks ``held`` by item, the items in more than ``least`` baskets (name, n, item), with their numbers from 1, ascending
    like the names, and the chunks by number (item, chunk, at), the rows of a chunk together and in order."""
    singles = held.groupBy("name").agg(F.sum("n").alias("n")).where(F.col("n") > least)
    names = write_shared(with_places(singles, F.col("name"), out="item"), "item-numbers")
    some = names.select("name", "item")
    rows = held.select("name", "chunk", "at").join(F.broadcast(some) if names.count() <= _BROADCAST else some, "name")
    return names, rows.select("item", "chunk", "at").repartition("chunk").sortWithinPartitions("chunk", "item")


def by_basket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(chunk, items per basket, items by basket in ascending order), from the rows of ``numbered``."""

    def whole() -> tuple[int, np.ndarray, np.ndarray]:
        items, at = (np.concatenate(x) for x in zip(*rows, strict=True))
        order = np.argsort(at, kind="stable")
        return now, np.bincount(at), items[order]

    now, rows = None, []
    for batch in batches:
        chunk, item = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("chunk", "item"))
        for i, j in pairwise([*np.flatnonzero(np.diff(chunk, prepend=chunk[0] - 1)).tolist(), len(chunk)] if len(chunk) else []):
            if rows and chunk[i] != now:
                yield whole()
                rows = []
            now, held = int(chunk[i]), batch.column("at").slice(i, j - i).to_pylist()
            rows.append((np.repeat(item[i:j], [len(x) // 2 for x in held]), np.frombuffer(b"".join(held), "<u2")))
    if rows:
        yield whole()
