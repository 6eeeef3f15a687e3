"""Frequent pairs and triples of wide baskets from bitmaps.

Pairs are counted in tiles of the pair table (``pair_tiles``): an item that many of
the baskets hold is a bitmap, and the baskets that hold two such items are
the bits common to both; rarer items are lists of baskets.

Triples are counted by their first item: its baskets, with the later items that
enough of them hold, are a matrix of bits, and its product with itself has the
baskets that also hold each pair of them. First items are dealt into groups. The
baskets are stored once, by chunks; a group's task reads them all there, so none is
shuffled for each group, and keeps those that hold an item of its group, from that item on,
in a file of its own, mapped into memory. It counts the pairs of a first item itself.
Counts are taken some rows of the product at a time.

Items are numbered in ascending order, so numbers compare like items.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from quarry.operators import item_chunks, pair_tiles
from quarry.operators.baskets import threshold_column
from quarry.operators.itemsets import least
from quarry.session import scratch, shared_folder, write_shared, write_united

_GROUPS = 48  # of first items
_CELLS = 1 << 24  # of a matrix of bits, spread out for a product
_COUNTS = 1 << 25  # held at once
_FOUND = 1 << 20  # looked through at once
_SLICE = 1 << 21  # items read at once
_ROWS = 1 << 16


def _distinct(df: DataFrame, items: str) -> DataFrame:
    """The distinct items of each basket of two at least: no other holds a pair."""
    return df.select(F.array_distinct(F.filter(F.col(items), lambda x: x.isNotNull())).alias("items")).where(F.size("items") > 1)


def frequent_pairs(df: DataFrame, threshold: int | None = None, min_support: float | None = None, items: str = "items") -> DataFrame:
    """(item_1, item_2, n): pairs held by more than ``threshold`` baskets, as
    ``itemsets.frequent_pairs`` gives them."""
    return pair_tiles.frequent_pairs(_distinct(df, items), least(df, threshold_column(df, threshold, min_support)), bitmaps=True)


def _whole(kind: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, sizes, items): the chunks' baskets, each chunk one row."""
    for number, sizes, items in item_chunks.by_basket(batches):
        cols = [pa.array([number]), pa.array([sizes.astype("<u4").tobytes()], pa.binary()), pa.array([items.astype(kind).tobytes()], pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, ["chunk", "sizes", "items"])


def _from_first(groups: int, part: int, sizes: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(items per basket, items) of the baskets that hold an item of the group, from the first such item on."""
    sizes = sizes.astype(np.int64)
    ends = np.cumsum(sizes)
    at = np.flatnonzero(items % groups == part)
    basket, first = np.unique(np.searchsorted(ends, at, "right"), return_index=True)
    first = at[first]
    left = ends[basket] - first
    first, left = first[left > 2], left[left > 2]
    keep = np.zeros(len(items) + 1, dtype=np.int8)
    keep[first] = 1
    keep[first + left] -= 1
    return left, items[np.cumsum(keep[:-1], dtype=np.int8).astype(bool)]


def _suffixes(items: np.ndarray, first: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(lengths, items) of some of the stretches [first, end) of ``items`` at a time."""
    size = end - first
    before = np.concatenate([[0], np.cumsum(size)])
    at = 0
    while at < len(size):
        to = max(at + 1, int(np.searchsorted(before, before[at] + _SLICE, "right")) - 1)
        n = size[at:to]
        yield n, np.asarray(items[np.arange(before[to] - before[at]) + np.repeat(first[at:to] - (before[at:to] - before[at]), n)])
        at = to


def _partners(items: np.ndarray, first: np.ndarray, end: np.ndarray, size: int, more_than: int) -> np.ndarray:
    """Later items in more than so many of an item's baskets."""
    n = np.zeros(size + 1, dtype=np.int64)
    for _, own in _suffixes(items, first, end):
        n += np.bincount(own, minlength=size + 1)
    return np.flatnonzero(n > more_than)


def _held_with(items: np.ndarray, first: np.ndarray, end: np.ndarray, partners: np.ndarray, size: int, more_than: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(b, c, n): pairs of an item's partners in more than so many of its baskets."""
    place = np.full(size + 1, -1, dtype=np.int64)
    place[partners] = np.arange(len(partners))
    width = len(partners)
    some, high = max(1, _CELLS // width), max(1, _COUNTS // width)
    for low in range(0, width, high):
        counts = np.zeros((min(high, width - low), width - low), dtype=np.uint32)
        product = np.empty(counts.shape, dtype=np.float32)
        for n, own in _suffixes(items, first, end):
            row, col = np.repeat(np.arange(len(n)), n), place[own]
            row, col = row[col >= low], col[col >= low] - low
            for at in range(0, len(n), some):
                i, j = np.searchsorted(row, [at, at + some])
                bits = np.zeros((min(some, len(n) - at), width - low), dtype=np.float32)
                bits[row[i:j] - at, col[i:j]] = 1
                np.matmul(bits[:, :high].T, bits, out=product)  # whole numbers below 2^24
                np.add(counts, product, out=counts, casting="unsafe")
        for at in range(0, len(counts), step := max(1, _FOUND // (width - low))):
            b, c = np.nonzero(counts[at : at + step] > more_than)
            b += at
            b, c = b[b < c], c[b < c]
            if len(b):
                yield partners[low + b], partners[low + c], counts[b, c]


def _triples(groups: int, part: int, kind: str, more_than: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Triples of a group, from the rows of all chunks."""
    names, sizes, file = None, [], tempfile.TemporaryFile()

    def found() -> Iterator[tuple[np.ndarray, ...]]:
        file.flush()
        items = np.memmap(file, dtype=kind, mode="r")
        ends = np.cumsum(np.concatenate(sizes), dtype=np.int64)
        at = np.concatenate([i + np.flatnonzero(items[i : i + _SLICE] % groups == part) for i in range(0, len(items), _SLICE)])
        held = items[at]
        order = np.argsort(held, kind="stable")
        at, held = at[order], held[order]
        firsts, start = np.unique(held, return_index=True)
        for a, i, j in zip(firsts.tolist(), start, [*start[1:], len(held)], strict=True):
            if j - i > more_than:
                first, end = at[i:j] + 1, ends[np.searchsorted(ends, at[i:j], "right")]
                partners = _partners(items, first, end, len(names), more_than)
                for b, c, n in _held_with(items, first, end, partners, len(names), more_than) if len(partners) > 1 else ():
                    yield np.full(len(b), a), b, c, n

    def named(rows: list) -> Iterator[pa.RecordBatch]:
        *numbers, n = (np.concatenate(c) for c in zip(*rows, strict=True))
        for k in range(0, len(n), _ROWS):
            cols = [names.take(pa.array(c[k : k + _ROWS].astype(np.int64) - 1)) for c in numbers]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n[k : k + _ROWS], pa.int64())], ["item_1", "item_2", "item_3", "n"])

    for batch in batches:
        for chunk, length, held, own in zip(*(batch.column(c) for c in ("chunk", "sizes", "items", "names")), strict=True):
            if chunk.as_py() < 0:
                names = own.values
                continue
            left, items = _from_first(groups, part, np.frombuffer(length.as_py(), "<u4"), np.frombuffer(held.as_py(), kind))
            if len(left):
                sizes.append(left)
                file.write(items)
    rows, n = [], 0
    for cols in found() if sizes else ():
        rows.append(cols)
        n += len(cols[0])
        if n >= _ROWS:
            yield from named(rows)
            rows, n = [], 0
    if n:
        yield from named(rows)


def frequent_triples(df: DataFrame, threshold: int | None = None, min_support: float | None = None, items: str = "items") -> DataFrame:
    """(item_1, item_2, item_3, n): triples held by more than ``threshold``
    baskets, as ``itemsets.frequent_triples`` gives them.

    Empty and null baskets count for ``min_support`` and hold nothing; an item repeated in a basket counts once.
    """
    spark, of = df.sparkSession, df.schema[items].dataType.elementType
    more_than = least(df, threshold_column(df, threshold, min_support))
    schema = StructType().add("item_1", of).add("item_2", of).add("item_3", of).add("n", LongType())
    found = shared_folder(spark, "frequent-triples")
    with scratch(spark):
        folder = shared_folder(spark, "whole-chunks")
        with scratch(spark):
            names, chunks = item_chunks.numbered(item_chunks.by_item(_distinct(df, items)), more_than)
            size = names.count()
            kind = "<u2" if size < 1 << 16 else "<u4"
            data = chunks.mapInArrow(partial(_whole, kind), "chunk long, sizes binary, items binary")
            own = names.agg(F.sort_array(F.collect_list(F.struct("item", "name"))).alias("named"))
            own = own.select(F.lit(-1).cast("long").alias("chunk"), F.col("named.name").alias("names"))
            stored = write_shared(data.unionByName(own, allowMissingColumns=True), "whole-chunks", folder)
        groups = max(1, min(_GROUPS, size))
        parts = [stored.coalesce(1).mapInArrow(partial(_triples, groups, g, kind, more_than), schema) for g in range(groups)]
        write_united(parts, found)
    return spark.read.schema(schema).parquet(found)
