"""Item pairs of wide baskets, counted in tiles of the pair table.

Items are numbered in ascending order and dealt into blocks; a tile is all pairs
of two blocks. The baskets are stored once, by block, two bytes for an item; a
tile's task reads its two blocks there, so nothing is shuffled for each tile. It
keeps them in files of its own, maps these into memory, and counts the pairs of one
first item at a time, so a pair is never a row before it is known to be frequent.

With ``bitmaps`` items in many of the baskets are bitmaps there: pairs
of two such items are the bits common to both.
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

from quarry.operators import item_chunks
from quarry.session import delete_shared, scratch, shared_folder, write_shared, write_united

WIDTH = (1 << 16) - 1  # items of a block at most: two bytes number them
GROUPS = 14  # blocks, if there are items enough: 105 tiles
_LEAST = 1 << 20  # items of baskets in a block, below which there are fewer blocks
_MOST = 1 << 27  # and above which there are more
_TILES = 256  # of one job
_HELD = 1 << 22  # items of baskets looked up by first item at once
_AT_ONCE = 1 << 20  # pairs counted at once
_DENSE = 16  # an item in one of so many baskets is a bitmap
_ROWS = 1 << 16


def _dealt(blocks: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, chunk, sizes, items): the items of a chunk that lie in each block, by basket."""
    for number, sizes, items in item_chunks.by_basket(batches):
        block = (items - 1) % blocks
        order = np.argsort(block.astype("<u2"), kind="stable")  # within a block by basket, then item
        local = ((items - 1) // blocks).astype("<u2")[order]
        n = np.bincount(block * len(sizes) + np.repeat(np.arange(len(sizes)), sizes), minlength=blocks * len(sizes)).reshape(blocks, -1)
        parts = np.split(local, np.cumsum(n.sum(axis=1))[:-1])
        cols = [pa.array(np.arange(blocks), pa.int32()), pa.array(np.full(blocks, number))]
        cols += [pa.array([x.astype("<u2").tobytes() for x in n], pa.binary()), pa.array([x.tobytes() for x in parts], pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, ["block", "chunk", "sizes", "items"])


class _Block:
    """The items of a block, chunk by chunk, in a file: no memory of the task."""

    def __init__(self) -> None:
        self.names, self.sizes, self.first, self._n, self._file = None, {}, {}, 0, tempfile.TemporaryFile()

    def add(self, chunk: int, sizes: np.ndarray, items: np.ndarray) -> None:
        self.sizes[chunk], self.first[chunk] = sizes, self._n
        self._n += len(items)
        self._file.write(items)

    def items(self) -> np.ndarray:
        self._file.flush()
        return np.asarray(np.memmap(self._file, "<u2", "r")) if self._n else np.empty(0, "<u2")

    def chunks(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(chunk, items per basket, items)"""
        items = self.items()
        for k in sorted(self.sizes):
            first, sizes = self.first[k], self.sizes[k]
            yield k, sizes, items[first : first + int(sizes.sum(dtype=np.int64))]

    def counts(self) -> np.ndarray:
        """Baskets of each item."""
        n = np.zeros(len(self.names), dtype=np.int64)
        for _, _, items in self.chunks():
            n += np.bincount(items, minlength=len(n))
        return n

    def starts(self) -> tuple[np.ndarray, np.ndarray]:
        """Where the items of each basket begin, and how many they are, with the baskets of all chunks in one row."""
        sizes = [self.sizes[k].astype(np.int64) for k in sorted(self.sizes)]
        firsts = [self.first[k] + np.cumsum(n) - n for k, n in zip(sorted(self.sizes), sizes, strict=True)]
        return np.concatenate(firsts), np.concatenate(sizes)

    def without(self, items: np.ndarray) -> _Block:
        """The block without some items, which keep their places."""
        out, drop = _Block(), np.zeros(len(self.names), dtype=bool)
        out.names, drop[items] = self.names, True
        for k, sizes, own in self.chunks():
            keep = ~drop[own]
            left = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[keep], minlength=len(sizes))
            out.add(k, left.astype("<u2"), own[keep])
        return out


def _baskets_of(block: _Block, counts: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(item, baskets): each item with the baskets that hold it, some items looked up at a time."""
    after = np.cumsum(counts)
    cuts = np.searchsorted(after, np.arange(_HELD, int(after[-1]) + _HELD, _HELD)) + 1
    low = 0
    for high in np.unique(np.minimum(cuts, len(counts))).tolist():
        baskets, held, base = [], [], 0
        for _, sizes, items in block.chunks():
            keep = (items >= low) & (items < high)
            baskets.append(np.repeat(np.arange(base, base + len(sizes), dtype=np.uint32), sizes)[keep])
            held.append(items[keep])
            base += len(sizes)
        found = np.concatenate(baskets)[np.argsort(np.concatenate(held), kind="stable")]
        ends = after[low:high] - (after[low] - counts[low])
        for item, own in zip(range(low, high), np.split(found, ends[:-1]), strict=True):
            yield item, own
        low = high


def _held_with(baskets: np.ndarray, starts: np.ndarray, sizes: np.ndarray, items: np.ndarray, width: int) -> np.ndarray:
    """How many of the baskets hold each item of a block."""
    size, first = sizes[baskets], starts[baskets]
    before = np.concatenate([[0], np.cumsum(size)])
    n, at = np.zeros(width, dtype=np.int64), 0
    while at < len(size):
        to = max(at + 1, int(np.searchsorted(before, before[at] + _AT_ONCE, "right")) - 1)
        where = np.repeat(first[at:to] - (before[at:to] - before[at]), size[at:to])
        where += np.arange(len(where))
        n += np.bincount(items[where], minlength=width)
        at = to
    return n


def _bits(sizes: np.ndarray, items: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """One bitmap over a chunk's baskets for each of the items ``numbers``."""
    held = np.zeros((len(numbers), -(-len(sizes) // 64) * 64), dtype=bool)
    basket = np.repeat(np.arange(len(sizes)), sizes)
    own = np.isin(items, numbers)
    held[np.searchsorted(numbers, items[own]), basket[own]] = True
    return np.packbits(held, axis=1).view("<u8")


def _common(one: _Block, rows: np.ndarray, other: _Block, cols: np.ndarray) -> np.ndarray:
    """Baskets that hold two items, for all items ``rows`` and ``cols``, from bitmaps."""
    n = np.zeros((len(rows), len(cols)), dtype=np.int64)
    for (_, *a), (_, *b) in zip(one.chunks(), other.chunks(), strict=True):
        theirs = _bits(*b, cols)
        for k, bits in enumerate(_bits(*a, rows)):
            n[k] += np.bitwise_count(theirs & bits).sum(axis=1, dtype=np.int64)
    return n


def _tile(one: _Block, other: _Block, least: int, bitmaps: bool) -> Iterator[tuple[np.ndarray, ...]]:
    """(a, b, n): places of pairs of the two blocks' items in more than ``least`` baskets."""
    if not one.sizes:
        return
    counts, width, both = one.counts(), len(other.names), {}
    if bitmaps:
        often = max(1, sum(map(len, one.sizes.values())) // _DENSE)
        rows, cols = np.flatnonzero(counts >= often), np.flatnonzero(other.counts() >= often)
        if len(rows) and len(cols):
            both = dict(zip(rows.tolist(), _common(one, rows, other, cols), strict=True))
            rarer = other.without(cols)
            rare = *rarer.starts(), rarer.items()
    whole = *other.starts(), other.items()
    for a, baskets in _baskets_of(one, counts):
        n = _held_with(baskets, *(rare if a in both else whole), width)
        if a in both:
            n[cols] = both[a]
        b = np.flatnonzero(n > least)
        if one is other:
            b = b[b > a]
        if len(b):
            yield np.full(len(b), a), b, n[b]


def _counted(blocks: int, i: int, j: int, least: int, bitmaps: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item_1, item_2, n): the pairs of a tile in more than ``least`` baskets, from the rows of its two blocks."""
    held = {k: _Block() for k in (i, j)}
    for batch in batches:
        for block, chunk, sizes, items, names in zip(*(batch.column(c) for c in ("block", "chunk", "sizes", "items", "names")), strict=True):
            own = held[block.as_py()]
            if chunk.as_py() < 0:
                own.names = names.values
            else:
                own.add(chunk.as_py(), np.frombuffer(sizes.as_py(), "<u2"), np.frombuffer(items.as_py(), "<u2"))
    one, other = held[i], held[j]
    rows, n = [], 0

    def named() -> Iterator[pa.RecordBatch]:
        a, b, count = (np.concatenate(x) for x in zip(*rows, strict=True))
        turned = a * blocks + i > b * blocks + j
        x, y = a, b + len(one.names)
        cols = [both.take(pa.array(np.where(turned, y, x))), both.take(pa.array(np.where(turned, x, y))), pa.array(count, pa.int64())]
        for k in range(0, len(count), _ROWS):
            yield pa.RecordBatch.from_arrays([c.slice(k, _ROWS) for c in cols], ["item_1", "item_2", "n"])

    both = pa.concat_arrays([one.names, other.names]) if one.sizes else None
    for found in _tile(one, other, least, bitmaps):
        rows.append(found)
        n += len(found[0])
        if n >= _ROWS:
            yield from named()
            rows, n = [], 0
    if rows:
        yield from named()


def frequent_pairs(baskets: DataFrame, least: int, bitmaps: bool = False, spent: str | None = None) -> DataFrame:
    """(item_1, item_2, n): pairs of items in more than ``least`` baskets, written once.

    ``baskets`` has a column ``items``, without nulls and none twice. What is written on the
    way is deleted, and so is the folder ``spent``, if given, once the baskets are read from it.
    """
    spark, kind = baskets.sparkSession, baskets.schema["items"].dataType.elementType
    schema = StructType().add("item_1", kind).add("item_2", kind).add("n", LongType())
    found = shared_folder(spark, "frequent-pairs")
    with scratch(spark):
        folder = shared_folder(spark, "blocks")
        with scratch(spark):
            rows = item_chunks.by_item(baskets)
            if spent:
                delete_shared(spark, spent)
            names, chunks = item_chunks.numbered(rows, least)
            held = names.agg(F.count(F.lit(1)).alias("items"), F.sum("n").alias("n")).first()
            entries = held["n"] or 0
            blocks = max(min(-(-entries // _LEAST), GROUPS, held["items"]), -(-entries // _MOST), -(-held["items"] // WIDTH), 1)
            data = chunks.mapInArrow(partial(_dealt, blocks), "block int, chunk long, sizes binary, items binary")
            block = ((F.col("item") - 1) % blocks).cast("int").alias("block")
            own = names.groupBy(block).agg(F.sort_array(F.collect_list(F.struct("item", "name"))).alias("named"))
            own = own.select("block", F.lit(-1).cast("long").alias("chunk"), F.col("named.name").alias("names"))
            stored = write_shared(data.unionByName(own, allowMissingColumns=True), "blocks", folder, ("block",))
        tiles = [(i, j) for i in range(blocks) for j in range(i, blocks)]
        for k in range(0, len(tiles), _TILES):
            some = [stored.where(F.col("block").isin(i, j)).coalesce(1).mapInArrow(partial(_counted, blocks, i, j, least, bitmaps), schema) for i, j in tiles[k : k + _TILES]]
            write_united(some, found)
    return spark.read.schema(schema).parquet(found)
