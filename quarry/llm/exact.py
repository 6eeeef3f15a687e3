"""Exact dedup by Grace hashing.

Records are partitioned by a hash of their text into buckets; a bucket is a
Spark partition, its spill files are Spark's shuffle files. The task of a
bucket fills an open-addressing table that compares complete texts. Once the
table holds ``bucket_bytes`` of text it takes no new text: records whose text
is not in it are written out and partitioned again with the hash of the next
level, until no bucket overflows. A text is either in the table of its level
with all its rows or in none, so every class is settled in one task.

A hot text is one record per Arrow batch: rows are combined before the shuffle,
with their ids beside the text. Memory follows ``bucket_bytes`` and the size of
a batch, not the size of a class.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import free_name, staged, values, worker_state
from quarry.session import ship_package

BUCKET_BYTES = 64 << 20
"""Text bytes that one bucket's table may hold."""

ROW_BITS, BUCKET_BITS, LEVEL_BITS = 34, 23, 6
"""Fields of the ids of rows and classes. Runs that need more (some 250 TB of text) are refused."""

_COMBINED = "text string, ids array<long>"
_SETTLED = "doc_id long, class_id long, row_id long, text_sha256 string, text string, ids array<long>"


class ContentTable:
    """Open addressing with linear probing; keys are whole texts.

    A slot holds the number of a text. The stored 64-bit hash only spares
    comparisons: two texts are equal if their bytes are.
    """

    def __init__(self, limit: float = math.inf):
        self.limit = limit
        self.used = 0
        self.texts: list[bytes] = []
        self.hashes: list[int] = []
        self.slots = np.full(1024, -1, dtype=np.int64)

    def _slot(self, text: bytes, h: int) -> int:
        mask = len(self.slots) - 1
        at = h & mask
        while (n := self.slots[at]) >= 0 and not (self.hashes[n] == h and self.texts[n] == text):
            at = (at + 1) & mask
        return at

    def add(self, text: bytes) -> tuple[int, bool]:
        """Number of ``text`` and whether it is new; -1 if it is new and the table is full."""
        h = xxhash.xxh3_64_intdigest(text)
        at = self._slot(text, h)
        if (n := int(self.slots[at])) >= 0:
            return n, False
        if self.texts and self.used + len(text) > self.limit:
            return -1, True
        n = len(self.texts)
        self.texts.append(text)
        self.hashes.append(h)
        self.used += len(text)
        self.slots[at] = n
        if 2 * len(self.texts) > len(self.slots):
            self._grow()
        return n, True

    def _grow(self) -> None:
        self.slots = np.full(4 * len(self.slots), -1, dtype=np.int64)
        mask = len(self.slots) - 1
        for n, h in enumerate(self.hashes):
            at = h & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = n


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One record per text of a batch, with the ids of its rows."""
    worker_state("exact")
    for batch in batches:
        content = ContentTable()
        of = np.array([content.add(t)[0] for t in _bytes(batch.column("text"))], dtype=np.int64)
        order = np.argsort(of, kind="stable")
        ends = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(content.texts)))])
        ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), batch.column("doc_id").take(pa.array(order)))
        yield pa.RecordBatch.from_arrays([pa.array(content.texts, pa.binary()).cast(pa.string()), ids], ["text", "ids"])


def _bytes(column: pa.Array) -> Iterator[bytes]:
    return (t or b"" for t in values(column.cast(pa.binary())))


def _settle(limit: int, level: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the texts that the bucket's table holds; whole records of the others."""
    content = ContentTable(limit)
    digests: list[str] = []
    prefix = (level << BUCKET_BITS | TaskContext.get().partitionId()) << ROW_BITS
    rows = 0
    for batch in batches:
        of = []
        for t in _bytes(batch.column("text")):
            n, new = content.add(t)
            if new and n >= 0:
                digests.append(hashlib.sha256(t).hexdigest())
            of.append(n)
        of = np.array(of, dtype=np.int64)
        held = pa.array(np.flatnonzero(of >= 0))
        late = pa.array(np.flatnonzero(of < 0))
        ids = batch.column("ids")
        mine = ids.take(held)
        sizes = np.diff(mine.offsets.to_numpy())
        each = np.repeat(of[of >= 0], sizes)
        n = len(each)
        if n:
            yield pa.RecordBatch.from_arrays(
                [
                    mine.flatten(),
                    pa.array(each + prefix),
                    pa.array(np.arange(rows, rows + n) + prefix),
                    pa.array(digests, pa.string()).take(pa.array(each)),
                    pa.nulls(n, pa.string()),
                    pa.nulls(n, pa.list_(pa.int64())),
                ],
                _names(_SETTLED),
            )
            rows += n
        if len(late):
            k = len(late)
            empty = [pa.nulls(k, pa.int64())] * 3 + [pa.nulls(k, pa.string())]
            yield pa.RecordBatch.from_arrays([*empty, batch.column("text").take(late), ids.take(late)], _names(_SETTLED))


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def exact_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """Class of every row among rows with the identical text.

    One row per row of ``docs``: ``doc_id, keep_id, group_size, kept,
    text_sha256, keep_rows``. ``keep_id`` is the largest id of the class and
    exactly one row of a class has ``kept``: a row with that id (of repeated
    rows with the same id and text, any one). A null text counts as empty;
    null ids are smaller than all others and a class of null ids alone has a
    null ``keep_id``. ``keep_rows`` counts the rows of the class that have
    ``keep_id``. Other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    pending = rows.mapInArrow(_combine, _COMBINED)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts, level = [], 0
    while True:
        # Twice the buckets that the bytes ask for: texts fall unevenly.
        buckets = max(1, 2 * size // bucket_bytes + 1, spark.sparkContext.defaultParallelism)
        if buckets >> BUCKET_BITS or level >> LEVEL_BITS:
            raise ValueError(f"{buckets} buckets at level {level}: raise bucket_bytes")
        out = staged(
            pending.repartition(int(buckets), F.xxhash64(F.lit(level), "text")).mapInArrow(
                partial(_settle, bucket_bytes, level), _SETTLED
            ),
            f"grace-{level}",
        )
        parts.append(out.where(F.col("text").isNull()).select("doc_id", "class_id", "row_id", "text_sha256"))
        pending = out.where(F.col("text").isNotNull()).select("text", "ids")
        size = pending.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
        if not size:
            break
        level += 1
    members = parts[0]
    for part in parts[1:]:
        members = members.unionByName(part)
    by_id = members.groupBy("class_id", "doc_id").agg(F.count(F.lit(1)).alias("same_id"), F.max("row_id").alias("row_id"))
    classes = by_id.groupBy("class_id").agg(
        F.max("doc_id").alias("keep_id"),
        F.sum("same_id").alias("group_size"),
        F.max(F.struct("doc_id", "row_id", "same_id")).alias("best"),
    )
    # Only classes of several rows are joined; a class is unique on its side.
    # Written first, so that both sides of the join come from an exchange of
    # their own: only then AQE splits the rows of a hot class.
    several = classes.where(F.col("group_size") > 1).select(
        "class_id", "keep_id", "group_size", F.col("best.row_id").alias("keep_row"), F.col("best.same_id").alias("best_same")
    )
    joined = members.join(staged(several, "exact-several"), "class_id", "left")
    alone = F.col("group_size").isNull()
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row_id") == F.col("keep_row"))).alias("kept"),
        "text_sha256",
        F.coalesce("best_same", F.lit(1)).alias("keep_rows"),
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, one per text, with their columns.

    Of equal texts the row with the largest id stays; see ``exact_classes``.
    """
    sha, keep = free_name(docs, "_sha"), free_name(docs, "_keep")
    classes = staged(exact_classes(docs, id_col, text_col, bucket_bytes), "exact-classes")
    kept = classes.where("kept").select(F.col("doc_id").alias(keep), F.col("text_sha256").alias(f"{sha}_kept"))
    left = docs.withColumn(sha, F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    same = (left[sha] == kept[f"{sha}_kept"]) & left[id_col].cast("long").eqNullSafe(kept[keep])
    out = left.join(kept, same, "left_semi")
    if classes.where("kept and keep_rows > 1").limit(1).count():
        out = out.dropDuplicates([id_col, sha])  # rows repeated with their id
    return out.drop(sha)
