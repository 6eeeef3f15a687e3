"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import claimed, ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back.

    Cuts the lineage: what a lost executor computed is read again, never
    computed a second time with another row order. In a ``session.scratch``
    scope the folder goes with it.
    """
    spark = df.sparkSession
    path = claimed(f"{ensure_checkpoint_dir(spark)}/llm/{tag}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_STATE: dict[str, tuple] = {}


def worker_state(owner: str, key=None, make: Callable[[], Any] | None = None) -> Any:
    """State that a Python worker keeps from task to task, of one operator at a time.

    Workers are used again by other stages: when another ``owner`` comes, what
    the last one held is dropped and its memory given back. Without ``make`` the owner keeps nothing.
    """
    if owner not in _STATE:
        held = bool(_STATE)
        _STATE.clear()
        if held:
            give_back()
    if make is None:
        _STATE[owner] = (None, None)
    elif owner not in _STATE or _STATE[owner][0] != key:
        _STATE.clear()
        _STATE[owner] = (key, make())
    return _STATE[owner][1]


def give_back() -> None:
    """Return freed memory to the system: Arrow's pool, and the allocator's where it can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def values(column: pa.Array) -> Iterator[Any]:
    """A column's values one by one: never a list of a whole batch's texts."""
    return (v.as_py() for v in column)


def row_key(*cols: str) -> list[Column]:
    """Join columns that name a row by its content, for tables in which ids may
    be null or repeated: rows equal in ``cols`` get equal keys."""
    return [F.xxhash64(*cols).alias("_k1"), F.hash(*cols).alias("_k2")]


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def runs_of(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[pa.Table]:
    """Tables of whole runs of equal ``by`` out of batches sorted by ``by``.

    Holds one batch and the run that crosses its end.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        key = batch.column(by).to_numpy(zero_copy_only=False)
        if held and held[-1].column(by)[-1].as_py() != key[0].item():
            yield pa.Table.from_batches(held)
            held = []
        last = int(np.searchsorted(key, key[-1], side="left"))
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)
