"""The place of every row in a global order, without a single-task window."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import write_shared


def with_places(df: DataFrame, *order: Column, out: str = "place", partitions: int | None = None) -> DataFrame:
    """``df`` with each row's place, from 1, in the order of the given columns.

    Rows are dealt by ranges of the order, sorted in their range and numbered
    there; the rows of all ranges before are added (one number per range). Rows
    equal in the order get places of their own in any order; they are dealt out
    by their place in the input too, so that many of them do not meet in one range.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mark = "_" + uuid.uuid4().hex[:8]  # a name that no column has
    at, part = f"{mark}at", f"{mark}part"
    keyed = write_shared(df.withColumn(at, F.monotonically_increasing_id()), "unplaced")
    ranged = keyed.repartitionByRange(n, *order, F.col(at)).sortWithinPartitions(*order, F.col(at)).drop(at)
    # In a stored range the lower bits of the id count the rows before.
    numbered = ranged.withColumn(part, F.spark_partition_id()).withColumn(at, F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    stored = write_shared(numbered, "placed")
    sizes = {r[part]: r["n"] for r in stored.groupBy(part).agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per range
    before, rows = 0, []
    for p in sorted(sizes):
        rows.append((p, before))
        before += sizes[p]
    starts = df.sparkSession.createDataFrame(rows, f"{part} int, {mark} long")
    return stored.join(F.broadcast(starts), part).withColumn(out, F.col(mark) + F.col(at) + 1).drop(part, at, mark)
