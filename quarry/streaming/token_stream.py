"""Prefix-token counts kept current over a stream of arriving files.

The reference counts each day's tweet file in a batch job. Here the same
operator (``tokens.prefix_counts``) runs as a Structured Streaming
aggregation in update mode: the state store holds one running count per token,
and every micro-batch writes the counts that it changed, as one more folder of
a parquet table in the shared checkpoint folder (no memory sink, nothing
gathered on the driver, no rewriting of what is there). Counts only grow, so
the newest count of a token is its largest. ``trigger(availableNow=True)`` processes what is there and stops,
which is also how the tests drive it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators import tokens
from quarry.session import ensure_checkpoint_dir


def _paths(spark: SparkSession, name: str) -> tuple[str, str]:
    root = ensure_checkpoint_dir(spark).rstrip("/")
    run = f"{name}-{uuid.uuid4().hex[:12]}"
    return f"{root}/streams/{run}/state", f"{root}/streams/{run}/result"


def start_prefix_count_stream(
    source: DataFrame,
    prefix: str,
    text_col: str,
    name: str = "prefix_counts",
    available_now: bool = True,
    multi_line: bool = True,
):
    """Start the streaming count over a streaming DataFrame ``source``.

    Returns (StreamingQuery, result path). With ``multi_line`` each value is
    split into lines first (documents); otherwise each value is one line.
    """
    spark = source.sparkSession
    state, result = _paths(spark, name)
    if multi_line:
        counts = tokens.text_prefix_counts(source.select(text_col), prefix, col=text_col)
    else:
        counts = tokens.prefix_counts(source.select(text_col), prefix, col=text_col)

    def write_batch(batch: DataFrame, epoch: int) -> None:
        # A repeated batch replaces its own folder.
        batch.write.mode("overwrite").parquet(f"{result}/epoch={epoch}")

    writer = (
        counts.writeStream.outputMode("update")
        .option("checkpointLocation", state)
        .foreachBatch(write_batch)
        .queryName(f"{name}_{uuid.uuid4().hex[:8]}")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start(), result


def prefix_counts_from_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    prefix: str,
    text_col: str,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    multi_line: bool = True,
    file_glob: str | None = None,
) -> DataFrame:
    """Stream the files of directory ``path`` (optionally only those whose
    name matches ``file_glob``) to completion and return the counts."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    source = reader.load(path)
    query, result = start_prefix_count_stream(source, prefix, text_col, multi_line=multi_line)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    if query.lastProgress is None or query.lastProgress["batchId"] == 0 and not query.lastProgress["numInputRows"]:
        # No file or no row: there may be no batch and so no folder to read.
        spark.createDataFrame([], "token string, n long").write.mode("append").parquet(f"{result}/epoch=-1")
    return latest_counts(spark, result)


def latest_counts(spark: SparkSession, result: str) -> DataFrame:
    """(token, n) as of the last batch written under ``result``."""
    return spark.read.parquet(result).groupBy("token").agg(F.max("n").alias("n"))
