"""The corpus pipeline: filter, deduplicate, decontaminate and pack documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import decontaminate, exact, packing, simhash, toxicity
from quarry.llm.common import staged, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from ``labels``."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of identical texts the document with the largest id stays."""
    return exact.exact_dedup(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: the smallest id."""
    return simhash.drop_near_duplicates(docs, shingle=4, max_bits=4)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", near_dedup),
    ("decontamination", decontaminated),
    ("packing", packed),
]

# SimHash, a trained classifier and token ids have no SQL form; the pipeline is
# tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each over what the one before it kept."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
