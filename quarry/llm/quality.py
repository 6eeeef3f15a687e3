"""Quality by compression: zstandard dictionaries of good and of bad text.

A text is cut into blocks; every block is compressed with either dictionary. The
difference of the two sizes, over their sum, tells which kind the text is
nearer to; a logistic curve fitted on labelled texts that no dictionary holds
turns it into a score. Blocks keep the dictionary in view of a long text's end.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm import labelled
from quarry.llm.common import staged, values, worker_state
from quarry.session import ship_package

SAMPLE_ROWS = 3000
"""Bound on the labelled documents of each label: half for the dictionary, half for the curve."""
DICTIONARY_BLOCKS = 1500
"""Bound on the blocks of each label that its dictionary is built from."""
DICTIONARY_BYTES = 64 << 10
BLOCK = 4096
LEVEL = 3
FOLDS, FOLD = 4, 2
"""Labels of ids on this fold are never learned."""
REGULARISATION = 1e-6


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_dict_id=False)


def _compressors(good: bytes, bad: bytes) -> list[zstandard.ZstdCompressor]:
    return [_compressor(good), _compressor(bad)]


def blocks(raw: bytes) -> Iterator[bytes]:
    return (raw[at : at + BLOCK] for at in range(0, len(raw), BLOCK))


def difference(text: str | None, good: bytes, bad: bytes) -> float:
    """(bad - good) / (bad + good) of the compressed sizes; 0 for an empty text."""
    raw = (text or "").encode()
    if not raw:
        return 0.0
    both = worker_state("quality", (good, bad), partial(_compressors, good, bad))
    sizes = [sum(len(c.compress(b)) for b in blocks(raw)) for c in both]
    return (sizes[1] - sizes[0]) / (sizes[1] + sizes[0])


def _differ(good: bytes, bad: bytes) -> Callable[[str], Column]:
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in texts:
            yield pa.array([difference(t, good, bad) for t in values(part)], pa.float64())

    return F.arrow_udf(score, "double")


def _dictionary(texts: DataFrame) -> bytes:
    """Trained on a bounded number of blocks, which come to the driver."""
    whole = F.col("text").cast("binary")
    starts = F.sequence(F.lit(1), F.greatest(F.length(whole), F.lit(1)), F.lit(BLOCK))
    cut = texts.select(whole.alias("raw"), F.explode(starts).alias("at")).select(F.substring("raw", F.col("at"), F.lit(BLOCK)).alias("block"))
    some = cut.orderBy(F.xxhash64("block"), "block").limit(DICTIONARY_BLOCKS).collect()
    found = [bytes(r.block) for r in some if r.block]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, found, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too few texts to choose from: their content is the dictionary
        return b"".join(found)[-DICTIONARY_BYTES:]


def scorer(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE_ROWS
) -> Callable[[str], Column]:
    """Score of a text column, 0 to 1, fitted on up to ``rows`` learnable documents of each label.

    Null counts as empty. Without enough documents of both labels every score is 0.
    """
    ship_package(docs.sparkSession)
    ids, odds = labelled.sample(labels, label_col, id_col, FOLDS, FOLD, rows)
    # 2 * rows ids at most: the broadcast is bounded.
    known = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(ids), "id")
    # Halves by text, so that no text of a dictionary calibrates it.
    known = staged(known.select("text", "y", (F.xxhash64("text") % 2 == 0).alias("curve")), "quality-sample")
    good, bad = (_dictionary(known.where(f"y = {y} and not curve")) for y in (1, 0))
    weight, intercept = [], -math.inf
    if good and bad:
        at = known.where("curve").select(F.array(_differ(good, bad)("text")).alias("d"), F.col("y").cast("double").alias("y"))
        at = staged(at, "quality-curve").select(array_to_vector("d").alias("features"), "y").persist()
        try:
            weight, intercept = labelled.fit(at, odds, REGULARISATION)
        finally:
            at.unpersist()

    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in texts:
            if weight:
                z = intercept + weight[0] * np.array([difference(t, good, bad) for t in values(part)], dtype="float64")
                yield pa.array(1 / (1 + np.exp(-np.clip(z, -700, 700))))
            else:
                yield pa.array(np.zeros(len(part)))

    return F.arrow_udf(score, "double")


def quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score of every row of ``docs``: ``doc_id, held_out, score, predicted``.

    Rows with equal texts get equal scores, whatever their ids; other columns
    are not read. ``predicted`` is 1 from a score of 0.7.
    """
    score = scorer(docs, labels, label_col, id_col, text_col)
    out = docs.select(
        F.col(id_col).alias("doc_id"), labelled.held_out(id_col, FOLDS, FOLD).alias("held_out"), score(text_col).alias("score")
    )
    return out.withColumn("predicted", labelled.predicted("score"))
