"""SimHash near-dedup with Golay-code fuzzy hashing.

Distinct fingerprints are cut into three segments of 22, 21 and 21 bits, each a
word of the Golay code with leading zeros. Up to four differing bits fall on the
segments so that

* some segment has none; then one of the others has two at most: key
  (that segment whole, a codeword index near the other), for six ordered pairs;
* or every segment has one at least; then two segments have exactly one: key
  (index of the one, index of the other) for three pairs, where the member with
  even parity gives its home index and the other all its near indices.

About 60 keys per distinct fingerprint; rows with a common key are compared by
Hamming distance, and the verified links are contracted to components.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import golay
from quarry.llm.common import free_name, row_key, runs_of, staged, values, worker_state
from quarry.llm.components import components
from quarry.session import ship_package

WIDTHS = (22, 21, 21)
MAX_BITS = 4
CHUNK = 1 << 16
"""Shingles whose bits are counted at once."""
PAIRWISE = 32
"""Keys of up to so many fingerprints are compared pair by pair."""

FOREST_AT = 1 << 20
"""New links a task holds before it reduces them to a forest."""


def simhash(text: str | None, shingle: int) -> int:
    """64-bit SimHash over word shingles; 0 for a text without words."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space alone
    if not words:
        return 0
    line = b" ".join(words)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    end = np.cumsum(size + 1) - 1
    start = end - size
    if len(words) >= shingle:
        start, end = start[: len(words) - shingle + 1], end[shingle - 1 :]
    else:
        start, end = start[:1], end[-1:]
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(start), CHUNK):
        cuts = zip(start[at : at + CHUNK].tolist(), end[at : at + CHUNK].tolist(), strict=True)
        h = np.array([digest(line[a:b], 42) for a, b in cuts], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(start)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    worker_state("simhash")
    for batch in batches:
        fp = np.array([simhash(t, shingle) for t in values(batch.column("text"))], dtype=np.uint64)
        rest = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(fp.view(np.int64))], [*rest, "fp"])


def _segments(fp: np.ndarray) -> list[np.ndarray]:
    fp, out, at = fp.view(np.uint64), [], 0
    for width in WIDTHS:
        out.append(((fp >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64))
        at += width
    return out


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, fp): the kind of key above two 22-bit parts."""
    for batch in batches:
        fps = batch.column("fp").to_numpy()
        for at in range(0, len(fps), 4096):
            fp = fps[at : at + 4096]
            seg = _segments(fp)
            sets = [golay.near(s, w) for s, w in zip(seg, WIDTHS, strict=True)]
            keys, whose, kind = [], [], 0
            row = np.arange(len(fp))
            for b, (index, size) in enumerate(sets):
                for a in range(3):
                    if a != b:
                        r = np.repeat(row, size)
                        keys.append((kind << 44) | (seg[a][r] << 22) | index)
                        whose.append(r)
                        kind += 1
            lone = []  # by parity: the home index alone, or all
            for s, (index, size) in zip(seg, sets, strict=True):
                odd = np.bitwise_count(s) & 1 == 1
                pick = np.where(odd, size, 1)
                start = np.concatenate([[0], np.cumsum(pick)])[:-1]
                flat = np.empty(int(pick.sum()), dtype=np.int64)
                flat[np.repeat(odd, pick)] = index[np.repeat(odd, size)]
                flat[start[~odd]] = golay.home(s[~odd])
                lone.append((flat, pick, start))
            for a, b in ((0, 1), (0, 2), (1, 2)):
                (fa, na, sa), (fb, nb, sb) = lone[a], lone[b]
                r = np.repeat(row, na * nb)
                i = np.arange(len(r)) - np.repeat(np.concatenate([[0], np.cumsum(na * nb)])[:-1], na * nb)
                keys.append((kind << 44) | (fa[sa[r] + i // nb[r]] << 22) | fb[sb[r] + i % nb[r]])
                whose.append(r)
                kind += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys)), pa.array(fp[np.concatenate(whose)])], ["key", "fp"]
            )


def _tree(fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the members as all links of ``max_bits`` would, one less
    than members at most: a breadth-first search over those not reached yet."""
    left, a, b = fp, [], []
    while len(left):
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            x = todo.pop()
            hit = np.bitwise_count((left ^ x).view(np.uint64)) <= max_bits
            if hit.any():
                b.append(left[hit])
                a.append(np.full(len(b[-1]), x))
                todo.extend(b[-1])
                left = left[~hit]
    none = np.empty(0, dtype=np.int64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def _forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components as the links (u, v), as one link from each node to its least."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        for x in (a, b, root[a], root[b]):
            np.minimum.at(new, x, least)
        new = new[new]
        if (new == root).all():
            break
        root = new
    some = root != np.arange(len(nodes))
    return nodes[some], nodes[root[some]]


def _links(max_bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (u, v) with the components of all verified links of this partition."""
    none = np.empty(0, dtype=np.int64)
    u, v, held = [none], [none], 0
    for t in runs_of(batches, "key"):
        key, fp = t.column("key").to_numpy(), t.column("fp").to_numpy()
        cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
        size = np.diff(cut)
        each = np.repeat(size, size)
        for n in np.flatnonzero(size > PAIRWISE):
            x, y = _tree(fp[cut[n] : cut[n + 1]], max_bits)
            u.append(x)
            v.append(y)
        some = (each > 1) & (each <= PAIRWISE)
        key, fp = key[some], fp[some]
        for lag in range(1, PAIRWISE):
            same = key[lag:] == key[:-lag]
            if not same.any():
                break
            hit = same & (np.bitwise_count((fp[lag:] ^ fp[:-lag]).view(np.uint64)) <= max_bits)
            u.append(fp[:-lag][hit])
            v.append(fp[lag:][hit])
        if sum(map(len, u)) > held + FOREST_AT:
            x, y = _forest(np.concatenate(u), np.concatenate(v))
            u, v, held = [x], [y], len(x)
    x, y = _forest(np.concatenate(u), np.concatenate(v))
    yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["u", "v"])


def fingerprint_components(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``fp, component`` for the distinct fingerprints ``fp`` that have a link."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"three Golay segments give every link of up to {MAX_BITS} bits, not of {max_bits}")
    keys = fps.select("fp").mapInArrow(_keys, "key long, fp long")
    links = keys.repartition("key").sortWithinPartitions("key").mapInArrow(partial(_links, max_bits), "u long, v long")
    return components(links).withColumnRenamed("node", "fp")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = MAX_BITS
) -> DataFrame:
    """Component of every row under links of ``max_bits`` or fewer differing bits.

    One row per row of ``docs``: ``doc_id, fingerprint`` (16 hex digits)
    ``, component_id`` (the smallest id reachable, its own included). Null and
    empty texts have fingerprint zero, linked like any other. Null ids are
    larger than all others. Equal texts and repeated rows share a fingerprint
    and so a component. Other columns of ``docs`` are not read.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = staged(rows.mapInArrow(partial(_fingerprints, shingle), "doc_id long, fp long"), "simhash")
    return _components_of(rows, max_bits).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _components_of(rows: DataFrame, max_bits: int) -> DataFrame:
    fps = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    linked = fps.join(fingerprint_components(fps, max_bits), "fp", "left")
    # Written, so that both sides of the joins come from exchanges of their own
    # and AQE can split a hot component or fingerprint.
    linked = staged(linked.select("fp", "least", F.coalesce("component", "fp").alias("component")), "simhash-linked")
    ids = staged(linked.groupBy("component").agg(F.min("least").alias("component_id")), "simhash-ids")
    return rows.join(linked.join(ids, "component"), "fp", "left")


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = MAX_BITS
) -> DataFrame:
    """The rows of ``docs`` that stay, one per component, with their columns.

    The row with the smallest id stays; of rows that share this id, the one
    whose text has the smallest hash, and of rows alike in both, any one.
    """
    ship_package(docs.sparkSession)
    k1, k2, row, fp = (free_name(docs, c) for c in ("_k1", "_k2", "_row", "fp"))
    keyed = docs.select("*", *(k.alias(n) for k, n in zip(row_key(id_col, text_col), (k1, k2), strict=True)))
    rows = keyed.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(k1).alias("k1"), F.col(k2).alias("k2"), F.col(text_col).alias("text")
    ).mapInArrow(partial(_fingerprints, shingle), "doc_id long, k1 long, k2 int, fp long")
    found = _components_of(staged(rows, "simhash-rows"), max_bits)
    first = found.where("doc_id <=> component_id").groupBy("component").agg(
        F.min(F.struct("k1", "k2")).alias("k"), F.count(F.lit(1)).alias("n")
    )
    first = staged(first.select(F.col("k.k1").alias(k1), F.col("k.k2").alias(k2), "n"), "simhash-first")
    out = keyed.join(first.select(k1, k2), [k1, k2], "left_semi")
    if first.where("n > 1").limit(1).count():
        out = out.dropDuplicates([k1, k2])  # repeated rows
    return out.drop(k1, k2)
