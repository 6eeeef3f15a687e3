"""Substring dedup: windows of words that also start elsewhere, by level-wise doubling.

The lengths double up to the window: 9, 18 and 35 words for a window of 35.
Every window has an anchor, its half window of least hash (leftmost of ties),
every half window has one of half its length, and so on: equal windows have
equal anchors at all lengths, so only anchors are counted. They are hashed in
one pass. Level by level, those whose words occur once at the level's length
are dropped, and only the others are judged at twice that length, until none is
left or the window is reached. All windows of an anchor lie within its reach,
up to a window's length to both sides, so a reach that repeats as a whole
settles them at once; only at the edges of a repeat the windows are counted one
by one. Nothing is extended beyond the window, for the windows are what is judged.

Equal words are told by one 64-bit hash a word; equal stretches by one 64-bit
sum over these at the lower levels, and by two for whole windows. Texts are
shuffled as zstandard frames.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import row_key, staged, values
from quarry.session import ship_package

WINDOW = 35
SHORTEST = 9
"""Words of the first level at the least, where a window has as many."""
_BLOCK = 1 << 20  # bytes of words hashed at once
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd: invertible modulo 2^64


class _Powers:
    """Powers of an odd factor and of its inverse, as many as asked for so far."""

    def __init__(self, factor: int):
        self.factors = (factor, pow(factor, -1, 1 << 64))
        self.tables = [np.ones(1, dtype=np.uint64)] * 2

    def __call__(self, n: int, inverse: bool = False) -> np.ndarray:
        table = self.tables[inverse]
        if len(table) < n:
            table = np.full(1 << n.bit_length(), self.factors[inverse], dtype=np.uint64)
            table[0] = 1
            self.tables[inverse] = table = np.cumprod(table)
        return table[:n]


_POWERS = [_Powers(f) for f in _FACTORS]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Sums:
    """Hashes of any stretch of a sequence of numbers, from its polynomial prefix sums."""

    def __init__(self, values: np.ndarray, which: int):
        n, self.powers = len(values), _POWERS[which]
        self.prefix = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * self.powers(n), out=self.prefix[1:])
        self.back = self.powers(n + 1, inverse=True)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        stretch = (self.prefix[end] - self.prefix[start]) * self.back[start]
        return _mix(stretch + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Words:
    """Places of the words of a text in UTF-8, split at ASCII white space."""

    def __init__(self, raw: bytes):
        self.bytes = np.frombuffer(raw, dtype=np.uint8)
        solid = np.zeros(len(raw) + 2, dtype=np.int8)
        solid[1:-1] = (self.bytes > 32) | ((self.bytes < 32) & ((self.bytes < 9) | (self.bytes > 13)))
        step = np.diff(solid)
        self.start, self.end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        self.n = len(self.start)

    def hashes(self) -> np.ndarray:
        out, at = np.empty(self.n, dtype=np.uint64), 0
        while at < self.n:
            to = max(at + 1, int(np.searchsorted(self.end, self.start[at] + _BLOCK, side="right")))
            low = int(self.start[at])
            sums = Sums(self.bytes[low : int(self.end[to - 1])].astype(np.uint64) + np.uint64(1), 0)
            out[at:to] = sums(self.start[at:to] - low, self.end[at:to] - low)
            at = to
        return out


def ladder(window: int, shortest: int = SHORTEST) -> list[int]:
    """Lengths of the levels below ``window``, longest first: each is half the one above, rounded up."""
    sizes = [(window + 1) // 2]
    while sizes[-1] > 1 and (sizes[-1] + 1) // 2 >= shortest:
        sizes.append((sizes[-1] + 1) // 2)
    return sizes


def _anchors(half: np.ndarray, span: int) -> np.ndarray:
    """Place of the least of every ``span`` neighbours, the leftmost of ties, by doubling."""
    best, width = np.arange(len(half)), 1
    while width < span:
        step = min(width, span - width)
        a, b = best[: len(best) - step], best[step:]
        best = np.where(half[a] <= half[b], a, b)
        width += step
    return best


class Windows:
    """The windows of a text of ``words`` and their anchors."""

    def __init__(self, words: Words, window: int):
        self.n, self.window = words.n, window
        self.size = (window + 1) // 2
        self.span = window - self.size + 1
        hashes = words.hashes()
        self.sums = [Sums(hashes, 0), Sums(hashes, 1)]
        at = np.arange(self.n - self.size + 1)
        self.half = self.sums[0](at, at + self.size)
        self.of = _anchors(self.half, self.span)  # of each window

    def lower(self, p: np.ndarray, shortest: int) -> Iterator[np.ndarray]:
        """For each shorter length: hash of the anchor below each of the anchors ``p``, and whether
        it is the first of ``p`` with that anchor. Anchors ascend with ``p``."""
        above = self.size
        for size in ladder(self.window, shortest)[1:]:
            at = np.arange(self.n - size + 1)
            hashes = self.sums[0](at, at + size)
            p = _anchors(hashes, above - size + 1)[p]
            yield hashes[p]
            yield np.diff(p, prepend=-1) != 0
            above = size

    def reach(self, p: np.ndarray) -> np.ndarray:
        """Hash of all words that windows anchored at ``p`` can have, and of the place in them."""
        low = np.maximum(p - (self.window - self.size), 0)
        high = np.minimum(p + self.window, self.n)
        return _mix(self.sums[1](low, high) + (p - low).astype(np.uint64))


def _first_level(window: int, shortest: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every anchor of half a window, with its hashes at all lengths."""
    names = [c.split()[0] for c in _anchor_columns(window, shortest).split(", ")]
    for batch in batches:
        k1, k2 = (batch.column(c).to_numpy() for c in ("k1", "k2"))
        rows: list[list[np.ndarray]] = []
        for i, text in enumerate(values(batch.column("text"))):
            words = Words((text or "").encode())
            if words.n < window:
                continue
            w = Windows(words, window)
            p = np.unique(w.of)
            rows.append([np.full(len(p), k1[i]), np.full(len(p), k2[i]), p.astype(np.int32), w.half[p], w.reach(p), *w.lower(p, shortest)])
        if rows:
            cols = (np.concatenate(c) for c in zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for c in cols], names)


def _anchor_columns(window: int, shortest: int) -> str:
    lower = "".join(f", h{n} long, new{n} boolean" for n in ladder(window, shortest)[1:])
    return "k1 long, k2 int, p int, half long, reach long" + lower


def _second_level(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of the anchors ``p``, with whether the anchor's reach is unique."""
    unzip = zstandard.ZstdDecompressor()
    for batch in batches:
        k1, k2 = (batch.column(c).to_numpy() for c in ("k1", "k2"))
        out: list[list[np.ndarray]] = [[] for _ in range(6)]
        for i, (z, p, lone) in enumerate(zip(batch.column("z"), batch.column("p"), batch.column("lone"), strict=True)):
            w = Windows(Words(unzip.decompress(z.as_py())), window)
            places = p.values.to_numpy(zero_copy_only=False)
            order = np.argsort(places)
            places, alone = places[order], lone.values.to_numpy(zero_copy_only=False)[order]
            s = np.flatnonzero(np.isin(w.of, places))
            mine = alone[np.searchsorted(places, w.of[s])]
            r = [x(s, s + window).view(np.int64) for x in w.sums]
            for col, values in zip(out, (np.full(len(s), k1[i]), np.full(len(s), k2[i]), s.astype(np.int32), *r, mine), strict=True):
                col.append(values)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["k1", "k2", "s", "r1", "r2", "lone"])


def _cut(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text without the words of its repeated windows."""
    unzip = zstandard.ZstdDecompressor()
    for batch in batches:
        n_words, n_removed, kept = [], [], []
        for z, whole, starts in zip(batch.column("z"), batch.column("whole"), batch.column("starts"), strict=True):
            raw = unzip.decompress(z.as_py())
            words = raw.split()
            n_words.append(len(words))
            if whole.is_valid or starts.is_valid:
                w = Windows(Words(raw), window)
                hit = np.zeros(len(w.of), dtype=bool)
                if whole.is_valid:
                    hit |= np.isin(w.of, whole.values.to_numpy(zero_copy_only=False))
                if starts.is_valid:
                    hit[starts.values.to_numpy(zero_copy_only=False)] = True
                step = np.zeros(w.n + 1, dtype=np.int64)
                s = np.flatnonzero(hit)
                step[s] += 1
                step[s + window] -= 1
                covered = np.cumsum(step[:-1]) > 0
                words = [words[j] for j in np.flatnonzero(~covered).tolist()]
            n_removed.append(n_words[-1] - len(words))
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
            ["doc_id", "n_words", "n_removed", "kept"],
        )


def _zip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        z = pa.array([squeeze.compress((t.as_py() or "").encode()) for t in batch.column("text")], pa.binary())
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "k1", "k2")), z], ["doc_id", "k1", "k2", "z"])


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, shortest: int = SHORTEST) -> DataFrame:
    """Texts without the words of every window that also starts elsewhere.

    One row per row of ``docs``: ``doc_id, n_words, n_removed, kept`` (the words
    left, joined by one space). A window is ``window`` consecutive words of one
    row; elsewhere is any other place of any row, the same row included, and
    repeated rows are each other's elsewhere. All windows are judged on the
    input. ``shortest`` is the least length of the first level; the result does
    not depend on it. Null, empty and short texts have no window. Ids may be null or
    repeat; other columns are not read.
    """
    if window < 2:
        raise ValueError("a window has two words at least")
    ship_package(docs.sparkSession)
    keyed = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
        *(c.alias(n) for c, n in zip(row_key(id_col, text_col), ("k1", "k2"), strict=True)),
    )
    zipped = keyed.mapInArrow(_zip, "doc_id long, k1 long, k2 int, z binary")
    # Aggregates are written before they are joined: AQE splits a hot anchor only
    # where both sides of the join come from exchanges of their own.
    anchors = keyed.select("k1", "k2", "text").mapInArrow(partial(_first_level, window, shortest), _anchor_columns(window, shortest))
    level = staged(anchors, "substring-anchors")
    for n in reversed(ladder(window, shortest)):
        half = n == (window + 1) // 2
        name, places = ("half", F.lit(1)) if half else (f"h{n}", F.col(f"new{n}").cast("int"))
        twice = staged(level.groupBy(name).agg(F.sum(places).alias("n")).where("n > 1").select(name), f"substring-twice-{n}")
        level = level.join(twice, name, "left_semi")
        level = staged(level if half else level.drop(name, f"new{n}"), f"substring-level-{n}")
    by_reach = level.groupBy("half", "reach").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("k1", "k2", "p")).alias("at"))
    by_reach = staged(by_reach, "substring-reach")
    # An anchor of several reaches, one of them unique, is at an edge: one row of each reach goes on.
    edges = staged(by_reach.where("n = 1").select("half").distinct(), "substring-edges")
    on = by_reach.join(edges, "half", "left_semi").select("at.*", (F.col("n") == 1).alias("lone"))
    on = on.groupBy("k1", "k2").agg(F.collect_list(F.struct("p", "lone")).alias("a"))
    on = on.select("k1", "k2", F.col("a.p").alias("p"), F.col("a.lone").alias("lone"))
    one = zipped.drop("doc_id").join(on, ["k1", "k2"])
    windows = one.select("k1", "k2", "z", "p", "lone").mapInArrow(
        partial(_second_level, window), "k1 long, k2 int, s int, r1 long, r2 long, lone boolean"
    )
    windows = staged(windows, "substring-windows")
    again = windows.groupBy("r1", "r2").agg(F.sum(F.when(F.col("lone"), 1).otherwise(2)).alias("n")).where("n > 1")
    again = staged(again.select("r1", "r2"), "substring-again")
    starts = windows.where("lone").join(again, ["r1", "r2"], "left_semi")
    starts = starts.groupBy("k1", "k2").agg(F.collect_list("s").alias("starts"))
    whole = level.join(by_reach.where("n > 1").select("half", "reach"), ["half", "reach"], "left_semi")
    # A set: repeated rows share their key, and each of them gets the array.
    whole = whole.groupBy("k1", "k2").agg(F.collect_set("p").alias("whole"))
    found = whole.join(starts, ["k1", "k2"], "full_outer")
    out = zipped.join(found, ["k1", "k2"], "left").select("doc_id", "z", "whole", "starts")
    return out.mapInArrow(partial(_cut, window), "doc_id long, n_words long, n_removed long, kept string")
