"""Sum-of-squares packing of tokenised documents into fixed windows.

Every task packs the documents of its partition online. A document longer than
a window gives whole windows first; its tail is placed into the fill level that
minimises the sum of squared counts of partially filled windows, kept in a
level array (a new window is level zero). A window that is exactly full is
written out. Windows that cannot be filled that way, at the end of the partition
or when too many are open, are poured: their pieces are cut anew at the window
length, and the last rest is cut at powers of two, which need no padding. So a
sequence is a full window or has a power of two of tokens.

No shuffle: a task needs only its own documents, and memory is a batch, the open
windows and the token cache.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import values, worker_state
from quarry.session import ship_package

WINDOW = 4096
END_ID = 2
VOCABULARY = "word_bpe_49k.json"
MAX_OPEN = 1024
"""Open windows a task may hold; beyond it the most crowded level is poured, or all if none has two."""
CACHED_WORDS = 500_000
"""Words a Python worker remembers (some 100 MB); then it starts anew."""
CHUNK_CHARS = 1_000_000

_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long"
)

# The vocabulary's own split of lower-case text into words, for
# texts of ASCII and precomposed Latin-1 letters; others go to the tokenizer whole.
_PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*")
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
_ODD = re.compile(r"['0-9]")
_MARKS = re.compile(r"[^\sa-zß-öø-ÿ]+")


class WordTokenizer:
    """Ids of whole texts as little-endian uint32 bytes, with a cache by word.

    The vocabulary drops white space and encodes each word of its split by
    itself, so the ids of a text are those of its words in turn.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # Words that are split and lower-cased already need neither again: one
        # vocabulary, with either way of taking texts apart.
        light = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.ways = {False: (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer), True: (normalizers.Sequence([]), light)}
        self.way = False
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.last = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.last[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.cache: dict[str, bytes] = {}
        self.met = bytearray(1 << 22)

    def _ids(self, texts: list[str], words: bool = False) -> list[np.ndarray]:
        if self.way != words:
            self.way = words
            self.tokenizer.normalizer, self.tokenizer.pre_tokenizer = self.ways[words]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4") for e in found]

    def _learn(self, words: list[str]) -> None:
        parts = [words[at : at + 2000] for at in range(0, len(words), 2000)]
        for at in range(0, len(parts), 16):
            some = parts[at : at + 16]
            for part, ids in zip(some, self._ids([" ".join(part) for part in some], words=True), strict=True):
                ends = (4 * np.flatnonzero(self.last[ids]) + 4).tolist()
                if len(ends) != len(part):  # a word that the vocabulary splits
                    self.cache.update(zip(part, (i.tobytes() for i in self._ids(part)), strict=True))
                else:
                    raw = ids.tobytes()
                    self.cache.update((w, raw[i:j]) for w, i, j in zip(part, [0, *ends[:-1]], ends, strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [_split(t.lower()) if "<|" not in t and _PLAIN.fullmatch(t) else None for t in texts]
        seen = set().union(*(w for w in split if w))
        new = seen.difference(self.cache)
        if len(self.cache) + len(new) > CACHED_WORDS:
            self.cache.clear()
            self.met = bytearray(len(self.met))
            new = seen
        self._learn(sorted(new))
        get = self.cache.__getitem__
        out = [self._ids([t])[0].tobytes() if w is None else b"".join(map(get, w)) for t, w in zip(texts, split, strict=True)]
        for w in new:  # most new words never come again: only those met before stay
            slot = hash(w) % len(self.met)
            if not self.met[slot]:
                self.met[slot] = 1
                del self.cache[w]
        return out


def _split(lowered: str) -> list[str]:
    if _ODD.search(lowered):
        return _WORDS.findall(lowered)
    return _MARKS.sub(r" \g<0> ", lowered).split()  # the same without digits and quotes, and faster


def _tokenizer(path: str) -> WordTokenizer:
    import public_tokenizers

    return WordTokenizer(path if "/" in path else public_tokenizers.path(path))


class Packer:
    """Places pieces of one task; ``done`` gets the rows of closed sequences.

    A piece is (doc number, start, ids as bytes); a window is a list of pieces.
    ``levels[h]`` counts the open windows that hold ``h`` tokens.
    """

    def __init__(self, window: int, first_sequence: int, max_open: int = MAX_OPEN):
        self.window, self.max_open = window, max_open
        self.levels = np.zeros(window + 1, dtype=np.int64)
        self.open: dict[int, list[list]] = {}
        self.held = 0
        self.sequence = first_sequence
        self.done: list[tuple] = []

    def _close(self, pieces: list) -> None:
        offset = 0
        total = sum(len(p[2]) for p in pieces) // 4
        for doc, start, ids in pieces:
            n = len(ids) // 4
            self.done.append((doc, start, n, zlib.crc32(ids), self.sequence, offset, total))
            offset += n
        self.sequence += 1

    def add(self, doc: tuple, ids: bytes) -> None:
        full = 4 * self.window
        whole = len(ids) // full * full
        for at in range(0, whole, full):
            self._close([(doc, at // 4, ids[at : at + full])])
        if whole < len(ids):
            self._place((doc, whole // 4, ids[whole:]))

    def _place(self, piece: tuple) -> None:
        """Put the piece where the sum of squared level counts grows least."""
        size = len(piece[2]) // 4
        n = self.levels
        top = self.window - size
        # From level h to h + size: the counts change by one, the squares by
        # 2 (n[h + size] - n[h]) + 2. A new window adds 2 n[size] + 1, and a
        # full window leaves the array: its own count stays zero.
        change = np.where(n[: top + 1] > 0, 2 * (n[size:] - n[: top + 1]) + 2, np.iinfo(np.int64).max)
        if n[top]:
            change[top] = 1 - 2 * n[top]
        change[0] = 2 * n[size] + 1
        h = top - int(np.argmin(change[::-1]))  # of ties the fullest window
        pieces = [] if h == 0 else self._take(h)
        pieces.append(piece)
        if h + size == self.window:
            self._close(pieces)
            return
        self.levels[h + size] += 1
        self.open.setdefault(h + size, []).append(pieces)
        self.held += 1
        if self.held > self.max_open:
            crowded = int(np.argmax(self.levels))
            few = self.levels[crowded] < 2  # no level has windows to join: all are poured
            levels = np.flatnonzero(self.levels).tolist() if few else [crowded]
            self._pour([self._take(n) for n in levels for _ in range(len(self.open[n]))], last=False)

    def _take(self, level: int) -> list:
        self.levels[level] -= 1
        self.held -= 1
        return self.open[level].pop()

    def _pour(self, windows: list[list], last: bool) -> None:
        """Cut the pieces anew into full windows, the rest at powers of two."""
        total = sum(len(p[2]) for pieces in windows for p in pieces) // 4
        sizes = [self.window] * (total // self.window)
        if last:
            sizes += [1 << b for b in range(self.window.bit_length(), -1, -1) if total % self.window >> b & 1]
        now, room = [], 0
        sizes = iter(sizes)
        for pieces in windows:
            for doc, start, ids in pieces:
                while ids:
                    if not room:
                        if now:
                            self._close(now)
                        now, room = [], next(sizes, self.window)
                    n = min(room, len(ids) // 4)
                    now.append((doc, start, ids[: 4 * n]))
                    start, ids, room = start + n, ids[4 * n :], room - n
        if now and room:  # the rest of a level stays open
            level = sum(len(p[2]) for p in now) // 4
            self.levels[level] += 1
            self.held += 1
            self.open.setdefault(level, []).append(now)
        elif now:
            self._close(now)

    def finish(self) -> None:
        windows = [w for level in sorted(self.open, reverse=True) for w in self.open[level]]
        self.levels[:], self.open, self.held = 0, {}, 0
        self._pour(windows, last=True)


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of some rows of the batch, by the length of the texts."""
    ids, texts, held = [], [], 0
    for doc_id, text in zip(values(batch.column("doc_id")), values(batch.column("text")), strict=True):
        ids.append(doc_id)
        texts.append(text or "")
        held += len(texts[-1])
        if held >= CHUNK_CHARS:
            yield ids, texts
            ids, texts, held = [], [], 0
    yield ids, texts


def _pack(path: str, window: int, end_id: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tokenizer = worker_state("packing", path, partial(_tokenizer, path))
    end = np.array([end_id], dtype="<u4").tobytes()
    packer = Packer(window, TaskContext.get().partitionId() << 40)
    for batch in batches:
        for doc_ids, texts in _chunks(batch):
            for doc_id, ids in zip(doc_ids, tokenizer.encode(texts), strict=True):
                packer.add((doc_id, len(ids) // 4 + 1), ids + end)
        yield _rows(packer)
    packer.finish()
    yield _rows(packer)


def _rows(packer: Packer) -> pa.RecordBatch:
    rows, packer.done = packer.done, []
    cols = [[r[0][0] for r in rows], *([r[i] for r in rows] for i in (1, 2, 3)), [r[0][1] for r in rows]]
    cols += [[r[i] for r in rows] for i in (4, 5, 6)]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], [c.split()[0] for c in _PIECES.split(", ")])


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    tokenizer: str = VOCABULARY,
    end_id: int = END_ID,
) -> DataFrame:
    """Pieces of all documents with their place in a sequence of ``window`` tokens at most.

    A document's tokens are the ids of its text (null: empty) and ``end_id``.
    One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, sequence_tokens``. Every token of every row lies in
    one piece; repeated rows and null ids are packed like any others. A
    sequence is full or has a power of two of tokens. ``window`` is a power of
    two. Which documents share a sequence follows the partitions of ``docs``.
    ``tokenizer`` is a file of public_tokenizers or a path. Other columns of
    ``docs`` are not read.
    """
    if window < 1 or window & (window - 1):
        raise ValueError("window must be a power of two")
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(partial(_pack, tokenizer, window, end_id), _PIECES)
