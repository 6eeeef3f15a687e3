"""Alignment of the tokens of two tokenizers by an associative fragment monoid.

A document's tokens under A and under B are cut into groups at the byte offsets
where a token of either ends. A range of its bytes yields a fragment: an open
prefix (tokens up to the range's first common end), closed groups, and an open
suffix. Fragments compose: the suffix of one and the prefix of the next close a
group, and a range without any common end is all prefix. Composition is
associative, so the ranges of a very long document are tokenised by different
tasks and composed level by level, ``FAN`` neighbours at a time.

A token belongs to the range that holds its end. A task sees its range with the
text out to the nearest space between two other characters on either side: no
piece of B spans such a place and A's words begin there, so tokens are those of
the whole text. What lies between two such spaces is a word; its groups are
closed in themselves and are remembered.

The ids of a link end together, so the bytes of one are a suffix of the
other's: the vocabularies bound the number of linked id pairs (some 10^5),
whatever the corpus. Only that table of counts is broadcast.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import partial
from itertools import count, pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import staged
from quarry.session import ship_package

BYTE_VOCABULARY = "byte_bpe_50k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"
CHUNK = 1 << 16
"""Characters of a range; longer texts are cut into ranges."""
FAN = 8
"""Neighbouring fragments composed at once."""
CACHED_WORDS = 250_000
"""Words whose groups a task remembers (some 100 MB); then it starts anew."""
_AT_ONCE = 1 << 18  # characters of the texts whose new words are tokenised together
_TOGETHER = 200  # words tokenised in one string
_LONGEST = 64  # characters of a remembered word
_OUT_BYTES = 4 << 20

# White space in the sense of either tokenizer, and controls for good measure.
_OTHER = r"[^\s\x00-\x20\x7f-\xa0]"
_BORDER = re.compile(f"(?<={_OTHER}) (?={_OTHER})")
_WORD = re.compile(rf"{_OTHER}(.*{_OTHER})?", re.S)
_BLANKS = re.compile(r"\s{1000}")

_SINGLE = "row long, doc_id long, n_a long, n_b long, n_groups long, groups string, pairs array<int>"
_CUT = "row long, doc_id long, part int, text string, lo long, hi long"
_FRAGMENT = (
    "row long, doc_id long, part int, ok boolean, n_a long, n_b long, cut boolean, "
    "head_a string, head_b string, body string, tail_a string, tail_b string, pairs array<int>"
)


def _file(name: str) -> str:
    import public_tokenizers

    return name if "/" in name else public_tokenizers.path(name)


class ByteTokens:
    """Byte-level BPE of ``space + text``, special tokens taken as plain text."""

    def __init__(self, name: str):
        import tiktoken
        from tokenizers.pre_tokenizers import ByteLevel

        with open(_file(name), encoding="utf-8") as file:
            held = json.load(file)
        model, special = held["model"], {t["content"] for t in held["added_tokens"]}
        # Bytes stand for themselves as printable Latin-1 characters, the others in turn from U+0100.
        plain = [c for c in range(256) if chr(c) in ByteLevel.alphabet()]
        rest = [c for c in range(256) if c not in plain]
        byte_of = {chr(c): c for c in plain} | {chr(256 + i): c for i, c in enumerate(rest)}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
        for i, (x, y) in enumerate(model["merges"][:256]):  # ids must follow the order of merges
            if model["vocab"][x + y] != 256 + i:
                raise ValueError(f"{name}: ids do not follow the merges")
        import public_tokenizers

        self.encoding = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.path = _file(name)
        self.size = max(model["vocab"].values()) + 1
        self.bytes_of = [b""] * self.size
        for token, i in ranks.items():
            self.bytes_of[i] = token
        self.length = np.array(list(map(len, self.bytes_of)))

    def encode(self, text: str) -> list[int]:
        if not _BLANKS.search(text):
            return self.encoding.encode_ordinary(" " + text)
        from tokenizers import Tokenizer  # the other's matcher can't hold long runs of white space

        whole = Tokenizer.from_file(self.path)
        whole.encode_special_tokens = True
        return whole.encode(" " + text, add_special_tokens=False).ids


class PieceTokens:
    """Sentence pieces of a text; the model puts a space before it."""

    def __init__(self, name: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=_file(name))
        self.size = self.model.vocab_size()
        pieces = [self.model.id_to_piece(i) for i in range(self.size)]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError(f"{name}: pieces span words")
        self.bytes_of = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.length = np.array(list(map(len, self.bytes_of)))

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


def words_of(text: str) -> list[str]:
    """What lies between the borders of a text."""
    plain = text.replace("\n", "_").isprintable() and not any(x in text for x in ("  ", " \n", "\n "))
    if plain and text[:1] != " " and text[-1:] != " ":
        return text.split(" ")
    return _BORDER.split(text)


Fragment = tuple[bool, str, str, str, str, str]
"""(holds a common end, prefix A, prefix B, closed groups, suffix A, suffix B); ids end in "," and groups in ";"."""


def close(a: str, b: str) -> str:
    return f"{a[:-1]}|{b[:-1]};"


def compose(x: Fragment, y: Fragment) -> Fragment:
    """The fragment of two neighbouring ranges; (False, "", "", "", "", "") is neutral."""
    if not x[0]:
        return (y[0], x[1] + y[1], x[2] + y[2], *y[3:])
    if not y[0]:
        return (*x[:4], x[4] + y[1], x[5] + y[2])
    return (True, x[1], x[2], x[3] + close(x[4] + y[1], x[5] + y[2]) + y[3], y[4], y[5])


class Aligner:
    def __init__(self, a: str, b: str):
        self.a, self.b = ByteTokens(a), PieceTokens(b)
        # Of each remembered word; those without tokens are in ``lost`` instead.
        self.groups: dict[str, str] = {}
        self.pairs: dict[str, bytes] = {}
        self.counts: dict[str, int] = {}  # tokens of A, and in the upper half of B
        self.lost: set[str] = set()
        size = max(self.a.size, self.b.size)
        self.ids = np.array([f"{i}{end}" for end in ",;" for i in range(size)], dtype=object)
        self.bars = np.array([f"{i}|" for i in range(size)], dtype=object)

    def tokens(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids of A and B and their ends in the texts, each after a space; None
        if either vocabulary does not give the bytes back."""
        raw, out = b"".join([b" " + t.encode() for t in texts]), []
        for side in (self.a, self.b):
            ids = [i for t in texts for i in side.encode(t)]
            if b"".join(map(side.bytes_of.__getitem__, ids)) != raw:
                return None
            out.append(np.array(ids, dtype=np.int64))
        return *out, np.cumsum(self.a.length[out[0]]), np.cumsum(self.b.length[out[1]])

    def owned(self, text: str, lo: int, hi: int) -> tuple[Fragment, np.ndarray, int, int] | None:
        """Fragment, links and token counts of the tokens of ``space + text`` that end in (lo, hi]."""
        found = self.tokens([text])
        if found is None:
            return None
        a, b, end_a, end_b = found
        i, j = np.searchsorted(end_a, [lo, hi], side="right")
        p, q = np.searchsorted(end_b, [lo, hi], side="right")
        ids_a, ids_b, end_a, end_b = a[i:j], b[p:q], end_a[i:j], end_b[p:q]
        a, b = ids_a.tolist(), ids_b.tolist()
        at_a, at_b = (np.flatnonzero(np.isin(x, y, assume_unique=True)) for x, y in ((end_a, end_b), (end_b, end_a)))
        groups, x, y = [], 0, 0
        for m, n in zip((at_a + 1).tolist(), (at_b + 1).tolist(), strict=True):
            groups.append((a[x:m], b[y:n]))
            x, y = m, n
        listed = lambda ids: "".join(f"{i}," for i in ids)
        if not groups:
            fragment = (False, listed(a), listed(b), "", "", "")
        else:
            body = "".join(close(listed(g), listed(h)) for g, h in groups[1:])
            fragment = (True, listed(groups[0][0]), listed(groups[0][1]), body, listed(a[x:]), listed(b[y:]))
        pairs = ids_a[at_a] * self.b.size + ids_b[at_b]
        return fragment, pairs.astype("<i4"), len(a), len(b)

    def _alone(self, word: str) -> tuple | None:
        """Closed groups, links and token counts of one word."""
        found = self.owned(word, 0, 1 << 62)
        if found is None:
            return None
        (_, head_a, head_b, body, _, _), pairs, n_a, n_b = found
        return close(head_a, head_b) + body, pairs.tobytes(), n_a, n_b

    def _learn(self, words: list[str], odd: set[str]) -> None:
        """``_alone`` of words, all but the odd ones at once."""
        words = [w for w in words if w not in odd]
        parts = [" ".join(words[at : at + _TOGETHER]) for at in range(0, len(words), _TOGETHER)]
        found = self.tokens(parts)
        if found is None:  # some word has no tokens
            odd, words = odd.union(words), []
        for w in odd:
            if (alone := self._alone(w)) is None:
                self.lost.add(w)
            else:
                self.groups[w], self.pairs[w], self.counts[w] = alone[0], alone[1], alone[3] << 32 | alone[2]
        if not words:
            return
        a, b, end_a, end_b = found
        ends = np.cumsum(np.fromiter((len(w.encode()) + 1 for w in words), dtype=np.int64, count=len(words)))
        common = np.zeros(int(ends[-1]) + 1, dtype=np.int8)
        common[end_a] = 1
        common[end_b] += 1
        cut_a, cut_b = common[end_a] == 2, common[end_b] == 2
        last_a, last_b = np.flatnonzero(cut_a) + 1, np.flatnonzero(cut_b) + 1
        # A group's tokens of A, then those of B: where each stands among all.
        shown = np.empty(len(a) + len(b), dtype=object)
        group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        shown[np.arange(len(a)) + np.concatenate([[0], last_b])[group_a]] = self.ids[a + cut_a * len(self.ids) // 2]
        shown[np.arange(len(b)) + last_a[group_b]] = self.ids[b + cut_b * len(self.ids) // 2]
        shown[last_a - 1 + np.concatenate([[0], last_b[:-1]])] = self.bars[a[last_a - 1]]
        shown = shown.tolist()
        pairs = (a[last_a - 1] * self.b.size + b[last_b - 1]).astype("<i4").tobytes()
        to_a, to_b = np.searchsorted(end_a, ends, side="right"), np.searchsorted(end_b, ends, side="right")
        to_pair = 4 * np.searchsorted(last_a, to_a, side="right")
        cuts = [0, *(to_a + to_b).tolist()]
        self.groups.update(zip(words, ["".join(shown[i:j]) for i, j in pairwise(cuts)], strict=True))
        cuts = [0, *to_pair.tolist()]
        self.pairs.update(zip(words, [pairs[i:j] for i, j in pairwise(cuts)], strict=True))
        counts = np.diff(to_b, prepend=0) << 32 | np.diff(to_a, prepend=0)
        self.counts.update(zip(words, counts.tolist(), strict=True))

    def closed(self, texts: list[list[str]]) -> Iterator[tuple[str, bytes, int, int] | None]:
        """Groups, links and token counts of each list of words that follow one another."""
        new = set().union(*texts).difference(self.groups, self.lost)
        if len(self.groups) + len(self.lost) + len(new) > CACHED_WORDS:
            self._forget([*self.groups, *self.lost])
            new = set().union(*texts)
        # Only a text's first and last word may lack a border on a side.
        self._learn(list(new), {w for words in texts for w in (words[0], words[-1]) if w in new and not _WORD.fullmatch(w)})
        groups, pairs, counts = (of.__getitem__ for of in (self.groups, self.pairs, self.counts))
        for words in texts:
            if not self.lost.isdisjoint(words):
                yield None
            else:
                n = sum(map(counts, words))
                yield "".join(map(groups, words)), b"".join(map(pairs, words)), n & 0xFFFFFFFF, n >> 32
        self._forget([w for w in new if len(w) > _LONGEST])

    def _forget(self, words: list[str]) -> None:
        for word in words:
            self.lost.discard(word)
            for of in (self.groups, self.pairs, self.counts):
                of.pop(word, None)

    def texts(self, texts: list[str]) -> Iterator[tuple[str, bytes, int, int]]:
        """Groups, links and token counts of whole texts; nothing where one has no tokens."""
        some = self.closed([words_of(t) for t in texts if t])
        for t in texts:
            yield (next(some) if t else None) or ("", b"", 0, 0)

    def range(self, text: str, lo: int, hi: int) -> tuple[Fragment, bytes, int, int] | None:
        """Fragment of the tokens that end in (lo, hi] of ``space + text``, which begins and ends at word borders."""
        out, pairs, counts = (False, "", "", "", "", ""), [], [0, 0]
        at, inner = 0, []

        def add(found):
            nonlocal out
            if found is None:
                return False
            out = compose(out, found[0])
            pairs.append(bytes(found[1]))
            counts[0] += found[2]
            counts[1] += found[3]
            return True

        def flush():
            if not inner:
                return True
            found = next(iter(list(self.closed([inner]))))
            inner.clear()
            if found is None:
                return False
            first, _, rest = found[0].partition(";")
            a, _, b = first.partition("|")
            return add(((True, a + ",", b + ",", rest, "", ""), *found[1:]))

        for word in words_of(text):
            size = len(word.encode()) + 1
            if lo <= at and at + size <= hi:
                inner.append(word)
            elif not flush() or not add(self.owned(word, lo - at, hi - at)):
                return None
            at += size
        return (out, b"".join(pairs), *counts) if flush() else None


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    cols, names = [], []
    for i, field in enumerate(schema.split(", ")):
        name, kind = field.split()
        values = [r[i] for r in rows]
        if kind == "array<int>":
            ends = np.cumsum([0, *(len(v) // 4 for v in values)])
            cols.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(values), dtype="<i4"))))
        else:
            cols.append(pa.array(values, kinds[kind]))
        names.append(name)
    return pa.RecordBatch.from_arrays(cols, names)


def _batches(rows: Iterator[tuple], schema: str, size: Callable[[tuple], int]) -> Iterator[pa.RecordBatch]:
    held, load = [], 0
    for row in rows:
        held.append(row)
        load += size(row)
        if load > _OUT_BYTES:
            yield _batch(held, schema)
            held, load = [], 0
    yield _batch(held, schema)


def _rows(batches: Iterator[pa.RecordBatch], *cols: str) -> Iterator[tuple]:
    """Values row by row: a batch is never a list of Python texts."""
    for batch in batches:
        for values in zip(*(batch.column(c) for c in cols), strict=True):
            yield tuple(v.as_py() for v in values)


def _align(a: str, b: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    aligner, base = Aligner(a, b), TaskContext.get().partitionId() << 36

    def rows():
        n, ids, texts, held = base, [], [], 0
        for doc_id, text in _rows(batches, "doc_id", "text"):
            ids.append(doc_id)
            texts.append(text or "")
            held += len(texts[-1])
            if held >= _AT_ONCE:
                yield from done(n, ids, texts)
                n, ids, texts, held = n + len(ids), [], [], 0
        yield from done(n, ids, texts)

    def done(n, ids, texts):
        for n, doc_id, (groups, pairs, n_a, n_b) in zip(count(n), ids, aligner.texts(texts)):
            yield n, doc_id, n_a, n_b, len(pairs) // 4, groups[:-1], pairs

    yield from _batches(rows(), _SINGLE, lambda r: len(r[5]) + len(r[6]) + 64)


def ranges(text: str, chunk: int) -> Iterator[tuple[str, int, int]]:
    """Slices of ``text`` between word borders, each with the range (lo, hi] of
    the bytes of ``space + slice`` that is its own.

    The ranges are of ``chunk`` characters, or longer where no border comes
    near: a slice is never much longer than its range.
    """
    start, first = 0, 0  # of the range and of the slice
    while start < len(text) or not start:
        end = min(start + chunk, len(text))
        border = _BORDER.search(text, end) if end < len(text) else None
        last = border.start() if border else len(text)
        if last - end > chunk:
            end = last
        whole = text[first:last]
        # The space before the slice is the text's own, or the one put before all; it may be the range's first byte.
        lo = len(text[first:start].encode()) + (first <= start) if start else 0
        hi = len(text[first:end].encode()) + 1
        yield whole, lo, hi
        if end >= len(text):
            return
        if last == end:  # the next range begins with the border's space
            start, first = end, end + 1
            continue
        back = 256
        while True:
            at = max(first, end - back)
            found = [m.end() for m in _BORDER.finditer(text, max(at - 1, 0), end + 1) if m.end() <= end and m.end() > first]
            if found or at == first:
                break
            back *= 8
        start, first = end, found[-1] if found else first


def _cut(chunk: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base = TaskContext.get().partitionId() << 36

    def rows():
        for n, (doc_id, text) in enumerate(_rows(batches, "doc_id", "text")):
            for part, (piece, lo, hi) in enumerate(ranges(text, chunk)):
                yield -1 - base - n, doc_id, part, piece, lo, hi

    yield from _batches(rows(), _CUT, lambda r: len(r[3]) + 64)


def _fragments(a: str, b: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    aligner = Aligner(a, b)

    def rows():
        for row, doc_id, part, text, lo, hi in _rows(batches, "row", "doc_id", "part", "text", "lo", "hi"):
            found = aligner.range(text, lo, hi)
            fragment, pairs, n_a, n_b = found or ((False, "", "", "", "", ""), b"", 0, 0)
            yield row, doc_id, part, found is not None, n_a, n_b, *fragment, pairs

    yield from _batches(rows(), _FRAGMENT, lambda r: len(r[9]) + len(r[12]) + 64)


def _close(a: Column, b: Column) -> Column:
    return F.concat(F.rtrim(a, F.lit(",")), F.lit("|"), F.rtrim(b, F.lit(",")), F.lit(";"))


def _compose(x: Column, y: Column) -> Column:
    """``compose`` of two struct columns."""

    def of(cut, head_a, head_b, body, tail_a, tail_b):
        parts = zip((cut, head_a, head_b, body, tail_a, tail_b), ("cut", "head_a", "head_b", "body", "tail_a", "tail_b"), strict=True)
        return F.struct(*(c.alias(name) for c, name in parts))

    both = F.concat(x.body, _close(F.concat(x.tail_a, y.head_a), F.concat(x.tail_b, y.head_b)), y.body)
    return (
        F.when(~x.cut, of(y.cut, F.concat(x.head_a, y.head_a), F.concat(x.head_b, y.head_b), y.body, y.tail_a, y.tail_b))
        .when(~y.cut, of(x.cut, x.head_a, x.head_b, x.body, F.concat(x.tail_a, y.head_a), F.concat(x.tail_b, y.head_b)))
        .otherwise(of(F.lit(True), x.head_a, x.head_b, both, y.tail_a, y.tail_b))
    )


def _reduce(fragments: DataFrame) -> DataFrame:
    """One row per long document, its fragments composed level by level."""
    last = fragments.agg(F.max("part")).first()[0] or 0
    parts = ("cut", "head_a", "head_b", "body", "tail_a", "tail_b")
    out = fragments.select("row", "doc_id", "part", "ok", "n_a", "n_b", F.size("pairs").cast("long").alias("n_groups"), F.struct(*parts).alias("f"))
    neutral = F.struct(F.lit(False).alias("cut"), *(F.lit("").alias(c) for c in parts[1:]))
    while last >= 0:
        near = F.sort_array(F.collect_list(F.struct("part", "f")))  # FAN fragments at most
        out = out.groupBy("row", F.expr(f"part div {FAN}").cast("int").alias("part")).agg(
            F.first("doc_id").alias("doc_id"), F.bool_and("ok").alias("ok"),
            *(F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups")), near.alias("near"),
        )
        out = out.withColumn("f", F.aggregate("near", neutral, lambda x, y: _compose(x, y.f))).drop("near")
        last = last // FAN if last else -1
    whole = F.rtrim(F.concat(_close(F.col("f.head_a"), F.col("f.head_b")), F.col("f.body")), F.lit(";"))
    counts = (F.when(F.col("ok"), F.col(c)).otherwise(0).cast("long").alias(c) for c in ("n_a", "n_b", "n_groups"))
    return out.select("row", "doc_id", *counts, F.when(F.col("ok"), whole).otherwise("").alias("groups"))


def _same(groups: Column) -> Column:
    return groups


def cross_align(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    a: str = BYTE_VOCABULARY,
    b: str = PIECE_VOCABULARY,
    chunk: int = CHUNK,
    keep: Callable[[Column], Column] = _same,
) -> DataFrame:
    """Groups and links of the tokens of A and B, a row per row of ``docs``.

    ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups``.
    ``groups`` is ``a1,a2|b1;a3|b2,b3`` in order. Tokens are never empty, so a
    common end has one token of either side: a link per group. ``count_sum`` adds the corpus-wide
    counts of a row's linked id pairs; ``n_best`` counts the links whose pair has the
    largest count of its B id, ties included. A text that is null or empty, or
    whose bytes a vocabulary does not give back (one with U+2581), has no
    tokens: zeros and an empty ``groups``. Repeated rows and null ids are rows
    like any others and count for the corpus as often as they come. ``keep`` is
    applied to ``groups`` before it is written. Texts of any length: those of
    more than ``chunk`` bytes are aligned in ranges. Other columns are not read.
    """
    ship_package(docs.sparkSession)
    size = PieceTokens(b).size
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    long = F.coalesce(F.octet_length("text") > chunk, F.lit(False))
    single = rows.where(~long).mapInArrow(partial(_align, a, b), _SINGLE)
    single = staged(single.withColumn("groups", keep(F.col("groups"))), "align-single")
    cuts = staged(rows.where(long).mapInArrow(partial(_cut, chunk), _CUT), "align-ranges")
    fragments = staged(cuts.repartition("row", "part").mapInArrow(partial(_fragments, a, b), _FRAGMENT), "align-fragments")
    whole = _reduce(fragments)
    whole = staged(whole.withColumn("groups", keep(F.col("groups"))), "align-whole")
    links = single.select("row", "pairs").unionByName(
        fragments.select("row", "pairs").join(whole.where("n_groups > 0").select("row"), "row", "left_semi")
    )
    found = single.drop("pairs").unionByName(whole)
    return _with_counts(found, links, size).drop("row")


def _with_counts(found: DataFrame, links: DataFrame, size: int) -> DataFrame:
    pairs = links.select("row", F.explode("pairs").alias("pair"))
    counts = staged(pairs.groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "align-counts")
    best = F.max("n").over(Window.partitionBy(F.expr(f"pair % {size}")))
    counts = counts.select("pair", "n", (F.col("n") == best).cast("long").alias("best"))
    sums = pairs.join(F.broadcast(counts), "pair").groupBy("row").agg(F.sum("n").alias("count_sum"), F.sum("best").alias("n_best"))
    zero = F.lit(0).cast("long")
    return found.join(sums, "row", "left").select(
        "row", "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups",
    )
