"""Benchmark decontamination by winnowing, in DataFrame operations alone.

A window is ``span`` consecutive words of an item (a shorter item is one window
of its own length, handled as a class of spans). Of both texts the hashes of
k-grams are taken, and of every ``span - k + 1`` neighbouring hashes the least
is kept: a shared window has the same least hash on both sides, so its anchor
is among the fingerprints of both. Anchors with equal hashes are joined and the
match is extended word by word to both sides as far as a window reaches; runs
of at least ``span`` words are hits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import free_name, row_key, staged

SPAN = 10
GRAM = 5
BROADCAST_BYTES = 8 << 20
"""Measured bytes of benchmark fingerprints up to which they are broadcast."""

# Word characters are ASCII letters and digits and all beyond ASCII.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOW = 63  # positions modulo 64 take the low bits of a hash


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SEPARATORS), "")


def _coded(rows: DataFrame, k: int) -> DataFrame:
    """``rows`` with ``codes``: the hash of each k-gram, its low bits replaced by
    its position modulo 64.

    Hashed in full lower case: words equal after lower-casing A-Z are equal then.
    The word hashes are a column of their own, computed once a row: inside the
    lambda of the k-grams they would be computed for each of them. For the same
    reason the codes are exploded with the outer form: for the inner one the
    optimizer pushes a filter on them below this column.
    """
    rows = rows.withColumn("of", F.transform(F.col("w"), lambda w: F.xxhash64(F.lower(w))))

    def gram(i: Column) -> Column:
        mixed = F.xxhash64(*(F.get("of", i + j) for j in range(k)))
        return mixed.bitwiseAND(F.lit(~_LOW)).bitwiseOR(i.bitwiseAND(F.lit(_LOW)).cast("long"))

    return rows.withColumn("codes", F.transform(F.sequence(F.lit(0), F.size("of") - k), gram)).drop("of")


def _least(codes: Column, start: Column, window: int) -> Column:
    each = [F.get(codes, start + j) for j in range(window)]
    return F.least(*each) if window > 1 else each[0]


def _slice(word: str, anchor: Column, before: int, after: int) -> tuple[Column, Column]:
    """Words from ``before`` ahead of the anchor to ``after`` behind, and the anchor's place there."""
    first = F.greatest(anchor - before, F.lit(0))
    return F.slice(F.col(word), first + 1, F.lit(before + after)), anchor - first


def _doc_anchors(docs: DataFrame, span: int, k: int) -> DataFrame:
    """Winnowed anchors: one row for each stretch of windows with the same least code."""
    window = span - k + 1
    coded = _coded(docs.where(F.size("w") >= span), k)
    rows = coded.select("*", F.posexplode_outer("codes").alias("p", "code")).where(F.col("p") <= F.size("w") - span)
    least = _least(F.col("codes"), F.col("p"), window)
    before = F.when(F.col("p") > 0, _least(F.col("codes"), F.col("p") - 1, window))
    rows = rows.withColumn("m", least).where(~F.col("m").eqNullSafe(before))
    ahead = F.col("m").bitwiseAND(F.lit(_LOW)).cast("int") - F.col("p").bitwiseAND(F.lit(_LOW))
    rows = rows.withColumn("q", F.col("p") + ahead.bitwiseAND(F.lit(_LOW)))
    ctx, at = _slice("w", F.col("q"), span - k, span)
    return rows.select("doc_id", "k1", "k2", "q", F.col("m").bitwiseAND(F.lit(~_LOW)).alias("gram"), ctx.alias("ctx"), at.alias("at"))


def _item_anchors(items: DataFrame, span: int, k: int) -> DataFrame:
    """Winnowed anchors with every tied place, so that a match can be aligned."""
    window = span - k + 1
    coded = _coded(items, k)
    starts = coded.select("*", F.posexplode_outer("codes").alias("p", "code")).where(F.col("p") <= F.size("w") - span)
    high = _least(F.col("codes"), F.col("p"), window).bitwiseAND(F.lit(~_LOW))
    starts = starts.withColumn("gram", high).withColumn(
        "q", F.explode(F.transform(F.sequence(F.lit(0), F.lit(window - 1)), lambda j: F.col("p") + j))
    )
    tied = starts.where(F.get("codes", F.col("q")).bitwiseAND(F.lit(~_LOW)) == F.col("gram"))
    ctx, at = _slice("w", F.col("q"), span - k, span)
    return tied.select("item_id", "gram", ctx.alias("i_ctx"), at.alias("i_at")).distinct()


def _same(j: int) -> Column:
    """Whether the words ``j`` from the anchors are equal."""
    ours = F.get("ctx", F.col("at") + j)
    theirs = F.get("i_ctx", F.col("i_at") + j)
    return F.coalesce(F.translate(ours, UPPER, LOWER) == F.translate(theirs, UPPER, LOWER), F.lit(False))


def _reach(steps: list[int]) -> Column:
    """How many of the words at ``steps`` match before the first that does not."""
    out = F.lit(len(steps))
    for n, j in reversed(list(enumerate(steps))):
        out = F.when(~_same(j), F.lit(n)).otherwise(out)
    return out


def _hits(docs: DataFrame, items: DataFrame, span: int, k: int) -> DataFrame:
    """Matched stretches of words: from ``a`` up to ``b``, with the item."""
    anchors = staged(_item_anchors(items, span, k), f"benchmark-{span}")
    bytes_ = anchors.agg(F.sum(F.length(F.concat_ws("", "i_ctx")) + 16 * F.size("i_ctx") + 64)).first()[0] or 0
    if bytes_ <= BROADCAST_BYTES:
        anchors = F.broadcast(anchors)
    # Stored between: with the comparison of words in it, the loop over all
    # positions is too large a method for the JVM to compile.
    joined = staged(_doc_anchors(docs, span, k).join(anchors, "gram"), f"anchors-{span}")
    whole = reduce(lambda x, y: x & y, (_same(j) for j in range(k)))
    reach = span - k
    grown = joined.where(whole).select(
        "doc_id", "k1", "k2", "item_id",
        (F.col("q") - _reach([-1 - j for j in range(reach)])).alias("a"),
        (F.col("q") + k + _reach([k + j for j in range(reach)])).alias("b"),
    )
    return grown.where(F.col("b") - F.col("a") >= span).distinct()


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    span: int = SPAN,
    gram: int = GRAM,
) -> DataFrame:
    """Words of each document that lie in a window of a benchmark item.

    One row per row of ``docs``: ``doc_id, n_words, n_hit, n_items,
    items_sha256`` (of the ids of items with a window in it, sorted as strings,
    joined by commas), ``contaminated``. Null and empty texts have no words.
    Rows repeated with id and text get the same result; rows that share an id
    alone do not mix. An item of null id marks words but is not listed; items
    without words are ignored and repeated items count once. Other columns are
    not read.
    """
    keyed = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
        *(c.alias(n) for c, n in zip(row_key(id_col, text_col), ("k1", "k2"), strict=True)),
    )
    with_words = keyed.select("doc_id", "k1", "k2", words(F.col("text")).alias("w"))
    items = benchmark.select(F.col(item_col).cast("string").alias("item_id"), F.col(text_col).alias("text")).distinct()
    items = staged(items.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0), "items")
    width = F.least(F.size("w"), F.lit(span))
    spans = [r[0] for r in items.select(width).distinct().collect()]  # span values at most
    found = [_hits(with_words, items.where(width == s), s, min(gram, s)) for s in sorted(spans)]
    n_words = keyed.select("doc_id", "k1", "k2", F.coalesce(F.size(words(F.col("text"))), F.lit(0)).cast("long").alias("n_words"))
    if not found:
        found = [
            n_words.where(F.lit(False)).select("doc_id", "k1", "k2", F.lit("").alias("item_id"), F.lit(0).alias("a"), F.lit(0).alias("b"))
        ]
    hits = staged(reduce(DataFrame.unionByName, found), "hits").drop("doc_id")
    stretches = hits.select("k1", "k2", "a", "b").distinct()
    ahead = Window.partitionBy("k1", "k2").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.greatest(F.col("b") - F.greatest("a", F.coalesce(F.max("b").over(ahead), F.lit(0))), F.lit(0))
    n_hit = stretches.select("k1", "k2", covered.alias("n")).groupBy("k1", "k2").agg(F.sum("n").alias("n_hit"))
    listed = hits.groupBy("k1", "k2").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    out = n_words.join(n_hit, ["k1", "k2"], "left").join(listed, ["k1", "k2"], "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.concat_ws(",", "items"), F.lit("")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without a word in a benchmark window, with their columns."""
    # Joined by id and text, as ids may repeat: see contamination().
    k1, k2 = free_name(docs, "_k1"), free_name(docs, "_k2")
    keyed = docs.select("*", *(c.alias(n) for c, n in zip(row_key(id_col, text_col), (k1, k2), strict=True)))
    slim = keyed.select(F.struct(k1, k2).alias(id_col), F.col(text_col))
    bad = contamination(slim, benchmark, id_col, text_col, **options).where("contaminated")
    bad = bad.select(F.col(f"doc_id.{k1}").alias(k1), F.col(f"doc_id.{k2}").alias(k2))
    return keyed.join(staged(bad.distinct(), "contaminated"), [k1, k2], "left_anti").drop(k1, k2)
