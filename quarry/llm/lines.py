"""Line dedup by winnowing over line hashes, in DataFrame operations alone.

Of every ``run`` neighbouring line hashes of a document the least is a
fingerprint, so every run of that length has one. Fingerprints are joined with
their repeated values; round a repeated one the match is extended to both sides
as far as a run reaches, by the hashes of its neighbours. Of runs with equal
lines the first by document id and place stays; the lines of later ones go. Shorter runs that are long by words
are all judged, each by two hashes of its lines, in the same join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import row_key, staged

RUN = 3
WORD = r"[^\x20\x09-\x0D]+"


def _is_least(hashes: Column, p: Column, size: Column, run: int) -> Column:
    """Whether line ``p`` has the least hash of some run, ties included."""
    out = F.lit(False)
    for back in range(run):
        start = p - back
        inside = (start >= 0) & (start + run <= size)
        others = [F.get(hashes, p) <= F.get(hashes, start + j) for j in range(run) if j != back]
        out = out | (inside & reduce(lambda a, b: a & b, others, F.lit(True)))
    return out


def _long_runs(docs: DataFrame, run: int, long_words: int) -> DataFrame:
    """Every run of fewer than ``run`` lines of ``docs`` that has ``long_words`` words or more."""
    words = lambda x: F.size(F.regexp_extract_all(x, F.lit(WORD), F.lit(0)))
    lines = F.transform(
        F.split("text", "\n"), lambda x: F.struct(words(x).alias("w"), F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"))
    )
    counted = docs.select("k1", "k2", "doc_id", lines.alias("g"))

    def of_size(size: int) -> Column:
        def one(_: Column, i: Column) -> Column:
            own = [F.get("g", i + j) for j in range(size)]  # null beyond the end, and so is the sum
            return F.struct(
                i.alias("s"), F.lit(size).alias("size"), reduce(lambda a, b: a + b, [x["w"] for x in own]).alias("w"),
                F.xxhash64(*(x["a"] for x in own)).alias("r1"), F.xxhash64(F.lit(size), *(x["b"] for x in reversed(own))).alias("r2"),
            )

        return F.filter(F.transform("g", one), lambda x: x["w"] >= long_words)

    found = counted.select("k1", "k2", "doc_id", F.concat(*map(of_size, range(1, run))).alias("found"))
    # The outer form, as for the inner one the optimizer hashes all lines twice.
    rows = found.select("k1", "k2", "doc_id", F.explode_outer("found").alias("x")).where("x is not null")
    return rows.select("k1", "k2", "doc_id", "x.s", "x.size", "x.r1", "x.r2").distinct()


def repeated_runs(docs: DataFrame, run: int = RUN, long_words: int | None = None) -> DataFrame:
    """Starts ``s`` and lengths ``size`` of the runs of ``run`` lines of ``docs(k1, k2, doc_id, text)``, and
    of the shorter ones of ``long_words`` words, whose lines also start earlier: in a smaller id (null ids
    last), or before ``s``."""
    hashed = docs.select("k1", "k2", "doc_id", F.transform(F.split("text", "\n"), lambda x: F.xxhash64(x)).alias("h"))
    # The outer form, as for the inner one the optimizer hashes all lines twice.
    rows = hashed.select("*", F.posexplode_outer("h").alias("p", "line"))
    p, n = F.col("p"), F.size("h")
    first = F.greatest(p - (run - 1), F.lit(0))
    marks = rows.where(_is_least(F.col("h"), p, n, run)).select(
        "k1", "k2", "doc_id", "line", "p", first.alias("at"), F.slice("h", first + 1, F.lit(2 * run - 1) - (first - p + run - 1)).alias("near")
    )
    marks = staged(marks.distinct(), "line-marks")
    # Aggregates are written before they are joined: AQE splits a hot line or run
    # only where both sides of the join come from exchanges of their own.
    twice = staged(marks.groupBy("line").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("line"), "line-twice")
    some = marks.join(twice, "line", "left_semi")
    # Runs that hold the mark, by the hashes of all their lines.
    starts = F.sequence(F.lit(0), F.least(F.col("p") - F.col("at"), F.size("near") - run))
    runs = some.where(F.size("near") >= run).select("k1", "k2", "doc_id", "at", "near", F.explode(starts).alias("o"))
    lines = [F.get("near", F.col("o") + j) for j in range(run)]
    runs = runs.select(
        "k1", "k2", "doc_id", (F.col("at") + F.col("o")).alias("s"), F.lit(run).alias("size"),
        F.xxhash64(*lines).alias("r1"), F.xxhash64(F.lit(run), *reversed(lines)).alias("r2"),
    ).distinct()
    if long_words is not None and run > 1:
        runs = runs.unionByName(_long_runs(docs, run, long_words))
    runs = staged(runs, "line-runs")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2", "s")
    origin = runs.groupBy("r1", "r2").agg(F.min(place).alias("origin"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = runs.join(staged(origin, "line-origins"), ["r1", "r2"])
    same = (F.col("k1") == F.col("origin.k1")) & (F.col("k2") == F.col("origin.k2")) & (F.col("s") == F.col("origin.s"))
    return later.where(~same).select("k1", "k2", "s", "size").distinct()


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = RUN, long_words: int | None = None) -> DataFrame:
    """Texts without the runs of ``run`` or more lines that came before.

    With ``long_words``, runs of fewer lines go too if they have that many words
    together (stretches without white space); without it they stay, however long.

    One row per row of ``docs``: ``doc_id, n_lines, n_removed, kept``. Lines are
    split at line feeds alone and compared whole; a run is judged on the input,
    not on what is left. An empty text is one empty line, a null text has none
    and is kept as empty. Rows repeated with id and text count as one document
    and get the same result. Other columns are not read.
    """
    keyed = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
        *(c.alias(n) for c, n in zip(row_key(id_col, text_col), ("k1", "k2"), strict=True)),
    )
    starts = repeated_runs(keyed, run, long_words)
    # A document has no more starts of one length than lines.
    gone = starts.groupBy("k1", "k2").agg(F.collect_list(F.struct("s", "size")).alias("starts"))
    cut = F.array_distinct(F.flatten(F.transform("starts", lambda x: F.sequence(x["s"], x["s"] + x["size"] - 1))))
    gone = gone.select("k1", "k2", cut.alias("gone"))
    # Split before the join, so that the lines are an array once and for all.
    split = keyed.select("doc_id", "k1", "k2", F.split("text", "\n").alias("l"))
    rest = F.array_except(F.sequence(F.lit(0), F.size("l") - 1), F.col("gone"))
    left = F.when(F.col("gone").isNull(), F.col("l")).otherwise(F.transform(rest, lambda i: F.get("l", i)))
    return split.join(gone, ["k1", "k2"], "left").select(
        "doc_id",
        F.when(F.col("l").isNull(), 0).otherwise(F.size("l")).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join(left, "\n"), F.lit("")).alias("kept"),
    )
