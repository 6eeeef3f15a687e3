"""Inputs derived from the driver's parquet tables.

The reference reads tweet text files, a scanner-profile CSV and a diagnosis
CSV that are not shipped. These functions build stand-ins with the same
shape from the driver tables, as plain DataFrame plans (nothing is collected
or materialised), so every query's work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.ml.functions import array_to_vector

from quarry.functions.text import split_lines

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def document_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts (doc_id, text); the token operators split lines themselves.

    The parallelism is that of the scan's splits (spark.sql.files settings).
    """
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def events_on_day(spark: SparkSession, sf_dir: str, day: str) -> DataFrame:
    """Events of one calendar day; the range filter reaches the scan.

    The day bounds take the column's own type: for a timestamp without time
    zone (as stored) the comparison involves no zone at all, so the result
    does not depend on the session time zone.
    """
    ev = table(spark, sf_dir, "events")
    start = F.lit(day).cast(ev.schema["ts"].dataType)
    return ev.where((F.col("ts") >= start) & (F.col("ts") < start + F.expr("INTERVAL 1 DAY")))


def baskets(spark: SparkSession, sf_dir: str, with_orders: bool = True) -> DataFrame:
    """Scanner-profile stand-in: one basket of part brands per order.

    Columns: basket_id (order key), items (sorted distinct brands),
    items_str (dash-joined, the ``ports_scanned_str`` analogue), n_items
    (the ``numports`` analogue), flag (order status 'F', the external label)
    and priority (order priority, a grouping key).

    collect_set runs as a partial aggregate, so even an order holding a third
    of all line items reaches the final aggregate as one small set per map
    task; a basket is bounded by the number of distinct brands.

    ``with_orders=False`` skips the join to ``orders`` (flag and priority are
    then null) for queries that only look at the items.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    pa = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    grouped = (
        li.join(pa, li.l_partkey == pa.p_partkey, "inner")
        .groupBy("l_orderkey")
        .agg(F.array_sort(F.collect_set("p_brand")).alias("items"))
    )
    if with_orders:
        joined = grouped.join(od, grouped.l_orderkey == od.o_orderkey, "left")
    else:
        joined = grouped.select(
            "l_orderkey", "items", F.lit(None).cast("string").alias("o_orderstatus"),
            F.lit(None).cast("string").alias("o_orderpriority"),
        )
    return joined.select(
        F.col("l_orderkey").alias("basket_id"),
        F.col("items"),
        F.concat_ws("-", "items").alias("items_str"),
        F.size("items").alias("n_items"),
        (F.col("o_orderstatus") == F.lit("F")).alias("flag"),
        F.col("o_orderpriority").alias("priority"),
    )


def order_part_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct parts per order: (basket_id, size)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    return li.groupBy(F.col("l_orderkey").alias("basket_id")).agg(
        F.count_distinct("l_partkey").alias("size")
    )


def labeled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents left-joined to their labels; unlabelled rows carry nulls.

    Columns: doc_id, text, lang, quality, toxic.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return docs.join(labels, "doc_id", "left")


# Integer features computed from the text; they stand in for the nine
# integer cell measurements of the diagnosis table.
TEXT_FEATURES = [
    "n_chars",
    "n_lines",
    "n_words",
    "n_digits",
    "n_upper",
    "n_punct",
    "n_at",
    "n_long_words",
    "max_line_chars",
]


def diagnosis_like(spark: SparkSession, sf_dir: str, labeled_only: bool = False) -> DataFrame:
    """Diagnosis-table stand-in: id, nine integer features, class, quality.

    ``class`` is a string label ("high"/"low" quality), null where the
    document has no label, so the missing-value path is exercised. With
    ``labeled_only`` unlabelled documents are dropped before the features are
    computed (the same rows a later missing-value filter keeps, for less work:
    the filter on the derived ``class`` cannot be pushed below the features).
    """
    d = labeled_documents(spark, sf_dir)
    if labeled_only:
        d = d.where(F.col("quality").isin(0, 1))
    text = F.col("text")
    lines = split_lines(text)
    words = F.split(text, r"\s+", -1)
    return d.select(
        F.col("doc_id").alias("id"),
        F.length(text).cast("int").alias("n_chars"),
        F.size(lines).cast("int").alias("n_lines"),
        F.size(words).cast("int").alias("n_words"),
        (F.length(text) - F.length(F.regexp_replace(text, "[0-9]", ""))).cast("int").alias("n_digits"),
        (F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))).cast("int").alias("n_upper"),
        (F.length(text) - F.length(F.regexp_replace(text, r"[.,;:!?]", ""))).cast("int").alias("n_punct"),
        (F.length(text) - F.length(F.regexp_replace(text, "@", ""))).cast("int").alias("n_at"),
        F.size(F.filter(words, lambda w: F.length(w) > 8)).cast("int").alias("n_long_words"),
        F.aggregate(F.transform(lines, lambda l: F.length(l)), F.lit(0), lambda a, b: F.greatest(a, b))
        .cast("int")
        .alias("max_line_chars"),
        F.when(F.col("quality") == 1, F.lit("high"))
        .when(F.col("quality") == 0, F.lit("low"))
        .alias("class"),
        F.col("quality"),
        F.col("toxic"),
    )


def embedding_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, features: dense vector, label) from ``embeddings``."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(
        "vec_id",
        array_to_vector(F.col("embedding")).alias("features"),
        F.col("label"),
    )
