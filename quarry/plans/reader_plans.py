"""Reader round trips: given tables written as text and CSV files in the shared
folder and read back through the readers of ``sources.readers``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import split_lines
from quarry.operators import classify, tokens
from quarry.plans.basket_plans import BASKETS_SQL
from quarry.plans.registry import register
from quarry.plans.sink_plans import _out_dir
from quarry.plans.token_plans import _TOKENS_SQL, PREFIX
from quarry.sources import driver_tables as dt
from quarry.sources import readers

_DIAGNOSIS_SQL = """
SELECT (l_orderkey * 8 + l_linenumber)::INTEGER AS id, l_linenumber::INTEGER AS clump_thickness,
       CASE WHEN l_linenumber % 4 <> 0 THEN l_quantity::INTEGER END AS bare_nuclei, l_returnflag AS class
FROM lineitem
"""


@register("read_lines_tokens", oracle=_TOKENS_SQL)
def read_lines_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """'th' token counts over documents written as text lines and scanned line by line."""
    path = _out_dir(spark, "lines")
    texts = dt.document_text(spark, sf_dir).where("text <> ''")
    texts.select(F.explode(split_lines(F.col("text"))).alias("value")).write.text(path)
    return tokens.prefix_counts(readers.read_lines(spark, path), PREFIX)


def _write_diagnosis(spark: SparkSession, sf_dir: str, path: str) -> None:
    li = dt.table(spark, sf_dir, "lineitem")
    number = F.col("l_linenumber").cast("int")
    cells = li.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        *[
            F.when(number % 4 != 0, F.col("l_quantity").cast("int").cast("string")).otherwise("?").alias(n) if n == "bare_nuclei" else number.alias(n)
            for n in readers.DIAGNOSIS_FEATURES
        ],
        F.col("l_returnflag").alias("class"),
    )
    cells.write.option("header", True).csv(path)


@register("read_diagnosis_rows", oracle=_DIAGNOSIS_SQL)
def read_diagnosis_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in the form of the diagnosis table, '?' for a missing cell, read with its schema."""
    path = _out_dir(spark, "diagnosis")
    _write_diagnosis(spark, sf_dir, path)
    return readers.read_diagnosis(spark, path).select("id", "clump_thickness", "bare_nuclei", "class")


@register("read_diagnosis_clean", oracle=f"SELECT * FROM ({_DIAGNOSIS_SQL}) WHERE bare_nuclei IS NOT NULL")
def read_diagnosis_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without the rows of a missing cell."""
    return classify.drop_missing(read_diagnosis_rows(spark, sf_dir), ["bare_nuclei"])


@register(
    "read_scanner_rows",
    oracle=BASKETS_SQL + "SELECT n_items AS numports, items_str AS ports_scanned_str, flag AS mirai, priority FROM baskets",
)
def read_scanner_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baskets written as a scanner profile with a further column, read with the profile's schema."""
    path = _out_dir(spark, "profile")
    b = dt.baskets(spark, sf_dir, with_orders=True)
    out = b.select(F.col("n_items").alias("numports"), F.col("items_str").alias("ports_scanned_str"), F.col("flag").alias("mirai"), "priority")
    out.write.option("header", True).csv(path)
    return readers.read_scanner_profile(spark, path)


@register(
    "missing_cell_causes",
    oracle="""
SELECT 'quantity' AS "column", CASE l_linenumber % 4 WHEN 0 THEN 'marker' WHEN 1 THEN 'empty' WHEN 2 THEN 'overflow' ELSE 'unparseable' END AS cause,
       count(*) AS n FROM lineitem GROUP BY 2
UNION ALL SELECT 'ship', 'empty', count(*) FROM lineitem WHERE l_linenumber % 2 = 0
""",
)
def missing_cell_causes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items written with cells that read as null for four reasons, counted by column and reason."""
    path = _out_dir(spark, "cells")
    n = F.col("l_linenumber").cast("int") % 4
    odd = F.when(n == 0, "?").when(n == 1, "").when(n == 2, "99999999999").otherwise("1x")
    ship = F.when(n % 2 == 0, "").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
    dt.table(spark, sf_dir, "lineitem").select("l_orderkey", odd.alias("quantity"), ship.alias("ship"), "l_returnflag").write.option("header", True).csv(path)
    return readers.missing_causes(spark, path, "l_orderkey long, quantity int, ship date, l_returnflag string")
