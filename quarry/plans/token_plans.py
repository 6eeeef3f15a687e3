"""Token-count queries (tweet hashtag counts and their day-to-day change).

The driver tables have no '#' tokens, so the prefix is a parameter: ``th``
here, '#' in the micro-fixture tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.operators import ranks, tokens
from quarry.plans.registry import register
from quarry.sources import driver_tables as dt

PREFIX = "th"
TOP_K = 100
DAY_1 = "2024-01-01"
DAY_2 = "2024-01-02"

_TOKENS_SQL = r"""
WITH lines AS (
  SELECT unnest(string_split_regex(regexp_replace(text, '(\r\n|\r|\n)\z', ''), '\r\n|\r|\n')) AS line
  FROM documents
  WHERE text <> ''
), toks AS (
  SELECT unnest(string_split(regexp_replace(line, '^\s+|\s+\z', '', 'g'), ' ')) AS token
  FROM lines
)
SELECT token, count(*) AS n
FROM toks
WHERE starts_with(token, 'th')
GROUP BY token
"""


@register("prefix_token_counts", oracle=_TOKENS_SQL, bench=True)
def prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(token, n) for tokens starting with 'th' over all document lines, ranked."""
    counts = tokens.text_prefix_counts(dt.document_text(spark, sf_dir), PREFIX)
    return tokens.rank(counts, "n", "token")


@register(
    "prefix_token_top_k",
    oracle=f"SELECT token, n, row_number() OVER (ORDER BY n DESC, token) AS place FROM ({_TOKENS_SQL}) QUALIFY place <= {TOP_K}",
    bench=True,
)
def prefix_token_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 100 most frequent 'th' tokens with their place, ties broken by token."""
    counts = tokens.text_prefix_counts(dt.document_text(spark, sf_dir), PREFIX)
    top = tokens.top_k(counts, TOP_K, "n", "token")
    # Numbered in the order that the plan gives: TOP_K rows in one partition.
    return top.withColumn("place", F.row_number().over(Window.orderBy(F.monotonically_increasing_id())).cast("long"))


@register(
    "prefix_token_ranks",
    oracle="SELECT token, n, row_number() OVER (ORDER BY n DESC, token) AS place FROM ("
    + _TOKENS_SQL.replace("WHERE starts_with(token, 'th')\n", "") + ")",
    bench=True,
)
def prefix_token_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every token of all document lines with its place among all, by count and then by token."""
    counts = tokens.text_prefix_counts(dt.document_text(spark, sf_dir), "")
    return ranks.with_places(counts, F.col("n").desc(), F.col("token").asc())


def _day_sql(day_from: str, day_to: str, out: str) -> str:
    return (
        f"SELECT user_id, count(*) AS {out} FROM events "
        f"WHERE ts >= TIMESTAMP '{day_from}' AND ts < TIMESTAMP '{day_to}' GROUP BY user_id"
    )


_CHANGE_CTE = (
    f"WITH l AS ({_day_sql(DAY_1, DAY_2, 'n_left')}), "
    f"r AS ({_day_sql(DAY_2, '2024-01-03', 'n_right')}) "
)


@register(
    "count_change_left",
    oracle=_CHANGE_CTE
    + "SELECT l.user_id, l.n_left, coalesce(r.n_right, 0) AS n_right, "
    "l.n_left - coalesce(r.n_right, 0) AS diff FROM l LEFT JOIN r ON l.user_id = r.user_id",
    bench=True,
)
def count_change_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-user event count of day 1 minus day 2, users of day 1 only."""
    left = dt.events_on_day(spark, sf_dir, DAY_1)
    right = dt.events_on_day(spark, sf_dir, DAY_2)
    return tokens.rank(tokens.count_change_of_rows(left, right, "user_id", how="left"), "diff", "user_id")


@register(
    "count_change_full",
    oracle=_CHANGE_CTE
    + "SELECT coalesce(l.user_id, r.user_id) AS user_id, coalesce(l.n_left, 0) AS n_left, "
    "coalesce(r.n_right, 0) AS n_right, coalesce(l.n_left, 0) - coalesce(r.n_right, 0) AS diff "
    "FROM l FULL OUTER JOIN r ON l.user_id = r.user_id",
)
def count_change_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same difference over users seen on either day."""
    left = dt.events_on_day(spark, sf_dir, DAY_1)
    right = dt.events_on_day(spark, sf_dir, DAY_2)
    return tokens.rank(tokens.count_change_of_rows(left, right, "user_id", how="full"), "diff", "user_id")


@register(
    "count_change_joined",
    oracle=_CHANGE_CTE
    + "SELECT l.user_id, l.n_left, coalesce(r.n_right, 0) AS n_right, "
    "l.n_left - coalesce(r.n_right, 0) AS diff FROM l LEFT JOIN r ON l.user_id = r.user_id",
)
def count_change_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left-join form: two per-day count tables joined, missing side = 0."""
    left = tokens.count_by_key(dt.events_on_day(spark, sf_dir, DAY_1), "user_id")
    right = tokens.count_by_key(dt.events_on_day(spark, sf_dir, DAY_2), "user_id")
    return tokens.count_change(left, right, "user_id", how="left")


@register("prefix_token_counts_stream", oracle=_TOKENS_SQL)
def prefix_token_counts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 'th' token counts computed by a streaming aggregation that reads
    the documents table, a file or a folder of files, as it arrives (must equal the batch result)."""
    from quarry.streaming.token_stream import prefix_counts_from_files

    schema = dt.table(spark, sf_dir, "documents").schema
    # A pattern: the stream's reader takes a plain path for a folder, and the table may be one file.
    return prefix_counts_from_files(spark, f"{sf_dir.rstrip('/')}/documents.parque[t]", schema, PREFIX, "text")
