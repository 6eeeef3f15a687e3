"""Token counting: tokenise lines, count tokens with a prefix, compare periods.

All operators are plain DataFrame plans: explode + filter + partial/final hash
aggregate, no Python worker. A token that holds a third of all rows is
combined map-side to one row per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.numeric import null_safe_difference, zero_if_null
from quarry.functions.text import py_strip, split_lines, split_on_space


def tokenize(lines: DataFrame, col: str = "value", out: str = "token") -> DataFrame:
    """One row per token: strip the line, split on single spaces.

    Empty tokens are kept (two spaces in a row give one), as a Python
    ``line.strip().split(" ")`` does.
    """
    return lines.select(F.explode(split_on_space(py_strip(F.col(col)))).alias(out))


def lines_of(texts: DataFrame, col: str = "text", out: str = "value") -> DataFrame:
    """One row per line of each text (a text behaves like one small file)."""
    return texts.select(F.explode(split_lines(F.col(col))).alias(out))


def _prefilter(df: DataFrame, col: str, prefix: str) -> DataFrame:
    # A token can only start with the prefix if its line contains it; drop the
    # other lines before exploding them. Exact, and free for an empty prefix.
    if prefix:
        return df.where(F.col(col).contains(prefix))
    return df


def prefix_tokens(lines: DataFrame, prefix: str, col: str = "value", out: str = "token") -> DataFrame:
    """Tokens that start with ``prefix`` (an empty prefix keeps every token)."""
    tokens = tokenize(_prefilter(lines, col, prefix), col=col, out=out)
    return tokens.where(F.col(out).startswith(prefix)) if prefix else tokens


def count_by_key(df: DataFrame, key: str, out: str = "n") -> DataFrame:
    """Count per key (partial + final hash aggregate)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(out))


def prefix_counts(
    lines: DataFrame, prefix: str, col: str = "value", key: str = "token", out: str = "n"
) -> DataFrame:
    """(token, n) for every token starting with ``prefix``."""
    return count_by_key(prefix_tokens(lines, prefix, col=col, out=key), key, out)


def text_prefix_counts(
    texts: DataFrame, prefix: str, col: str = "text", key: str = "token", out: str = "n"
) -> DataFrame:
    """Same as :func:`prefix_counts` on multi-line texts (split into lines first)."""
    pre = _prefilter(texts.select(col), col, prefix)
    return prefix_counts(lines_of(pre, col=col, out="value"), prefix, col="value", key=key, out=out)


def rank(df: DataFrame, value: str = "n", key: str = "token", ascending: bool = False) -> DataFrame:
    """Global order by value (descending by default), ties by key ascending."""
    order: Column = F.col(value).asc() if ascending else F.col(value).desc()
    return df.orderBy(order, F.col(key).asc())


def top_k(df: DataFrame, k: int, value: str = "n", key: str = "token") -> DataFrame:
    """First k rows of :func:`rank`; planned as TakeOrderedAndProject."""
    return rank(df, value, key).limit(k)


_HOW = {"left", "full", "right", "inner"}


def count_change(
    left_counts: DataFrame,
    right_counts: DataFrame,
    key: str,
    how: str = "left",
    value: str = "n",
    out: str = "diff",
) -> DataFrame:
    """Join two count tables on ``key``; diff = left - right, missing = 0.

    ``how="left"`` keeps keys of the left table only (the reference's left
    outer join); ``"full"`` keeps keys of either side.
    """
    if how not in _HOW:
        raise ValueError(f"how must be one of {sorted(_HOW)}")
    lc = left_counts.select(F.col(key), F.col(value).alias("n_left"))
    rc = right_counts.select(F.col(key), F.col(value).alias("n_right"))
    joined = lc.join(rc, key, how)
    return joined.select(
        key,
        zero_if_null("n_left").alias("n_left"),
        zero_if_null("n_right").alias("n_right"),
        null_safe_difference("n_left", "n_right").alias(out),
    )


def count_change_of_rows(
    left_rows: DataFrame, right_rows: DataFrame, key: str, how: str = "left", out: str = "diff"
) -> DataFrame:
    """Count keys on two sides and take the difference in ONE aggregate.

    The two row sets are unioned with a side tag and counted per key with
    conditional counts: one shuffle instead of two aggregates and a join.
    Result equals :func:`count_change` of the two per-key counts.
    """
    if how not in _HOW:
        raise ValueError(f"how must be one of {sorted(_HOW)}")
    tagged = left_rows.select(F.col(key), F.lit(True).alias("_left")).unionByName(
        right_rows.select(F.col(key), F.lit(False).alias("_left"))
    )
    counts = tagged.groupBy(key).agg(
        F.count_if(F.col("_left")).alias("n_left"),
        F.count_if(~F.col("_left")).alias("n_right"),
    )
    if how == "left":
        counts = counts.where(F.col("n_left") > 0)
    elif how == "right":
        counts = counts.where(F.col("n_right") > 0)
    elif how == "inner":
        counts = counts.where((F.col("n_left") > 0) & (F.col("n_right") > 0))
    return counts.select(key, "n_left", "n_right", (F.col("n_left") - F.col("n_right")).alias(out))
