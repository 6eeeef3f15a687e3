"""Outlier cuts on a size column (ports per scanner, parts per order).

The cut is a scalar subquery (``DataFrame.scalar()``): Spark computes the
one-value aggregate once and uses it as a literal in the filter. Nothing is
collected to the driver and no cross join is planned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def size_histogram(df: DataFrame, size: str, min_size: int = 2, out: str = "n") -> DataFrame:
    """(size, n): rows per size value, sizes of at least ``min_size``."""
    return df.where(F.col(size) >= min_size).groupBy(size).agg(F.count(F.lit(1)).alias(out))


def rarity_cut_frame(df: DataFrame, size: str, min_group_count: int = 2, min_size: int = 2) -> DataFrame:
    """One row, column ``cut``: the largest size shared by at least
    ``min_group_count`` rows (null when no size is that common)."""
    hist = size_histogram(df, size, min_size, out="_n")
    return hist.where(F.col("_n") >= min_group_count).agg(F.max(size).alias("cut"))


def rarity_cut(df: DataFrame, size: str, min_group_count: int = 2, min_size: int = 2) -> Column:
    """The cut as a scalar-subquery Column."""
    return rarity_cut_frame(df, size, min_group_count, min_size).scalar()


def _as_col(cut: Column | int) -> Column:
    return cut if isinstance(cut, Column) else F.lit(cut)


def extremes(df: DataFrame, size: str, cut: Column | int) -> DataFrame:
    """Rows with size above the cut. A null cut selects nothing."""
    return df.where(F.col(size) > _as_col(cut))


def non_extremes(df: DataFrame, size: str, cut: Column | int, min_size: int = 2) -> DataFrame:
    """Rows with ``min_size <= size <= cut``; with a null cut, every row of at
    least ``min_size`` is kept (nothing is extreme)."""
    c = _as_col(cut)
    return df.where((F.col(size) >= min_size) & (c.isNull() | (F.col(size) <= c)))


def split_by_rarity(
    df: DataFrame, size: str, min_group_count: int = 2, min_size: int = 2
) -> tuple[DataFrame, DataFrame]:
    """(extreme rows, kept rows) for the rarity cut."""
    cut = rarity_cut(df, size, min_group_count, min_size)
    return extremes(df, size, cut), non_extremes(df, size, cut, min_size)


def split_by_value(df: DataFrame, size: str, cut: int, min_size: int = 2) -> tuple[DataFrame, DataFrame]:
    """(extreme rows, kept rows) for a fixed cut value."""
    return extremes(df, size, cut), non_extremes(df, size, cut, min_size)
