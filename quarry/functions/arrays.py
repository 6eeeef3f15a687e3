"""Array expressions for item baskets."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_items(c: str | Column, sep: str = "-") -> Column:
    """Split a delimited string into a duplicate-free item array.

    ``split`` takes a regular expression, so the separator is escaped. Items
    are de-duplicated once here: a basket is a set (membership ignores
    repeats, so counting must too).
    """
    return F.array_distinct(F.split(_col(c), re.escape(sep), -1))


def contains_all(c: str | Column, items: Iterable[str]) -> Column:
    """True when the array holds every one of ``items``."""
    wanted = list(dict.fromkeys(items))
    if not wanted:
        return F.lit(True)
    cond = None
    for item in wanted:
        term = F.array_contains(_col(c), item)
        cond = term if cond is None else cond & term
    return cond
