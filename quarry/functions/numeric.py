"""Null-safe arithmetic and key-hash sampling expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zero_if_null(c: str | Column) -> Column:
    """Missing count -> 0 (the unmatched side of an outer join)."""
    return F.coalesce(_col(c), F.lit(0))


def null_safe_difference(left: str | Column, right: str | Column) -> Column:
    return zero_if_null(left) - zero_if_null(right)


def key_hash_prefix(key: str | Column, seed: int) -> Column:
    """First 8 hex digits of md5("<seed>:<key>").

    Depends only on the key and the seed, never on partitioning or row order,
    so a split made from it is the same on every run and in DuckDB.
    """
    return F.substring(F.md5(F.concat(F.lit(f"{seed}:"), _col(key).cast("string"))), 1, 8)


def fraction_cut(fraction: float) -> str:
    """8-digit hex value below which a uniform md5 prefix falls with
    probability ``fraction`` (0.75 -> "c0000000"). "g" sorts above every
    hex prefix, so a fraction of 1 keeps every row."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be within [0, 1]")
    if fraction == 1.0:
        return "g"
    return format(int(round(fraction * 0x100000000)), "08x")
