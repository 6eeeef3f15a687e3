"""Sinks: text pairs, CSV with or without header, result frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def python_str_repr(c: Column) -> Column:
    """The quoted form Python prints for a string inside a tuple.

    Double quotes when the text holds a single quote and no double quote,
    else single quotes; backslash, the chosen quote, tab, newline and
    carriage return are escaped. (Other non-printable characters are written
    as they are.)
    """
    esc = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for raw, shown in (("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        esc = F.replace(esc, F.lit(raw), F.lit(shown))
    use_double = c.contains("'") & ~c.contains('"')
    single = F.concat(F.lit("'"), F.replace(esc, F.lit("'"), F.lit("\\'")), F.lit("'"))
    double = F.concat(F.lit('"'), esc, F.lit('"'))
    return F.when(use_double, double).otherwise(single)


def pair_lines(df: DataFrame, key: str, value: str) -> DataFrame:
    """``(key, value)`` lines as a pair-RDD text save writes them."""
    line = F.concat(F.lit("("), python_str_repr(F.col(key)), F.lit(", "), F.col(value).cast("string"), F.lit(")"))
    return df.select(line.alias("value"))


def write_pairs_text(df: DataFrame, path: str, key: str, value: str, mode: str = "overwrite") -> None:
    """Write ``(key, value)`` lines, one text part per partition."""
    pair_lines(df, key, value).write.mode(mode).text(path)


def write_csv(df: DataFrame, path: str, header: bool = False, mode: str = "overwrite") -> None:
    """CSV sink; arrays are rendered as dash-joined strings."""
    cols = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.ArrayType):
            cols.append(F.concat_ws("-", F.col(field.name)).alias(field.name))
        else:
            cols.append(F.col(field.name))
    df.select(*cols).write.mode(mode).option("header", header).csv(path)


def write_result(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Result tables (port sets, grid, profiles) as CSV with a header."""
    write_csv(df, path, header=True, mode=mode)


