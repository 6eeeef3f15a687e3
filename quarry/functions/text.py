"""String expressions: Python-like strip, one-space split, line breaks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that decide token boundaries, chosen to match Python's
# ``str.strip()`` / ``str.split(" ")`` and Hadoop's line reader.
# (?U) makes \s the Unicode white-space class, so tabs and no-break spaces are
# stripped too; Spark's trim() removes spaces only. \z is the very end of
# the string (Java's $ would also match before a final line break).
STRIP_PATTERN = r"(?U)^\s+|\s+\z"
LINE_BREAK = r"\r\n|\r|\n"
TRAILING_LINE_BREAK = r"(\r\n|\r|\n)\z"
TOKEN_SEPARATOR = " "


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: str | Column) -> Column:
    """Remove leading and trailing white space like Python's ``str.strip()``."""
    return F.regexp_replace(_col(c), STRIP_PATTERN, "")


def split_on_space(c: str | Column) -> Column:
    """Split on every single space; empty tokens are kept (limit -1)."""
    return F.split(_col(c), TOKEN_SEPARATOR, -1)


def split_lines(c: str | Column) -> Column:
    """Split a text into lines the way a text-file reader does.

    A final line break does not start an empty last line, and an empty text
    has no lines at all.
    """
    text = _col(c)
    body = F.regexp_replace(text, TRAILING_LINE_BREAK, "")
    return F.when(text == F.lit(""), F.array().cast("array<string>")).otherwise(
        F.split(body, LINE_BREAK, -1)
    )


def starts_with(c: str | Column, prefix: str) -> Column:
    return _col(c).startswith(prefix)
