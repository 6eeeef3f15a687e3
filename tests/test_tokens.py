"""Token operators against plain Python on hand-written lines (Q2, Q4, Q5, Q17)."""

import collections
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.functions.text import py_strip, split_lines, split_on_space
from quarry.operators import tokens

# Micro-fixture "lines" (FIXTURES section 4).
TEXTS = ["", "  #a  b#c #a ", "\t#t x\u00a0", "#b\n#c d"]


def python_lines(text):
    # Line reader semantics: \n, \r, \r\n end a line; no empty last line.
    if text == "":
        return []
    return re.split(r"\r\n|\r|\n", re.sub(r"(\r\n|\r|\n)\Z", "", text))


def python_counts(texts, prefix):
    c = collections.Counter(
        tok for t in texts for line in python_lines(t) for tok in line.strip().split(" ") if tok.startswith(prefix)
    )
    return dict(c)


def spark_counts(spark, texts, prefix):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    return {r["token"]: r["n"] for r in tokens.text_prefix_counts(df, prefix).collect()}


def test_hashtag_counts_match_python(spark):
    got = spark_counts(spark, TEXTS, "#")
    assert got == python_counts(TEXTS, "#")
    assert got == {"#a": 2, "#t": 1, "#b": 1, "#c": 1}


def test_empty_prefix_keeps_empty_tokens(spark):
    got = spark_counts(spark, TEXTS, "")
    assert got == python_counts(TEXTS, "")
    assert got[""] == 1  # the double space inside line 2


def test_prefix_counts_on_lines(spark):
    lines = spark.createDataFrame([("#x #y",), ("#x",)], "value string")
    got = {r["token"]: r["n"] for r in tokens.prefix_counts(lines, "#").collect()}
    assert got == {"#x": 2, "#y": 1}


_alphabet = st.sampled_from(list("ab#") + [" ", "\t", "\n", "\r", "\u00a0", "\u2003", "\u3000"])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(_alphabet, max_size=12), min_size=1, max_size=5))
def test_strip_split_property(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = collections.Counter(
        r["token"] for r in tokens.tokenize(tokens.lines_of(df, "text")).collect()
    )
    want = collections.Counter(tok for t in texts for line in python_lines(t) for tok in line.strip().split(" "))
    assert got == want


def test_column_functions(spark):
    df = spark.createDataFrame([("  a b \t",)], "s string")
    row = df.select(py_strip("s").alias("p"), split_on_space(py_strip("s")).alias("t"),
                    split_lines(F.lit("x\r\ny\n")).alias("l")).first()
    assert row["p"] == "a b"
    assert row["t"] == ["a", "b"]
    assert row["l"] == ["x", "y"]


def _counts(spark, d):
    return spark.createDataFrame(list(d.items()), "token string, n long")


def test_count_change_left_and_full(spark):
    left, right = _counts(spark, {"x": 5, "z": 1}), _counts(spark, {"y": 2, "z": 4})
    got_left = {r["token"]: r["diff"] for r in tokens.count_change(left, right, "token", "left").collect()}
    got_full = {r["token"]: r["diff"] for r in tokens.count_change(left, right, "token", "full").collect()}
    assert got_left == {"x": 5, "z": -3}
    assert got_full == {"x": 5, "z": -3, "y": -2}


def test_count_change_of_rows_equals_join_form(spark):
    rows_l = spark.createDataFrame([("x",)] * 5 + [("z",)], "token string")
    rows_r = spark.createDataFrame([("y",)] * 2 + [("z",)] * 4, "token string")
    for how in ("left", "full", "inner", "right"):
        a = sorted(tuple(r) for r in tokens.count_change_of_rows(rows_l, rows_r, "token", how).collect())
        lc, rc = tokens.count_by_key(rows_l, "token"), tokens.count_by_key(rows_r, "token")
        b = sorted(tuple(r) for r in tokens.count_change(lc, rc, "token", how).collect())
        assert a == b, how


def test_top_k_ties_broken_by_key(spark):
    df = _counts(spark, {"y": 3, "x": 3, "z": 1})
    assert [r["token"] for r in tokens.top_k(df, 1).collect()] == ["x"]
    assert [r["token"] for r in tokens.rank(df).collect()] == ["x", "y", "z"]


def test_day_counts_do_not_depend_on_session_time_zone(spark):
    from conftest import SF_SMALL
    from quarry.plans.token_plans import count_change_full

    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        utc = sorted(map(tuple, count_change_full(spark, SF_SMALL).collect()))
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        la = sorted(map(tuple, count_change_full(spark, SF_SMALL).collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert utc == la and len(utc) > 0
