"""Heavy hitters, united sketches, unkeyed split, causes of missing cells."""

import random
from collections import Counter

from pyspark.sql import functions as F

from quarry.operators import baskets, classify, summaries
from quarry.sources import readers


def wide(spark, n=3000, seed=1):
    rng = random.Random(seed)
    rows = [([f"hot{min(int(rng.expovariate(0.4)), 9)}", f"rare{rng.randrange(5000)}", None],) for _ in range(n)] + [(None,), ([],)]
    return spark.createDataFrame(rows, "items array<string>").repartition(4)


def test_heavy_hitters_are_the_top_items(spark, monkeypatch):
    df = wide(spark)
    want = [tuple(r) for r in baskets.top_k_items(df, 5).collect()]
    full = []
    count = summaries.item_counts
    monkeypatch.setattr(summaries, "item_counts", lambda *a: full.append(1) or count(*a))
    assert [tuple(r) for r in summaries.heavy_hitters(df, 5, counters=50).collect()] == want
    assert not full


def test_heavy_hitters_count_all_items_where_the_bound_fails(spark, monkeypatch):
    df = wide(spark)
    full = []
    count = summaries.item_counts
    monkeypatch.setattr(summaries, "item_counts", lambda *a: full.append(1) or count(*a))
    for k, counters in ((40, 12), (3, 1)):
        full.clear()
        want = [tuple(r) for r in baskets.top_k_items(df, k).collect()]
        assert [tuple(r) for r in summaries.heavy_hitters(df, k, counters=counters).collect()] == want
        assert full
    few = spark.createDataFrame([(["a"],), (["a", "b"],)], "items array<string>")
    assert [tuple(r) for r in summaries.heavy_hitters(few, 5).collect()] == [("a", 2), ("b", 1)]
    assert summaries.heavy_hitters(few.limit(0), 5).collect() == []


def test_sketches_of_periods_unite(spark):
    df = spark.range(30_000).select((F.col("id") % 6).alias("day"), (F.col("id") % 7000).alias("user"))
    days = summaries.distinct_sketches(df, "day", "user")
    assert days.count() == 6
    for some, exact in (("day < 6", 7000), ("day < 2", df.where("day < 2").select("user").distinct().count()), ("day > 9", 0)):
        assert abs(summaries.united_distinct(days.where(some)).first()[0] - exact) <= 0.05 * exact


def test_unkeyed_split_stays_and_splits_equal_rows(spark):
    df = spark.range(4000).select(F.lit("same").alias("v"), F.lit(1).alias("_row"))
    split = classify.unkeyed_split(df)
    first = Counter(r.split for r in split.collect())
    assert sum(first.values()) == 4000 and 2800 < first["train"] < 3200
    assert Counter(r.split for r in split.repartition(3).collect()) == first
    assert split.columns == ["v", "_row", "split"]
    assert Counter(r.split for r in classify.unkeyed_split(df).collect()) == first  # the same input in the same parts


def test_causes_of_missing_cells(spark, scratch):
    path = f"{scratch}/cells.csv"
    with open(path, "w") as file:
        file.write("a,b,c\n1,2,x\n?,,y\n99999999999,1.5,z\n 7 ,abc,\n1\n")
    got = {(r["column"], r["cause"]): r.n for r in readers.missing_causes(spark, path, "a int, b double, c string").collect()}
    assert got == {("a", "marker"): 1, ("a", "overflow"): 1, ("a", "unparseable"): 1, ("b", "empty"): 1, ("b", "unparseable"): 1, ("b", "absent"): 1}
    typed = readers.read_table(spark, path, "a int, b double, c string")
    assert typed.where("a is null").count() == 3 and typed.where("b is null").count() == 3
