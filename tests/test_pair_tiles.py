"""Pairs and triples of wide baskets, counted in tiles and by first items."""

import os
import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import DataFrame, GroupedData

from quarry.operators import bitmaps, item_chunks, itemsets, pair_tiles
from quarry.session import ensure_checkpoint_dir


def wide_baskets(seed, n, words=90, most=70):
    rng = random.Random(seed)
    rows = [([rng.choice([f"w{int(words * rng.random() ** 2)}", None, "ẞ", "W1"]) if rng.random() < 0.1 else f"w{int(words * rng.random() ** 2)}" for _ in range(rng.randint(0, most))],) for _ in range(n)]
    return [*rows, (None,), ([],), (["w1"],), ([None, None],), (["w1", "w2", "w2"],)]


def brute(rows, size, threshold):
    n = Counter()
    for (items,) in rows:
        n.update(combinations(sorted({x for x in items or [] if x is not None}), size))
    return {k: v for k, v in n.items() if v > threshold}


def sets(df):
    return {tuple(r)[:-1]: r.n for r in df.collect()}


@pytest.mark.parametrize("groups", [1, 3, 14])
def test_pairs_in_tiles_against_brute_force(spark, monkeypatch, groups):
    monkeypatch.setattr(pair_tiles, "GROUPS", groups)
    monkeypatch.setattr(itemsets, "EMITTED", 4)
    rows = wide_baskets(groups, 300)
    df = spark.createDataFrame(rows, "items array<string>").repartition(4)
    want = brute(rows, 2, 25)
    assert want and sets(itemsets.frequent_pairs(df, threshold=25)) == want
    assert sets(bitmaps.frequent_pairs(df, threshold=25)) == want
    assert sets(itemsets.frequent_pairs(df, min_support="0.1")) == sets(bitmaps.frequent_pairs(df, min_support="0.1")) == brute(rows, 2, 30)


def test_tiles_narrower_than_the_items(spark, monkeypatch):
    monkeypatch.setattr(pair_tiles, "WIDTH", 4)
    rows = [([x for x in range(50) if rng.random() < 0.5],) for rng in (random.Random(i) for i in range(120))]
    df = spark.createDataFrame(rows, "items array<int>")
    monkeypatch.setattr(itemsets, "EMITTED", 1)
    want = brute(rows, 2, 30)
    assert want and sets(itemsets.frequent_pairs(df, threshold=30)) == sets(bitmaps.frequent_pairs(df, threshold=30)) == want


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_whole_groups(monkeypatch):
    def refused(self, *_):
        raise AssertionError("a task would hold a whole group")

    monkeypatch.setattr(GroupedData, "applyInArrow", refused)


def test_wide_baskets_emit_no_pairs(spark):
    """a row for each pair of a basket filled the disk."""
    df = spark.createDataFrame([([f"w{i}" for i in range(100)],)] * 5, "items array<string>")
    pairs = itemsets.frequent_pairs(df, threshold=4)
    assert "Generate" not in plan(pairs) and pairs.count() == 4950
    narrow = itemsets.frequent_pairs(df.selectExpr("slice(items, 1, 4) items"), threshold=4)
    assert "Generate" in plan(narrow) and narrow.count() == 6


def test_no_task_holds_all_items_of_a_block(spark, no_whole_groups):
    """a task held a block's bitmaps of all items and a row for each pair in it."""
    rows = wide_baskets(5, 50)
    df = spark.createDataFrame(rows, "items array<string>")
    assert sets(bitmaps.frequent_pairs(df, threshold=3)) == brute(rows, 2, 3)


@pytest.mark.parametrize("groups", [1, 5, 48])
def test_triples_by_first_item_against_brute_force(spark, monkeypatch, no_whole_groups, groups):
    """few tasks, one for each block of baskets, counted all triples."""
    monkeypatch.setattr(bitmaps, "_GROUPS", groups)
    rows = wide_baskets(7, 150, words=40, most=40)
    df = spark.createDataFrame(rows, "items array<string>").repartition(3)
    want = brute(rows, 3, 20)
    assert want and sets(bitmaps.frequent_triples(df, threshold=20)) == want


def test_counts_of_a_product_by_stretches(monkeypatch):
    import numpy as np

    monkeypatch.setattr(bitmaps, "_CELLS", 40)
    monkeypatch.setattr(bitmaps, "_COUNTS", 30)
    monkeypatch.setattr(bitmaps, "_SLICE", 16)
    rng = random.Random(3)
    rows = [sorted(rng.sample(range(1, 21), rng.randint(1, 15))) for _ in range(60)]
    items, ends = np.array([x for r in rows for x in r], dtype="<u4"), np.cumsum([len(r) for r in rows])
    partners = np.array([2, 3, 5, 8, 9, 13, 20])
    want = {k: v for k, v in brute([([x for x in r if x in partners],) for r in rows], 2, 8).items()}
    found = bitmaps._held_with(items, ends - [len(r) for r in rows], ends, partners, 20, 8)
    assert {(b, c): n for part in found for b, c, n in zip(*(x.tolist() for x in part))} == want


def test_triples_need_no_pair_table(spark, monkeypatch):
    """all pairs were counted first in their table."""
    def refused(*_, **__):
        raise AssertionError("the pair table was counted")

    monkeypatch.setattr(pair_tiles, "frequent_pairs", refused)
    monkeypatch.setattr(bitmaps, "_SLICE", 64)
    rows = wide_baskets(11, 150, words=40, most=40)
    df = spark.createDataFrame([*rows, *[(["z"],)] * 30], "items array<string>").repartition(3)
    want = brute(rows, 3, 20)
    assert want and sets(bitmaps.frequent_triples(df, threshold=20)) == want
    assert sets(bitmaps.frequent_triples(df, min_support="0.1")) == brute(rows, 3, 18)
    assert sets(bitmaps.frequent_triples(df, threshold=200)) == {}


def tables(spark):
    return set(os.listdir(f"{ensure_checkpoint_dir(spark).removeprefix('file:')}/tables"))


@pytest.fixture()
def one_copy(spark, monkeypatch):
    """No copy of the baskets for each tile or group in a shuffle, and none left in the shared folder."""
    def refused(*_):
        raise AssertionError("the baskets are shuffled for each task")

    monkeypatch.setattr(DataFrame, "repartitionById", refused)
    spark.createDataFrame([(1,)], "n int").write.mode("overwrite").parquet(f"{ensure_checkpoint_dir(spark)}/tables/any")
    before = tables(spark)
    return lambda: {x.rpartition("-")[0] for x in tables(spark) - before}


def test_bitmap_pairs_keep_one_copy_of_the_baskets(spark, monkeypatch, one_copy):
    """r04 F2: baskets went through a shuffle once for each group of items, and all tables stayed."""
    monkeypatch.setattr(pair_tiles, "_LEAST", 1)
    rows = wide_baskets(21, 200)
    df = spark.createDataFrame(rows, "items array<string>").repartition(4)
    want = brute(rows, 2, 20)
    assert want and sets(bitmaps.frequent_pairs(df, threshold=20)) == want
    assert one_copy() == {"frequent-pairs"}


def test_tiles_of_several_blocks_in_several_jobs(spark, monkeypatch):
    monkeypatch.setattr(pair_tiles, "_LEAST", 1)
    monkeypatch.setattr(pair_tiles, "GROUPS", 5)
    monkeypatch.setattr(pair_tiles, "_TILES", 7)
    monkeypatch.setattr(item_chunks, "_BROADCAST", 0)
    rows = [([{"x": x % 7, "y": str(x)} for x in rng.sample(range(40), 20)],) for rng in (random.Random(i) for i in range(90))]
    df = spark.createDataFrame(rows, "items array<struct<x:int,y:string>>")
    want = brute([([(i["x"], i["y"]) for i in r[0]],) for r in rows], 2, 22)
    assert want and sets(bitmaps.frequent_pairs(df, threshold=22)) == want


@pytest.mark.parametrize("bitmap", [False, True])
def test_pairs_of_a_tile_by_stretches(monkeypatch, bitmap):
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(pair_tiles, "_HELD", 50)
    monkeypatch.setattr(pair_tiles, "_AT_ONCE", 16)
    rng = random.Random(5)
    rows = [sorted(x for x in range(24) if rng.random() < (0.9 if x % 5 == 0 else 0.04 if x % 5 == 1 else 0.3)) for _ in range(300)]
    held = [pair_tiles._Block(), pair_tiles._Block()]
    for own, k in zip(held, (0, 1), strict=True):
        own.names = pa.array([str(x) for x in range(k, 24, 2)])
        for chunk, at in ((3, 200), (1, 0), (2, 100)):
            some = [[x // 2 for x in r if x % 2 == k] for r in rows[at : at + 100]]
            own.add(chunk, np.array([len(x) for x in some], dtype="<u2"), np.array([x for r in some for x in r], dtype="<u2"))
    want = brute([(r,) for r in rows], 2, 9)
    got = {}
    for i, j in ((0, 0), (0, 1), (1, 1)):
        for part in pair_tiles._tile(held[i], held[j], 9, bitmap):
            got |= {tuple(sorted((2 * a + i, 2 * b + j))): n for a, b, n in zip(*(x.tolist() for x in part), strict=True)}
    assert got == want


def test_pairs_keep_one_copy_of_the_baskets(spark, monkeypatch, one_copy):
    """r04 F3: wide baskets were stored three times on the way and all copies stayed."""
    monkeypatch.setattr(pair_tiles, "_LEAST", 1)
    monkeypatch.setattr(itemsets, "EMITTED", 4)
    rows = wide_baskets(22, 200)
    df = spark.createDataFrame(rows, "items array<string>").repartition(4)
    want = brute(rows, 2, 20)
    assert want and sets(itemsets.frequent_pairs(df, threshold=20)) == want
    assert one_copy() == {"frequent-pairs"}


def test_triples_keep_one_copy_of_the_baskets(spark, monkeypatch, one_copy):
    """r04 F1: baskets went through a shuffle once for each group of first items, and all tables stayed."""
    monkeypatch.setattr(bitmaps, "_GROUPS", 6)
    rows = wide_baskets(23, 150, words=40, most=40)
    df = spark.createDataFrame(rows, "items array<string>").repartition(3)
    want = brute(rows, 3, 20)
    assert want and sets(bitmaps.frequent_triples(df, threshold=20)) == want
    assert one_copy() == {"frequent-triples"}


def test_baskets_of_a_group_from_its_first_item():
    import numpy as np

    rows = [[1, 4, 6, 7, 9], [2, 5], [3, 4, 8], [], [3, 6, 7], [7], [1, 2, 5, 10, 11]]
    sizes, items = np.array([len(r) for r in rows], dtype="<u4"), np.array([x for r in rows for x in r], dtype="<u2")
    left, held = bitmaps._from_first(3, 1, sizes, items)
    assert left.tolist() == [5, 5] and held.tolist() == [1, 4, 6, 7, 9, 1, 2, 5, 10, 11]
    left, held = bitmaps._from_first(3, 0, sizes, items)
    assert left.tolist() == [3, 3, 3] and held.tolist() == [6, 7, 9, 3, 4, 8, 3, 6, 7]
