"""Basket operators and frequent sets against brute force (Q1, Q6, Q15)."""

import collections
import itertools
import random

from pyspark.sql import functions as F

from quarry.operators import baskets as bk
from quarry.operators import itemsets

# Micro-fixture "baskets_small" (FIXTURES section 4).
SMALL = ["a-b", "a-b-c", "a", "a-a-b"]


def small(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(SMALL)], "basket_id long, items_str string")
    return bk.to_items(df)


def brute(baskets, size, threshold):
    c = collections.Counter()
    for b in baskets:
        for combo in itertools.combinations(sorted(set(b)), size):
            c[combo] += 1
    return {k: v for k, v in c.items() if v > threshold}


def test_items_are_deduplicated(spark):
    got = {r["item"]: r["n"] for r in bk.item_counts(small(spark)).collect()}
    assert got == {"a": 4, "b": 3, "c": 1}
    assert bk.distinct_item_count(small(spark)).first()["n_items"] == 3


def test_membership_and_multi_item(spark):
    df = small(spark)
    assert bk.containing_all(df, ["a", "b"]).count() == 3
    assert bk.containing_all(df, ["c", "b"]).count() == 1
    assert bk.multi_item(df).count() == 3


def test_small_pairs_and_triples(spark):
    df = small(spark)
    pairs = {(r.item_1, r.item_2): r.n for r in itemsets.frequent_pairs(df, threshold=1).collect()}
    assert pairs == {("a", "b"): 3}
    triples = {(r.item_1, r.item_2, r.item_3): r.n for r in itemsets.frequent_triples(df, threshold=0).collect()}
    assert triples == {("a", "b", "c"): 1}


def test_threshold_is_strict(spark):
    df = small(spark)
    assert bk.frequent_items(df, threshold=3).count() == 1  # only a (4); b has exactly 3
    assert {r.item for r in bk.frequent_items(df, min_support=0.5).collect()} == {"a", "b"}


def random_baskets(seed, n, n_items, max_size):
    rng = random.Random(seed)
    items = [f"i{j:02d}" for j in range(n_items)]
    weights = [1.0 / (j + 1) for j in range(n_items)]
    out = []
    for _ in range(n):
        k = rng.randint(1, max_size)
        out.append(rng.choices(items, weights, k=k))
    return out


def test_pairs_and_triples_match_brute_force(spark):
    data = random_baskets(7, 400, 12, 9)
    df = spark.createDataFrame([("-".join(b),) for b in data], "items_str string").repartition(5)
    df = bk.to_items(df)
    t = 12
    got2 = {(r.item_1, r.item_2): r.n for r in itemsets.frequent_pairs(df, threshold=t).collect()}
    assert got2 == brute(data, 2, t)
    got3 = {
        (r.item_1, r.item_2, r.item_3): r.n
        for r in itemsets.frequent_triples(df, threshold=t).collect()
    }
    assert got3 == brute(data, 3, t)
    assert len(got3) > 0


def test_support_threshold_matches_absolute(spark):
    data = random_baskets(3, 200, 8, 6)
    df = bk.to_items(spark.createDataFrame([("-".join(b),) for b in data], "items_str string"))
    # 0.1 * 200 = 20 exactly: "> 20" in both forms.
    a = sorted(tuple(r) for r in itemsets.frequent_pairs(df, min_support="0.1").collect())
    b = sorted(tuple(r) for r in itemsets.frequent_pairs(df, threshold=20).collect())
    assert a == b


def fpgrowth_sets(df, threshold, n_baskets, max_size=3):
    """Sets of 1..max_size items with count > threshold by Spark ML's FP-growth."""
    from pyspark.ml.fpm import FPGrowth

    fp = FPGrowth(itemsCol="items", minSupport=(threshold + 0.5) / n_baskets, minConfidence=1.0)
    found = fp.fit(df.select(F.array_distinct("items").alias("items"))).freqItemsets
    return found.where(F.size("items") <= max_size).select(F.array_sort("items").alias("items"), F.col("freq").alias("n"))


def test_fpgrowth_cross_check(spark):
    data = random_baskets(11, 300, 10, 7)
    df = bk.to_items(spark.createDataFrame([("-".join(b),) for b in data], "items_str string"))
    t = 15
    fp = {tuple(r["items"]): r["n"] for r in fpgrowth_sets(df, t, len(data)).collect()}
    ours = {(r.item_1, r.item_2): r.n for r in itemsets.frequent_pairs(df, threshold=t).collect()}
    ours.update({(r.item_1, r.item_2, r.item_3): r.n for r in itemsets.frequent_triples(df, threshold=t).collect()})
    assert {k: v for k, v in fp.items() if len(k) >= 2} == ours


def test_null_baskets_are_ignored(spark):
    df = spark.createDataFrame([(["a", "b"],), (None,), (["a", None, "b"],)], "items array<string>")
    got = {(r.item_1, r.item_2): r.n for r in itemsets.frequent_pairs(df, threshold=0).collect()}
    assert got == {("a", "b"): 2}


def test_top_k_and_rank(spark):
    df = small(spark)
    assert [r.item for r in bk.top_k_items(df, 2).collect()] == ["a", "b"]
    items = itemsets.as_item_sets(itemsets.frequent_pairs(df, threshold=0)).where(F.col("n") == 3).first()
    assert list(items["items"]) == ["a", "b"]


def test_skewed_baskets_match_brute_force(spark):
    # One basket holding every item, thousands of identical baskets, and an
    # item present in every basket: the hot cases of a real scanner profile.
    rng = random.Random(5)
    items = [f"p{j:03d}" for j in range(60)]
    data = [items[:]]  # one huge basket
    data += [["p000", "p001", "p002"]] * 3000  # a third of the rows are copies
    data += [["p000"] + rng.sample(items[1:], rng.randint(1, 8)) for _ in range(3000)]
    df = bk.to_items(spark.createDataFrame([("-".join(b),) for b in data], "items_str string").repartition(6))
    t = 40
    got2 = {(r.item_1, r.item_2): r.n for r in itemsets.frequent_pairs(df, threshold=t).collect()}
    assert got2 == brute(data, 2, t)
    got3 = {(r.item_1, r.item_2, r.item_3): r.n for r in itemsets.frequent_triples(df, threshold=t).collect()}
    assert got3 == brute(data, 3, t)


def test_approximate_distinct_count_is_close(spark):
    data = [[f"x{i}", f"x{i + 1}"] for i in range(0, 5000, 2)]
    df = spark.createDataFrame([(b,) for b in data], "items array<string>")
    exact = bk.distinct_item_count(df).first()["n_items"]
    approx = bk.distinct_item_count(df, approx_rsd=0.02).first()["n_items"]
    assert exact == 5000
    assert abs(approx - exact) / exact < 0.08


def test_nothing_frequent_gives_empty_results(spark):
    df = small(spark)
    assert itemsets.frequent_pairs(df, threshold=100).count() == 0
    assert itemsets.frequent_triples(df, threshold=100).count() == 0
    assert itemsets.frequent_pairs(df, threshold=100).columns == ["item_1", "item_2", "n"]


def test_lowest_ranked_frequent_item_forms_pairs(spark):
    # Q1: the reference's loops skip the last frequent item; here it counts.
    data = [["a", "b"]] * 5 + [["a", "c"]] * 3 + [["b", "c"]] * 3 + [["c"]] * 0
    df = bk.to_items(spark.createDataFrame([("-".join(b),) for b in data], "items_str string"))
    singles = {r.item: r.n for r in bk.frequent_items(df, threshold=2).collect()}
    assert min(singles, key=lambda k: (singles[k], k)) == "c"  # lowest-ranked frequent item
    pairs = {(r.item_1, r.item_2): r.n for r in itemsets.frequent_pairs(df, threshold=2).collect()}
    assert pairs == {("a", "b"): 5, ("a", "c"): 3, ("b", "c"): 3}


def test_one_very_wide_basket(spark):
    # 1,500 frequent items in one basket and in two more: over a million pairs, no list on the driver.
    items = [f"w{j:04d}" for j in range(1500)]
    df = spark.createDataFrame([(items,), (items[:1000],), (items[500:],), (["w0001", "x"],)], "items array<string>")
    got = itemsets.frequent_pairs(df, threshold=2)
    assert got.count() == 500 * 499 // 2  # only 500..999 lie in three baskets
    assert itemsets.frequent_pairs(df, threshold=1).agg(F.sum("n")).first()[0] == 2 * 2 * (1000 * 999 // 2) - 500 * 499 // 2


def test_repeated_and_null_items_of_a_basket(spark):
    df = spark.createDataFrame([(["b", "a", "b", None],), (["a", "b"],), ([],), (None,)], "items array<string>")
    assert [tuple(r) for r in itemsets.frequent_pairs(df, threshold=1).collect()] == [("a", "b", 2)]
