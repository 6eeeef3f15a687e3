"""Property tests against plain-Python brute force on generated inputs."""

import collections
import itertools

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quarry.operators import baskets as bk
from quarry.operators import itemsets, outliers

_items = st.sampled_from([f"i{j}" for j in range(8)])
_baskets = st.lists(st.lists(_items, min_size=1, max_size=6), min_size=1, max_size=40)


def _brute(data, size, t):
    c = collections.Counter()
    for b in data:
        for combo in itertools.combinations(sorted(set(b)), size):
            c[combo] += 1
    return {k: v for k, v in c.items() if v > t}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(_baskets, st.integers(min_value=0, max_value=4))
def test_frequent_sets_equal_brute_force(spark, data, t):
    df = bk.to_items(spark.createDataFrame([("-".join(b),) for b in data], "items_str string"))
    pairs = {(r.item_1, r.item_2): r.n for r in itemsets.frequent_pairs(df, threshold=t).collect()}
    assert pairs == _brute(data, 2, t)
    triples = {
        (r.item_1, r.item_2, r.item_3): r.n
        for r in itemsets.frequent_triples(df, threshold=t).collect()
    }
    assert triples == _brute(data, 3, t)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(min_value=1, max_value=12), min_size=1, max_size=60), st.integers(min_value=1, max_value=4))
def test_rarity_cut_equals_brute_force(spark, sizes, mgc):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "id long, size int")
    counts = collections.Counter(s for s in sizes if s >= 2)
    common = [s for s, c in counts.items() if c >= mgc]
    cut = max(common) if common else None
    assert outliers.rarity_cut_frame(df, "size", mgc).first()["cut"] == cut
    extreme, kept = outliers.split_by_rarity(df, "size", mgc)
    want_extreme = sorted(s for s in sizes if cut is not None and s > cut)
    want_kept = sorted(s for s in sizes if s >= 2 and (cut is None or s <= cut))
    assert sorted(r["size"] for r in extreme.collect()) == want_extreme
    assert sorted(r["size"] for r in kept.collect()) == want_kept
