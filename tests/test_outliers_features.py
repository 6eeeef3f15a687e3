"""Outlier cuts (Q12) and one-hot features (Q13, Q14)."""

from pyspark.sql import functions as F

from quarry.operators import baskets as bk
from quarry.operators import features, outliers


def sizes_df(spark, sizes):
    return spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "id long, size int")


def test_rarity_cut_and_split(spark):
    df = sizes_df(spark, [1, 1, 2, 2, 3, 3, 3, 5, 9])
    assert outliers.rarity_cut_frame(df, "size").first()["cut"] == 3
    extreme, kept = outliers.split_by_rarity(df, "size")
    assert sorted(r["size"] for r in extreme.collect()) == [5, 9]
    assert sorted(r["size"] for r in kept.collect()) == [2, 2, 3, 3, 3]
    hist = {r["size"]: r["n"] for r in outliers.size_histogram(df, "size").collect()}
    assert hist == {2: 2, 3: 3, 5: 1, 9: 1}


def test_min_group_count(spark):
    df = sizes_df(spark, [2, 2, 2, 3, 3, 4])
    assert outliers.rarity_cut_frame(df, "size", min_group_count=3).first()["cut"] == 2
    extreme, _ = outliers.split_by_rarity(df, "size", min_group_count=3)
    assert sorted(r["size"] for r in extreme.collect()) == [3, 3, 4]


def test_all_unique_sizes_means_no_cut(spark):
    # Micro-fixture "all_unique_sizes": no size shared -> null cut, no extremes.
    df = sizes_df(spark, [2, 3, 4])
    assert outliers.rarity_cut_frame(df, "size").first()["cut"] is None
    extreme, kept = outliers.split_by_rarity(df, "size")
    assert extreme.count() == 0
    assert kept.count() == 3


def test_fixed_cut(spark):
    df = sizes_df(spark, [1, 2, 1000, 1001])
    extreme, kept = outliers.split_by_value(df, "size", 1000)
    assert [r["size"] for r in extreme.collect()] == [1001]
    assert sorted(r["size"] for r in kept.collect()) == [2, 1000]


def test_cut_is_a_scalar_subquery_not_a_join(spark):
    df = sizes_df(spark, [2, 2, 3])
    extreme, _ = outliers.split_by_rarity(df, "size")
    plan = extreme._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def basket_df(spark):
    rows = ["p1-p2", "p1", "p2-p3", "p1-p3-p4", "p1-p2-p3"]
    return bk.to_items(spark.createDataFrame([(i, s) for i, s in enumerate(rows)], "id long, items_str string"))


def test_one_hot_sums_equal_item_counts(spark):
    df = basket_df(spark)
    vocab = features.top_k_vocabulary(df, 3)
    assert vocab == ["p1", "p2", "p3"]
    names = features.feature_names(vocab)
    oh = features.one_hot(df, vocab, "items", names)
    sums = oh.agg(*[F.sum(F.col(n).cast("int")).alias(n) for n in names]).first().asDict()
    counts = {r["item"]: r["n"] for r in bk.item_counts(df).collect()}
    assert sums == {f"Port{v}": counts[v] for v in vocab}


def test_one_hot_is_one_projection(spark):
    df = basket_df(spark)
    vocab = [f"x{i}" for i in range(200)]
    oh = features.one_hot(df, vocab)
    optimized = oh._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("Project [") <= 2


def test_sparse_one_hot_matches_columns(spark):
    df = basket_df(spark)
    vocab = ["p1", "p2", "p3"]
    sp = features.sparse_one_hot(df, vocab, "items", "v").orderBy("id").collect()
    dense = features.one_hot(df, vocab, "items", ["a", "b", "c"]).orderBy("id").collect()
    for s, d in zip(sp, dense):
        assert list(s["v"].toArray()) == [float(d["a"]), float(d["b"]), float(d["c"])]


def test_pca_variance_decreasing(spark):
    df = basket_df(spark)
    vocab = ["p1", "p2", "p3", "p4"]
    data = features.assemble(features.one_hot(df, vocab, "items", vocab), vocab)
    model, projected = features.reduce_pca(data, 2)
    var = [v for _, v in features.explained_variance(model)]
    assert var == sorted(var, reverse=True)
    assert sum(var) <= 1.0 + 1e-9
    assert projected.count() == 5


def test_one_hot_of_six_hundred_items(spark):
    vocab = ["p1", *(f"x{i}" for i in range(599))]
    row = features.one_hot(basket_df(spark), vocab).where("id = 0").first().asDict()
    assert row["Portp1"] and not any(row[f"Portx{i}"] for i in range(599))


def test_ranked_one_hot_keeps_rows_that_share_a_key(spark):
    df = spark.createDataFrame([(1, ["a"]), (1, ["b"]), (2, None), (2, ["a", "c"])], "k long, items array<string>")
    got = features.one_hot_by_rank(df, "k", 2)
    assert sorted(map(tuple, got.collect())) == [(1, False, True), (1, True, False), (2, False, False), (2, True, False)]
    wide = features.one_hot_by_rank(df, "k", 5).where("k = 1").first()
    assert not wide.f04 and not wide.f05  # fewer items than k


def test_pca_projection_is_not_centred(spark):
    # Q18: Spark projects raw rows on the principal axes (no mean removal).
    import numpy as np

    df = basket_df(spark)
    vocab = ["p1", "p2", "p3", "p4"]
    data = features.assemble(features.one_hot(df, vocab, "items", vocab), vocab)
    model, projected = features.reduce_pca(data, 2)
    axes = model.pc.toArray()
    for r in projected.collect():
        x = r["features"].toArray()
        assert np.allclose(r["pca_features"].toArray(), x @ axes)
