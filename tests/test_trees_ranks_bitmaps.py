"""Nested tree grids, saved trees, places, bitmap item sets, vector profiles and sketched components."""

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from quarry.operators import bitmaps, classify, clusters, features, itemsets, ranks, sketch_pca, trees


def labelled_rows(spark, n=400, seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x = [rng.randrange(0, 12) for _ in range(4)]
        cls = "a" if x[0] + x[1] > 11 else "b" if x[2] > 6 else "c"
        rows.append((i, *x, cls if rng.random() < 0.85 else rng.choice("abc")))
    rows += [(n + 1, 1, 1, 1, 1, None), (n + 2, None, 1, 1, 1, "a"), (None, 1, 2, 3, 4, "b")]
    return spark.createDataFrame(rows, "id int, x1 int, x2 int, x3 int, x4 int, class string")


COLS = ["x1", "x2", "x3", "x4"]


def test_nested_grid_is_the_grid_of_single_fits(spark, monkeypatch):
    data = labelled_rows(spark)
    want = {r.grid_index: r for r in classify.tree_grid(data, COLS, "class", "id").collect()}
    fits = []
    fit = DecisionTreeClassifier.fit
    monkeypatch.setattr(DecisionTreeClassifier, "fit", lambda self, *a: fits.append(1) or fit(self, *a))
    got = {r.grid_index: r for r in trees.nested_grid(data, COLS, "class", "id").collect()}
    assert len(fits) == 5 and len(got) == len(want) == 50
    for i, r in want.items():
        assert (r.max_depth, r.min_instances_per_node, r.is_best) == (got[i].max_depth, got[i].min_instances_per_node, got[i].is_best)
        assert got[i].train_f1 == pytest.approx(r.train_f1, abs=1e-12) and got[i].test_f1 == pytest.approx(r.test_f1, abs=1e-12)


def test_nodes_read_back_walk_like_the_model(spark):
    data = features.assemble(labelled_rows(spark).dropna().withColumn("y", (F.col("class") == "a").cast("double")), COLS)
    model = DecisionTreeClassifier(labelCol="y", maxDepth=4).fit(data)
    nodes = trees.tree_nodes(model, spark)
    held = nodes.collect()
    assert len(held) == model.numNodes and sorted(r.id for r in held) == list(range(model.numNodes))
    rows = model.transform(data).select(F.col("prediction").alias("label"), F.lit(0).alias("test"), F.array(*(F.col(c).cast("double") for c in COLS)).alias("x"))
    for r in trees.predictions_by_depth(rows, [nodes], 4).collect():
        assert r.predictions[3] == r.label


def test_saved_tree_predicts_rows_with_unseen_and_null_labels(spark):
    data = labelled_rows(spark)
    folder = trees.fit_and_save(data.where("id < 300 and class <> 'c'").dropna(), COLS, "class", max_depth=3)
    later = spark.createDataFrame([(1, 11, 11, 0, 0, "zebra"), (2, 0, 0, 11, 0, None)], "id int, x1 int, x2 int, x3 int, x4 int, class string")
    got = {r.id: r for r in trees.apply_saved(folder, later).collect()}
    assert got[1].predictedClass == "a" and got[2].predictedClass == "b" and got[1]["class"] == "zebra"
    assert trees.apply_saved(folder, later).columns == [*later.columns, "predictedClass"]


@pytest.mark.parametrize("n", [0, 1, 500])
def test_places_number_every_row_in_order(spark, n):
    rng = random.Random(n)
    rows = [(rng.choice([None, 1, 1, 1, 2, rng.randrange(100)]), rng.choice("xyz"), i) for i in range(n)]
    df = spark.createDataFrame(rows, "a int, place string, i int").repartition(7)
    got = ranks.with_places(df, F.col("a").desc(), F.col("i").asc(), out="rank").collect()
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[2]))  # nulls last in descending order
    assert [(r.a, r.place, r.i) for r in sorted(got, key=lambda r: r["rank"])] == want
    assert sorted(r["rank"] for r in got) == list(range(1, n + 1))


def test_equal_rows_are_spread_over_ranges_and_keep_their_places(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("v"))
    out = ranks.with_places(df, F.col("v"), partitions=8)
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
    assert Counter(r.n for r in out.groupBy("place").agg(F.count(F.lit(1)).alias("n")).collect()) == {1: 20_000}
    firsts = out.where("v = -1").agg(F.min("place").alias("a"), F.max("place").alias("b")).first()
    assert (firsts.a, firsts.b) == (1, 13_333)


def word_baskets(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    rows = []
    for _ in range(n):
        items = rng.choices(words, weights=[1 / (i + 1) for i in range(40)], k=rng.randrange(0, 30))
        rows.append((rng.choice([items, items, items, [*items, None], items + items, [*items, "the"]]),))
    return rows + [(None,), ([],), (["the"],), ([None],)]


def counted_sets(rows, size, threshold):
    n = Counter()
    for (items,) in rows:
        n.update(combinations(sorted({x for x in items or [] if x is not None}), size))
    return {k: v for k, v in n.items() if v > threshold}


def test_bitmap_sets_against_brute_force(spark):
    rows = word_baskets(1, 600)
    df = spark.createDataFrame(rows, "items array<string>").repartition(3)
    pairs = {(r.item_1, r.item_2): r.n for r in bitmaps.frequent_pairs(df, threshold=40).collect()}
    triples = {(r.item_1, r.item_2, r.item_3): r.n for r in bitmaps.frequent_triples(df, threshold=25).collect()}
    assert pairs == counted_sets(rows, 2, 40) and triples == counted_sets(rows, 3, 25)
    assert pairs and triples
    old = {(r.item_1, r.item_2, r.item_3): r.n for r in itemsets.frequent_triples(df, min_support="0.05").collect()}
    assert {(r.item_1, r.item_2, r.item_3): r.n for r in bitmaps.frequent_triples(df, min_support="0.05").collect()} == old


def test_bitmap_sets_over_several_blocks_and_none(spark):
    many = spark.range(0, 100_000, 1, 1).select(
        F.filter(F.array(*(F.when(F.col("id") % m == 0, F.lit(f"m{m}")) for m in (2, 3, 5, 7))), lambda x: x.isNotNull()).alias("items")
    )
    got = {(r.item_1, r.item_2, r.item_3): r.n for r in bitmaps.frequent_triples(many, threshold=1000).collect()}
    assert got == {("m2", "m3", "m5"): 3334, ("m2", "m3", "m7"): 2381, ("m2", "m5", "m7"): 1429}
    assert bitmaps.frequent_triples(many.limit(0), threshold=1).collect() == []
    assert bitmaps.frequent_pairs(many, threshold=90_000).collect() == []


def test_vector_profile_is_the_profile_of_columns(spark):
    rng = random.Random(4)
    names = [f"f{i}" for i in range(30)]
    rows = [(rng.choice(["a", "b", None]), [float(rng.random() < 0.2) for _ in names]) for _ in range(200)]
    df = spark.createDataFrame([(g, Vectors.sparse(30, [(i, x) for i, x in enumerate(v) if x])) for g, v in rows] + [("a", None)], ["g", "features"])
    got = {(r.g, r.feature): (r["size"], r["mean"]) for r in clusters.vector_profile(df, "g", names, digits=9).collect()}
    assert len(got) == 90
    for g in ("a", "b", None):
        mine = [v for h, v in rows if h == g]
        for i, name in enumerate(names):
            assert got[g, name] == (len(mine), pytest.approx(sum(v[i] for v in mine) / len(mine), abs=1e-8))


def test_profile_of_clusters_in_a_sparse_space_is_their_centres(spark):
    rng = np.random.default_rng(6)
    rows = [(Vectors.sparse(3000, sorted(rng.choice(3000, 15, replace=False).tolist()), [1.0] * 15),) for _ in range(300)]
    df = spark.createDataFrame(rows, ["features"])
    model = clusters.fit_kmeans(df, 4)
    pred = clusters.assign(model, df).persist()
    names = [f"f{i}" for i in range(3000)]
    got = {(r.prediction, r.feature): r["mean"] for r in clusters.vector_profile(pred, "prediction", names).collect()}
    v = np.stack([r.features.toArray() for r in pred.collect()])
    label = np.array([r.prediction for r in pred.collect()])
    for c in set(label.tolist()):
        np.testing.assert_allclose([got[c, n] for n in names], v[label == c].mean(axis=0), atol=1e-12)


def test_sketched_components_are_those_of_pca(spark):
    rng = np.random.default_rng(7)
    p = rng.random(200) * 0.5
    rows = [(Vectors.dense((rng.random(200) < p).astype(float)),) for _ in range(600)]
    df = spark.createDataFrame(rows, ["features"]).repartition(5)
    model, _ = features.reduce_pca(df, 100)
    axes, shares = sketch_pca.randomised_pca(df, 100)
    np.testing.assert_allclose(shares, model.explainedVariance.toArray(), atol=1e-6)
    np.testing.assert_allclose(np.abs((axes * model.pc.toArray()).sum(axis=0))[:20], 1, atol=1e-6)
    np.testing.assert_allclose(axes.T @ axes, np.eye(100), atol=1e-9)


def test_sketched_components_of_20000_sparse_dimensions(spark):
    rng = np.random.default_rng(8)
    held = [np.unique(np.concatenate([rng.choice(20_000, 30), 50 * (i % 5) + rng.choice(50, 25)])) for i in range(400)]
    df = spark.createDataFrame([(Vectors.sparse(20_000, h.tolist(), [1.0] * len(h)),) for h in held], ["features"]).repartition(4)
    axes, shares = sketch_pca.randomised_pca(df, 4, oversample=30, rounds=6)
    dense = np.zeros((400, 20_000), dtype=np.float32)
    for i, h in enumerate(held):
        dense[i, h] = 1
    dense -= dense.mean(axis=0)
    values = np.linalg.eigvalsh(dense @ dense.T)[::-1].astype(float)
    np.testing.assert_allclose(shares, values[:4] / values.sum(), rtol=1e-3)
    assert axes.shape == (20_000, 4)


def test_sketched_components_of_few_or_no_rows(spark):
    assert sketch_pca.randomised_pca(features.assemble(spark.createDataFrame([], "a double"), ["a"]), 2)[1].shape == (0,)
    two = spark.createDataFrame([(Vectors.dense([1.0, 2.0, 3.0]),), (Vectors.dense([1.0, 2.0, 5.0]),)], ["features"])
    axes, shares = sketch_pca.randomised_pca(two, 5)
    np.testing.assert_allclose(shares, [1.0, 0.0], atol=1e-12)
    np.testing.assert_allclose(np.abs(axes[:, 0]), [0, 0, 1], atol=1e-12)
