"""Clustering and classification: invariants and brute-force checks (Q8-Q11)."""

import random

import numpy as np
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import types as T
from pyspark.sql import functions as F

from quarry.operators import classify, clusters, features
from quarry.sources import driver_tables as dt

from conftest import SF_SMALL


def vschema(*fields):
    types = {"long": T.LongType(), "boolean": T.BooleanType(), "double": T.DoubleType(), "vector": VectorUDT()}
    return T.StructType([T.StructField(n, types[t]) for n, t in (f.split() for f in fields)])


def points(spark, n=60, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        c = i % 3
        rows.append((i, Vectors.dense([c * 5 + rng.random(), rng.random()]), c == 0))
    return spark.createDataFrame(rows, vschema("id long", "features vector", "flag boolean"))


def test_kmeans_invariants(spark):
    df = points(spark)
    model = clusters.fit_kmeans(df, 3, seed=123)
    pred = clusters.assign(model, df)
    sizes = clusters.cluster_sizes(pred)
    assert sum(r["size"] for r in sizes.collect()) == 60
    centers = [np.array(c) for c in model.clusterCenters()]
    for r in pred.collect():
        d = [float(np.sum((r["features"].toArray() - c) ** 2)) for c in centers]
        assert r["prediction"] == int(np.argmin(d))


def test_two_points_k3_lists_empty_cluster(spark):
    # Micro-fixture "two_points": fewer distinct points than k.
    df = spark.createDataFrame([(Vectors.dense([0.0]),), (Vectors.dense([1.0]),), (Vectors.dense([1.0]),)], vschema("features vector"))
    model = clusters.fit_kmeans(df, 3, seed=1)
    pred = clusters.assign(model, df)
    real = clusters.cluster_sizes(pred).collect()
    assert sum(r["size"] for r in real) == 3
    padded = {r["cluster"]: r["size"] for r in clusters.cluster_sizes(pred, k=3).collect()}
    assert len(padded) == 3 and sum(padded.values()) == 3
    centers = clusters.centers_frame(spark, model)
    assert centers.count() == len(model.clusterCenters())


def brute_silhouette(rows):
    xs = [np.array(r[0]) for r in rows]
    ls = [r[1] for r in rows]
    out = []
    for i, x in enumerate(xs):
        by = {}
        for j, y in enumerate(xs):
            if i != j:
                by.setdefault(ls[j], []).append(float(np.sum((x - y) ** 2)))
        if ls[i] not in by:
            out.append(0.0)
            continue
        a = np.mean(by[ls[i]])
        b = min(np.mean(v) for k, v in by.items() if k != ls[i])
        out.append(0.0 if a == b else (1 - a / b if a < b else b / a - 1))
    return float(np.mean(out))


def test_silhouette_equals_all_pairs(spark):
    rng = random.Random(2)
    rows = [([rng.random() + (i % 3), rng.random()], float(i % 3)) for i in range(30)]
    rows.append(([9.0, 9.0], 3.0))  # a one-point cluster scores 0
    df = spark.createDataFrame([(Vectors.dense(v), l) for v, l in rows], vschema("features vector", "prediction double"))
    assert abs(clusters.silhouette(df) - brute_silhouette(rows)) < 1e-9


def test_group_profile_one_aggregate(spark):
    df = points(spark).withColumn("g", (F.col("id") % 2).cast("int")).withColumn("f1", F.col("id") < 10)
    prof = {r["g"]: r for r in clusters.group_profile(df, "g", "flag", ["f1"]).collect()}
    assert prof[0]["size"] == 30 and prof[1]["size"] == 30
    assert abs(prof[0]["f1"] - 5 / 30) < 1e-12
    plan = clusters.group_profile(df, "g", "flag", ["f1"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 1


def test_profile_long_form(spark):
    df = spark.createDataFrame([(0, ["a", "b"]), (0, ["a"]), (1, ["b"])], "g int, items array<string>")
    got = {(r["g"], r["item"]): r["share"] for r in clusters.profile_in_long_form(df, "g").collect()}
    assert got == {(0, "a"): 1.0, (0, "b"): 0.5, (1, "b"): 1.0}


def test_weighted_f1_equals_evaluator(spark):
    rng = random.Random(4)
    rows = [(float(rng.randint(0, 2)), float(rng.randint(0, 3))) for _ in range(300)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    ours = classify.weighted_f1(df, "label", "prediction").first()["f1"]
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName="f1").evaluate(df)
    assert abs(ours - ev) < 1e-12


def test_stable_split_is_deterministic(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a = classify.stable_split(df, "k").repartition(7).where(F.col("split") == "train").select("k")
    b = classify.stable_split(df.repartition(3), "k").where(F.col("split") == "train").select("k")
    sa = {r["k"] for r in a.collect()}
    assert sa == {r["k"] for r in b.collect()}
    assert 1400 < len(sa) < 1600


def test_missing_values_csv(spark, scratch):
    # Micro-fixture "diagnosis_csv": "?" and empty bare_nuclei become null.
    from quarry.sources.readers import DIAGNOSIS_FEATURES, read_diagnosis

    path = f"{scratch}/diag.csv"
    header = ",".join(["id"] + DIAGNOSIS_FEATURES + ["class"])
    with open(path, "w") as fh:
        fh.write(header + "\n")
        fh.write("1,5,1,1,1,2,1,3,1,1,benign\n")
        fh.write("2,5,1,1,1,2,?,3,1,1,benign\n")
        fh.write("3,5,1,1,1,2,,3,1,1,malignant\n")
    df = read_diagnosis(spark, path)
    assert classify.drop_missing(df, ["bare_nuclei"]).count() == 1
    assert classify.missing_rows(df, ["bare_nuclei"]).count() == 2
    no_header = read_diagnosis(spark, path, header=False)
    assert no_header.count() == 4  # the header line becomes a row of nulls + class


def test_tree_grid_invariants(spark):
    data = dt.diagnosis_like(spark, SF_SMALL)
    grid = classify.tree_grid(data, dt.TEXT_FEATURES, "class", "id", max_depths=[2, 3, 4], min_instances=[2, 5])
    rows = grid.orderBy("grid_index").collect()
    assert len(rows) == 6
    best = [r for r in rows if r["is_best"]]
    assert len(best) == 1
    top = max(r["test_f1"] for r in rows)
    assert best[0]["test_f1"] == top
    assert best[0]["grid_index"] == min(r["grid_index"] for r in rows if r["test_f1"] == top)
    assert all(0.0 <= r["train_f1"] <= 1.0 and 0.0 <= r["test_f1"] <= 1.0 for r in rows)


def test_kmeans_with_order_key_is_reproducible(spark):
    df = points(spark, n=200, seed=9)
    a = clusters.fit_kmeans(df.repartition(3), 4, seed=7, order_key="id")
    b = clusters.fit_kmeans(df.repartition(5).orderBy(F.rand(1)), 4, seed=7, order_key="id")
    ca = sorted(tuple(round(x, 9) for x in c) for c in a.clusterCenters())
    cb = sorted(tuple(round(x, 9) for x in c) for c in b.clusterCenters())
    assert ca == cb


def test_f1_from_confusion_equals_aggregate(spark):
    rng = random.Random(8)
    rows = [(float(rng.randint(0, 2)), float(rng.randint(0, 3))) for _ in range(200)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    cells = [(r["t"], r["p"], r["c"]) for r in classify.confusion_counts(df, "label", "prediction").collect()]
    assert abs(classify.f1_from_confusion(cells) - classify.weighted_f1(df, "label", "prediction").first()["f1"]) < 1e-12


def test_top_k_profile_equals_one_hot_profile(spark):
    from quarry.operators import features

    rows = [
        (0, ["a", "b"], True), (0, ["a"], False), (1, ["b", "c"], True), (1, ["c"], None),
        (1, ["a", "c", "d"], False), (2, [], True), (2, ["d", "e"], True),
    ]
    df = spark.createDataFrame(rows, "g int, items array<string>, flag boolean")
    k = 3
    vocab = features.top_k_vocabulary(df, k)
    names = [f"f{i:02d}" for i in range(1, k + 1)]
    expected = clusters.group_profile(features.one_hot(df, vocab, "items", names), "g", "flag", names, digits=6)
    got = clusters.top_k_profile(df, "g", "flag", "items", k, digits=6)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.select(got.columns).collect()))


def test_profile_reports_member_means(spark):
    # Q11: the profile is the mean of the members, not the model's centre
    # (the two differ when Lloyd iterations stop early).
    df = points(spark, n=90, seed=3).withColumn("f1", F.col("id") % 3 == 0)
    model = clusters.fit_kmeans(df, 3, seed=5, max_iter=1)
    pred = clusters.assign(model, df)
    prof = {r["prediction"]: r for r in clusters.group_profile(pred, "prediction", None, ["f1"]).collect()}
    for c, row in prof.items():
        members = [r for r in pred.collect() if r["prediction"] == c]
        assert row["size"] == len(members)
        assert abs(row["f1"] - sum(int(r["f1"]) for r in members) / len(members)) < 1e-12


def test_default_kmeans_runs_on_the_rows(spark):
    # Unequal copies: the default is the plain fit on all rows, not on distinct points.
    from pyspark.ml.clustering import KMeans

    rng = random.Random(11)
    spots = [(rng.random() * 10, rng.random() * 10) for _ in range(40)]
    rows = [(i, Vectors.dense(spots[min(39, int(rng.paretovariate(0.7)) - 1)])) for i in range(900)]
    df = spark.createDataFrame(rows, vschema("id long", "features vector")).coalesce(1)
    ours = clusters.fit_kmeans(df, 6, seed=2, checkpoint=False)
    plain = KMeans(featuresCol="features", k=6, seed=2, maxIter=20).fit(df.select("features"))
    assert abs(ours.summary.trainingCost - plain.summary.trainingCost) < 1e-6


def test_kmeans_layout_does_not_follow_the_session(spark):
    df = points(spark, n=300, seed=4)
    costs = set()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (4, 8, 16):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            costs.add(round(clusters.fit_kmeans(df, 20, seed=3, order_key="id", partitions=5).summary.trainingCost, 9))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(costs) == 1


def test_profile_of_real_valued_features(spark):
    rows = [(1, 0.7, 2.9, True), (1, 0.5, 1.1, False), (2, -1.5, None, None)]
    df = spark.createDataFrame(rows, "g int, a double, b double, flag boolean")
    got = {r["g"]: r for r in clusters.group_profile(df, "g", "flag", ["a", "b"], digits=6).collect()}
    assert (got[1]["a"], got[1]["b"], got[1]["label_ratio"]) == (0.6, 2.0, 0.5)
    assert (got[2]["a"], got[2]["b"], got[2]["label_ratio"]) == (-1.5, None, None)


def test_best_tree_is_returned(spark):
    data = dt.diagnosis_like(spark, SF_SMALL, labeled_only=True)
    grid, model = classify.search_trees(data, dt.TEXT_FEATURES, "class", "id", max_depths=[2, 3], min_instances=[2])
    best = grid.where("is_best").first()
    scored = model.transform(classify.drop_missing(data, dt.TEXT_FEATURES + ["class"]))
    tagged = classify.stable_split(scored, "id", 0.75, 1234, out="_split").where("_split = 'test'")
    index = F.when(F.col("class") == "high", 0.0).otherwise(1.0)
    again = tagged.select(index.alias("t"), F.when(F.col("predictedClass") == "high", 0.0).otherwise(1.0).alias("p"))
    assert abs(classify.weighted_f1(again, "t", "p").first()["f1"] - best["test_f1"]) < 1e-9
    assert model.stages[1].getMaxDepth() == best["max_depth"]


def test_ids_beyond_32_bits(spark, scratch):
    big = spark.createDataFrame([(2**40, "Some text.", "en")], "doc_id long, text string, lang string")
    big.write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame([(2**40, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{scratch}/labels.parquet")
    assert dt.diagnosis_like(spark, scratch).first()["id"] == 2**40


def test_profile_long_form_keeps_null_group(spark):
    df = spark.createDataFrame([(None, ["a", "b"]), (None, ["a"]), (1, ["b"])], "g int, items array<string>")
    got = {(r["g"], r["item"]): r["share"] for r in clusters.profile_in_long_form(df, "g").collect()}
    assert got == {(None, "a"): 1.0, (None, "b"): 0.5, (1, "b"): 1.0}


def test_profile_totals_equal_plain_sums(spark):
    rows = [(i % 4, i % 3 == 0, i % 5 < 2, i % 7 == 0) for i in range(97)] + [(None, True, True, False)]
    df = spark.createDataFrame(rows, "g int, y boolean, a boolean, b boolean")
    prof = clusters.group_profile(df, "g", "y", ["a", "b"], group_alias="cluster")
    got = {r.feature: (r.groups, r.rows, round(r.total)) for r in clusters.profile_totals(prof, ["a", "b", "label_ratio"]).collect()}
    assert got == {name: (5, 98, sum(r[c] for r in rows)) for name, c in (("a", 2), ("b", 3), ("label_ratio", 1))}
    none = clusters.profile_totals(prof.where("size < 0"), ["a"]).collect()
    assert [(r.groups, r.rows, r.total) for r in none] == [(0, None, None)]


def test_kmeans_rounds_run_on_repeated_vectors_once(spark, monkeypatch):
    """F5-F8, F10: each of 20 rounds visited every row, though few vectors differ; the model is that of the rows."""
    from pyspark.ml.clustering import KMeans

    rows = [(i, *(float(min(i % 64, i // 64 * 37 % 64) >> j & 1) for j in range(6))) for i in range(4000)]
    cols = [f"c{j}" for j in range(6)]
    df = features.assemble(spark.createDataFrame(rows, ["id", *cols]).repartition(3, "id"), cols).select("features").persist()
    plain = KMeans(k=6, seed=2, maxIter=20).fit(df)
    fitted, fit = [], KMeans.fit
    monkeypatch.setattr(clusters, "SPARED", 1000)
    monkeypatch.setattr(KMeans, "fit", lambda self, data: fitted.append(self.getMaxIter()) or fit(self, data))
    ours = clusters.fit_kmeans(df, 6, seed=2, checkpoint=False)
    assert fitted == [0] and plain.summary.numIter > 1
    assert [c.tolist() for c in ours.clusterCenters()] == [c.tolist() for c in plain.clusterCenters()]
    assert sorted(r.prediction for r in clusters.assign(ours, df).collect()) == sorted(r.prediction for r in plain.transform(df).collect())
    monkeypatch.setattr(clusters, "REPEATED", 1 << 20)  # few copies: on the rows
    assert len(clusters.fit_kmeans(df, 6, seed=2, checkpoint=False).clusterCenters()) == 6 and fitted == [0, 20]
    df.unpersist()
