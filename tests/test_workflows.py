"""The reference workflows end to end on small hand-written files, through
the same calls as the README's "Using it" section."""

import random

from quarry.operators import baskets, classify, clusters, features, itemsets, outliers, tokens
from quarry.sources import readers, sinks


def _write(path, text):
    with open(path, "w") as fh:
        fh.write(text)


def test_hashtag_workflow(spark, scratch):
    _write(f"{scratch}/d1.txt", "#a #b x\n#a\n  #c\t\n")
    _write(f"{scratch}/d2.txt", "#b #b\n#d\n")
    day1 = tokens.prefix_counts(readers.read_lines(spark, f"{scratch}/d1.txt"), "#")
    day2 = tokens.prefix_counts(readers.read_lines(spark, f"{scratch}/d2.txt"), "#")
    sinks.write_pairs_text(tokens.rank(day1), f"{scratch}/out1", "token", "n")
    saved = sorted(r["value"] for r in spark.read.text(f"{scratch}/out1").collect())
    assert saved == ["('#a', 2)", "('#b', 1)", "('#c', 1)"]
    diff = {r["token"]: r["diff"] for r in tokens.count_change(day1, day2, "token", how="left").collect()}
    assert diff == {"#a": 2, "#b": -1, "#c": 1}


def test_port_set_and_clustering_workflow(spark, scratch):
    rng = random.Random(1)
    ports = ["23", "80", "443", "445", "2323", "8080"]
    lines = ["numports,ports_scanned_str,mirai,country"]
    for i in range(300):
        k = rng.choice([1, 1, 2, 3, 4])
        chosen = rng.sample(ports, k)
        lines.append(f"{k},{'-'.join(chosen)},{str(rng.random() < 0.3).lower()},c{i % 5}")
    lines.append("6," + "-".join(ports) + ",false,cx")  # one extreme scanner
    _write(f"{scratch}/profile.csv", "\n".join(lines) + "\n")
    profile = baskets.to_items(readers.read_scanner_profile(spark, f"{scratch}/profile.csv"), "ports_scanned_str")
    assert profile.schema["country"].dataType.simpleString() == "string"
    pairs = itemsets.frequent_pairs(profile, threshold=20)
    assert pairs.count() > 0
    sinks.write_result(itemsets.as_item_sets(pairs), f"{scratch}/pairs")
    extreme, kept = outliers.split_by_rarity(profile, "numports")
    assert [r["numports"] for r in extreme.collect()] == [6]
    sinks.write_csv(extreme, f"{scratch}/extreme", header=True)
    vocab = features.top_k_vocabulary(kept, 4)
    names = features.feature_names(vocab, "Port")
    data = features.assemble(features.one_hot(kept, vocab, "items", names), names)
    model = clusters.fit_kmeans(data, 5, seed=123)
    pred = clusters.assign(model, data)
    assert -1.0 <= clusters.silhouette(pred) <= 1.0
    prof = clusters.group_profile(pred, "prediction", "mirai", names, group_alias="cluster")
    assert sum(r["size"] for r in prof.collect()) == kept.count()
    _, projected = features.reduce_pca(data, 2)
    assert projected.count() == kept.count()


def test_tree_workflow(spark, scratch):
    rng = random.Random(2)
    header = ",".join(["id"] + readers.DIAGNOSIS_FEATURES + ["class"])
    rows = [header]
    for i in range(240):
        feats = [rng.randint(1, 10) for _ in readers.DIAGNOSIS_FEATURES]
        label = "malignant" if feats[0] + feats[1] > 11 else "benign"
        cells = [str(v) for v in feats]
        if i % 17 == 0:
            cells[5] = "?"  # missing bare_nuclei
        rows.append(",".join([str(i)] + cells + [label]))
    _write(f"{scratch}/diag.csv", "\n".join(rows) + "\n")
    diag = readers.read_diagnosis(spark, f"{scratch}/diag.csv")
    grid = classify.tree_grid(diag, readers.DIAGNOSIS_FEATURES, "class", "id", max_depths=[2, 4], min_instances=[2, 6])
    rows = grid.collect()
    assert len(rows) == 4 and sum(r["is_best"] for r in rows) == 1
    assert max(r["test_f1"] for r in rows) > 0.7
    sinks.write_result(grid, f"{scratch}/grid")
