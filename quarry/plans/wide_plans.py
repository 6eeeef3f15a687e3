"""Wide and hot baskets: the distinct words of each document, and the parts of each order.

The order baskets of ``basket_plans`` have 25 possible items. Here a basket may
hold thousands of items, a few words lie in most documents, and thresholds are
absolute counts, as for scanned ports.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import bitmaps, clusters, features, itemsets, ranks, sketch_pca, summaries
from quarry.plans.registry import register
from quarry.session import write_shared
from quarry.sources import driver_tables as dt

WORD_THRESHOLD = 150
TRIPLE_THRESHOLD = 300
PART_THRESHOLD = 1
TOP_WORDS = 100
WIDE_WORDS = 200
SPARSE_WORDS = 5000
STUMP_WORDS = 10
CHECK_WORDS = 20
DIGITS = 6
EMBEDDING_SIZE = 64

WORDS_SQL = """
WITH baskets AS (
  SELECT doc_id, lang, list_distinct(list_filter(string_split(replace(text, chr(10), ' '), ' '), lambda w: w <> '')) AS items
  FROM documents WHERE text IS NOT NULL
), bi AS (
  SELECT doc_id, unnest(items) AS item FROM baskets
), ranked AS (
  SELECT item, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, item) AS rk FROM bi GROUP BY item
)
"""


def word_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, lang, items): the distinct words of each document, split at spaces and line feeds."""
    docs = dt.table(spark, sf_dir, "documents").select("doc_id", "lang", "text").where(F.col("text").isNotNull())
    words = F.array_distinct(F.array_remove(F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " "), ""))
    return docs.select("doc_id", "lang", words.alias("items"))


def part_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(basket_id, items): the part keys of each order, as strings."""
    li = dt.table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_partkey").cast("string").alias("part"))
    return li.groupBy(F.col("l_orderkey").alias("basket_id")).agg(F.collect_set("part").alias("items"))


def _pairs_sql(with_sql: str, key: str, threshold: int) -> str:
    return (
        with_sql
        + f", hot AS (SELECT bi.* FROM bi SEMI JOIN (SELECT item FROM bi GROUP BY item HAVING count(*) > {threshold}) f USING (item)) "
        f"SELECT x.item AS item_1, y.item AS item_2, count(*) AS n FROM hot x JOIN hot y ON x.{key} = y.{key} AND x.item < y.item "
        f"GROUP BY 1, 2 HAVING count(*) > {threshold}"
    )


@register("frequent_word_pairs", oracle=_pairs_sql(WORDS_SQL, "doc_id", WORD_THRESHOLD), bench=True)
def frequent_word_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word pairs in more than 150 documents: wide baskets, hot items, an absolute threshold."""
    return itemsets.frequent_pairs(word_sets(spark, sf_dir), threshold=WORD_THRESHOLD)


def _triples_sql(with_sql: str, key: str, threshold: int) -> str:
    return (
        with_sql
        + f", hot AS (SELECT bi.* FROM bi SEMI JOIN (SELECT item FROM bi GROUP BY item HAVING count(*) > {threshold}) f USING (item)), "
        f"pairs AS (SELECT x.item AS a, y.item AS b FROM hot x JOIN hot y ON x.{key} = y.{key} AND x.item < y.item "
        f"GROUP BY 1, 2 HAVING count(*) > {threshold}) "
        f"SELECT x.item AS item_1, y.item AS item_2, z.item AS item_3, count(*) AS n FROM pairs p JOIN hot x ON x.item = p.a "
        f"JOIN hot y ON y.{key} = x.{key} AND y.item = p.b JOIN hot z ON z.{key} = x.{key} AND z.item > y.item "
        f"GROUP BY 1, 2, 3 HAVING count(*) > {threshold}"
    )


@register("frequent_word_triples", oracle=_triples_sql(WORDS_SQL, "doc_id", TRIPLE_THRESHOLD))
def frequent_word_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word triples in more than 300 documents, counted from bitmaps of documents."""
    return bitmaps.frequent_triples(word_sets(spark, sf_dir), threshold=TRIPLE_THRESHOLD)


@register("frequent_word_pairs_by_bitmap", oracle=_pairs_sql(WORDS_SQL, "doc_id", WORD_THRESHOLD), bench=True)
def frequent_word_pairs_by_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word pairs in more than 150 documents, counted from bitmaps of documents."""
    return bitmaps.frequent_pairs(word_sets(spark, sf_dir), threshold=WORD_THRESHOLD)


_PARTS_SQL = "WITH bi AS (SELECT DISTINCT l_orderkey AS basket_id, l_partkey::VARCHAR AS item FROM lineitem)"


@register("frequent_part_pairs", oracle=_pairs_sql(_PARTS_SQL, "basket_id", PART_THRESHOLD))
def frequent_part_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part pairs in more than one order: a vocabulary of all parts."""
    return itemsets.frequent_pairs(part_sets(spark, sf_dir), threshold=PART_THRESHOLD)


@register("heavy_words", oracle=WORDS_SQL + f"SELECT item, n, rk AS place FROM ranked WHERE rk <= {TOP_WORDS}", bench=True)
def heavy_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 100 most frequent words with their places, from summaries of each task and a count of their candidates."""
    return ranks.with_places(summaries.heavy_hitters(word_sets(spark, sf_dir), TOP_WORDS), F.col("n").desc(), F.col("item").asc())


@register(
    "united_daily_users",
    oracle="SELECT count(DISTINCT user_id) AS exact, TRUE AS within FROM events WHERE ts >= TIMESTAMP '2024-01-02' AND ts < TIMESTAMP '2024-01-09'",
)
def united_daily_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct users of a week of events, and whether the estimate from the stored sketches of its
    days lies within three standard errors of it."""
    ev = dt.table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("day"), "user_id")
    days = write_shared(summaries.distinct_sketches(ev, "day", "user_id"), "day-sketches")  # every day, stored
    week = F.col("day").between(F.lit("2024-01-02").cast("date"), F.lit("2024-01-08").cast("date"))
    estimate = summaries.united_distinct(days.where(week)).scalar()
    error = 3 * 1.04 / (1 << summaries.LG_REGISTERS) ** 0.5
    exact = ev.where(week).agg(F.count_distinct("user_id").alias("exact"))
    return exact.select("exact", (F.abs(estimate - F.col("exact")) <= F.col("exact") * error).alias("within"))


def _flags_sql(k: int) -> str:
    names = features.feature_names([""] * k, "f", by_rank=True)
    hit = "SELECT b.doc_id, b.lang, r.rk FROM baskets b JOIN bi USING (doc_id) JOIN ranked r USING (item)"
    cols = ", ".join(f"count(*) FILTER (WHERE rk = {i}) > 0 AS {n}" for i, n in enumerate(names, 1))
    return WORDS_SQL.rstrip() + f", onehot AS (SELECT doc_id, any_value(lang) AS lang, {cols} FROM baskets LEFT JOIN " + (
        f"(SELECT doc_id, rk FROM ({hit}) WHERE rk <= {k}) h USING (doc_id) GROUP BY doc_id) "
    )


@register("one_hot_words", oracle=_flags_sql(TOP_WORDS) + "SELECT * EXCLUDE (lang) FROM onehot", bench=True)
def one_hot_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a flag for each of the 100 most frequent words."""
    return features.one_hot_by_rank(word_sets(spark, sf_dir), "doc_id", TOP_WORDS)


@register("one_hot_sums", oracle=WORDS_SQL + f"SELECT 'Word' || item AS feature, n FROM ranked WHERE rk <= {WIDE_WORDS}", bench=True)
def one_hot_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents per flag of the 200 item-named one-hot columns (equal to the item counts)."""
    sets = word_sets(spark, sf_dir)
    vocab = features.top_k_vocabulary(sets, WIDE_WORDS)
    names = features.feature_names(vocab, "f", by_rank=True)  # words differ in case alone, columns may not
    wide = features.one_hot(sets.select("items"), vocab, "items", names)
    sums = wide.agg(*[F.count_if(F.col(n)).alias(n) for n in names])
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(n).alias("n")) for f, n in zip(features.feature_names(vocab, "Word"), names, strict=True)])
    return sums.select(F.inline(pairs))


def _profile_sql(k: int) -> str:
    names = features.feature_names([""] * k, "f", by_rank=True)
    cols = ", ".join(f"round(avg({n}::INT), {DIGITS}) AS {n}" for n in names)
    return _flags_sql(k) + f"SELECT lang, count(*) AS size, {cols} FROM onehot GROUP BY lang"


@register("word_profile", oracle=_profile_sql(WIDE_WORDS), bench=True)
def word_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per language: documents, and the share that holds each of the 200 most frequent words."""
    return clusters.top_k_profile(word_sets(spark, sf_dir), "lang", None, "items", WIDE_WORDS, digits=DIGITS)


def _sparse_profile_sql(k: int) -> str:
    return WORDS_SQL.rstrip() + (
        f", sizes AS (SELECT lang, count(*) AS size FROM baskets GROUP BY lang), "
        f"held AS (SELECT lang, item, count(*) AS n FROM baskets JOIN bi USING (doc_id) GROUP BY 1, 2) "
        f"SELECT s.lang, s.size, r.item AS feature, round(coalesce(h.n, 0) / s.size, {DIGITS}) AS mean FROM sizes s "
        f"JOIN ranked r ON r.rk <= {k} LEFT JOIN held h ON h.lang IS NOT DISTINCT FROM s.lang AND h.item = r.item"
    )


@register("sparse_word_profile", oracle=_sparse_profile_sql(SPARSE_WORDS), bench=True)
def sparse_word_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per language: documents, and the share that holds each of the 5,000 most frequent
    words, from one sparse vector column."""
    sets = word_sets(spark, sf_dir)
    vocab = features.top_k_vocabulary(sets, SPARSE_WORDS)
    return clusters.vector_profile(features.sparse_one_hot(sets, vocab), "lang", vocab, digits=DIGITS)


@register(
    "embedding_profile",
    oracle="SELECT label, count(*) AS size, "
    + ", ".join(f"round(avg(embedding[{i}]::DOUBLE), 5) AS e{i}" for i in range(1, EMBEDDING_SIZE + 1))
    + " FROM embeddings GROUP BY label",
)
def embedding_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per label: vectors and the mean of each of their real-valued dimensions."""
    emb = dt.table(spark, sf_dir, "embeddings")
    cols = emb.select("label", *[F.col("embedding")[i].cast("double").alias(f"e{i + 1}") for i in range(EMBEDDING_SIZE)])
    return clusters.group_profile(cols, "label", None, [f"e{i}" for i in range(1, EMBEDDING_SIZE + 1)], digits=5)


def _word_vectors(spark: SparkSession, sf_dir: str, k: int) -> tuple[DataFrame, list[str]]:
    names = features.feature_names([""] * k, "f", by_rank=True)
    sets = word_sets(spark, sf_dir)
    flags = features.one_hot_by_rank(sets, "doc_id", k)
    # Written once: the fit and what follows read the flags several times.
    return features.assemble(write_shared(flags, "word-flags"), names), names


_COVARIANCE_SQL = (
    _flags_sql(STUMP_WORDS)
    + ", long AS (UNPIVOT (SELECT doc_id, "
    + ", ".join(f"{n}::DOUBLE AS {n}" for n in features.feature_names([""] * STUMP_WORDS, "f", by_rank=True))
    + " FROM onehot) ON COLUMNS(* EXCLUDE (doc_id)) INTO NAME f VALUE v) "
    "SELECT x.f AS feature_1, y.f AS feature_2, "
    "round(covar_samp(x.v, y.v) / (SELECT sum(s) FROM (SELECT var_samp(v) AS s FROM long GROUP BY f)), 6) + 0.0 AS share "
    "FROM long x JOIN long y USING (doc_id) GROUP BY 1, 2"
)


@register("pca_covariance", oracle=_COVARIANCE_SQL)
def pca_covariance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The covariance of ten word flags, over the total variance, put together again from all
    principal components and their shares: it is the plain covariance only if both are right."""
    data, names = _word_vectors(spark, sf_dir, STUMP_WORDS)
    model, _ = features.reduce_pca(data, STUMP_WORDS)
    axes, shares = model.pc.toArray(), model.explainedVariance.toArray()
    whole = (axes * shares) @ axes.T
    rows = [(a, b, float(round(whole[i, j], 6)) + 0.0) for i, a in enumerate(names) for j, b in enumerate(names)]
    return spark.createDataFrame(rows, "feature_1 string, feature_2 string, share double")


@register("pca_sketch_covariance", oracle=_COVARIANCE_SQL)
def pca_sketch_covariance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same covariance put together again from the components that the range finder gives."""
    data, names = _word_vectors(spark, sf_dir, STUMP_WORDS)
    axes, shares = sketch_pca.randomised_pca(data, STUMP_WORDS)
    whole = (axes * shares) @ axes.T
    rows = [(a, b, float(round(whole[i, j], 6)) + 0.0) for i, a in enumerate(names) for j, b in enumerate(names)]
    return spark.createDataFrame(rows, "feature_1 string, feature_2 string, share double")


@register("pca_sparse_words")
def pca_sparse_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of variance of 20 components of the 5,000 most frequent words as one sparse vector column."""
    sets = word_sets(spark, sf_dir)
    vectors = features.sparse_one_hot(sets, features.top_k_vocabulary(sets, SPARSE_WORDS))
    _, shares = sketch_pca.randomised_pca(vectors, 20, oversample=20)
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(shares, 1)], "component int, explained_variance double")


_STUMP_SQL = (
    _flags_sql(STUMP_WORDS)
    + ", long AS (UNPIVOT (SELECT (lang = 'en')::INT AS y, "
    + ", ".join(f"{n}::INT AS {n}" for n in features.feature_names([""] * STUMP_WORDS, "f", by_rank=True))
    + " FROM onehot) ON COLUMNS(* EXCLUDE (y)) INTO NAME feature VALUE v), "
    "sides AS (SELECT feature, v, count(*) AS n, avg(y) AS p FROM long GROUP BY 1, 2), "
    "scored AS (SELECT feature, sum(n * 2 * p * (1 - p)) / sum(n) AS impurity, "
    "max(CASE WHEN v = 0 THEN (p > 0.5)::INT END) AS without_word, max(CASE WHEN v = 1 THEN (p > 0.5)::INT END) AS with_word "
    "FROM sides GROUP BY feature) "
    "SELECT feature, without_word, with_word FROM scored ORDER BY impurity, feature LIMIT 1"
)


@register("tree_stump", oracle=_STUMP_SQL)
def tree_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one split that tells English best by ten word flags, and its two leaves:
    a decision tree of depth one against the Gini impurity of every flag."""
    from pyspark.ml.classification import DecisionTreeClassifier

    names = features.feature_names([""] * STUMP_WORDS, "f", by_rank=True)
    sets = word_sets(spark, sf_dir)
    ranked = sets.withColumn("y", (F.col("lang") == "en").cast("double"))
    flags = features.one_hot_by_rank(ranked.withColumn("k", F.struct("doc_id", "y")), "k", STUMP_WORDS, rank_source=sets)
    data = features.assemble(write_shared(flags.select("k.y", *names), "stump-flags"), names)
    model = DecisionTreeClassifier(labelCol="y", featuresCol="features", maxDepth=1).fit(data)
    split = [i for i, v in enumerate(model.featureImportances.toArray()) if v > 0][0]
    leaves = {r.v: int(r.prediction) for r in model.transform(data).select(F.col(names[split]).alias("v"), "prediction").distinct().collect()}
    return spark.createDataFrame([(names[split], leaves[False], leaves[True])], "feature string, without_word int, with_word int")


@register(
    "kmeans_words_check",
    oracle=_flags_sql(CHECK_WORDS)
    + "SELECT 'rows' AS measure, count(*)::DOUBLE AS value FROM onehot UNION ALL SELECT 'rows not at their nearest centre', 0 UNION ALL "
    + " UNION ALL ".join(
        f"SELECT '{n}', round(avg({n}::INT), {DIGITS}) FROM onehot" for n in features.feature_names([""] * CHECK_WORDS, "f", by_rank=True)
    ),
)
def kmeans_words_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k-means on the 20 word flags, checked: cluster sizes add up to the rows, every row is at its
    nearest centre, and the size-weighted cluster profile is the plain share of each word."""
    data, names = _word_vectors(spark, sf_dir, CHECK_WORDS)
    model = clusters.fit_kmeans(data, 20, 123)
    pred = clusters.assign(model, data)
    profile = clusters.group_profile(pred, "prediction", None, names)
    shares = profile.agg(F.sum("size").cast("double").alias("rows"), *[F.round(F.sum(F.col(n) * F.col("size")) / F.sum("size"), DIGITS).alias(n) for n in names])
    centres = [c.tolist() for c in model.clusterCenters()]  # k x d values
    x = F.array(*[F.col(n).cast("double") for n in names])
    at = F.array(*[F.array(*[F.lit(v) for v in c]) for c in centres])

    def squared(c):
        return F.aggregate(F.zip_with(x, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)

    distance = F.transform(at, squared)
    away = pred.select("prediction", distance.alias("d")).where(F.get("d", F.col("prediction")) > F.array_min("d") + 1e-9)
    wrong = away.agg(F.count(F.lit(1)).cast("double").alias("value")).select(F.lit("rows not at their nearest centre").alias("measure"), "value")
    pairs = F.array(*[F.struct(F.lit(n).alias("measure"), F.col(n).alias("value")) for n in ["rows", *names]])
    return shares.select(F.inline(pairs)).unionByName(wrong)


@register("pca_words", bench=True)
def pca_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Explained variance of 100 components of the 200 word flags."""
    data, _ = _word_vectors(spark, sf_dir, WIDE_WORDS)
    model, _ = features.reduce_pca(data.select("features"), 100)
    return spark.createDataFrame(features.explained_variance(model), "component int, explained_variance double")
