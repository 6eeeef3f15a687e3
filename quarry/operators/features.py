"""Feature building: top-k one-hot, vector assembly, PCA."""

from __future__ import annotations

from pyspark.ml.feature import PCA, CountVectorizerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.baskets import top_k_items

def top_k_vocabulary(df: DataFrame, k: int, items: str = "items") -> list[str]:
    """The k most frequent items in rank order (count desc, item asc).

    Only k rows reach the driver; they name the feature columns.
    """
    return [r["item"] for r in top_k_items(df, k, items).collect()]


def feature_names(vocab: list[str], prefix: str = "Port", by_rank: bool = False) -> list[str]:
    """Column names: prefix + item (reference style) or prefix + 2-digit rank."""
    if by_rank:
        width = max(2, len(str(len(vocab))))
        return [f"{prefix}{i + 1:0{width}d}" for i in range(len(vocab))]
    return [f"{prefix}{v}" for v in vocab]


def one_hot(
    df: DataFrame, vocab: list[str], items: str = "items", names: list[str] | None = None
) -> DataFrame:
    """Add one boolean column per vocabulary item, in ONE projection.

    Thousands of columns are slow to plan; ``sparse_one_hot`` gives the same
    features as one vector column.
    """
    names = names or feature_names(vocab)
    if len(names) != len(vocab):
        raise ValueError("one name per vocabulary item")
    return df.select("*", *[F.array_contains(F.col(items), v).alias(n) for v, n in zip(vocab, names)])


def sparse_one_hot(df: DataFrame, vocab: list[str], items: str = "items", out: str = "features") -> DataFrame:
    """Binary sparse vector over ``vocab`` (for wide vocabularies)."""
    model = CountVectorizerModel.from_vocabulary(vocab, inputCol=items, outputCol=out, binary=True)
    return model.transform(df)


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    """VectorAssembler over numeric or boolean columns."""
    return VectorAssembler(inputCols=cols, outputCol=out).transform(df)


def reduce_pca(df: DataFrame, k: int, input_col: str = "features", output_col: str = "pca_features"):
    """Fit PCA and project. Returns (model, projected DataFrame).

    Spark's PCA does not centre rows before projecting (the covariance it
    decomposes is centred, the projection is not); distances between
    projected rows are unaffected. The d x d eigenproblem runs on the driver,
    so d should stay in the low thousands.
    """
    model = PCA(k=k, inputCol=input_col, outputCol=output_col).fit(df)
    return model, model.transform(df)


def explained_variance(model) -> list[tuple[int, float]]:
    """(component, share of variance) of a fitted PCA model."""
    return [(i + 1, float(v)) for i, v in enumerate(model.explainedVariance.toArray())]


def ranked_top_k(df: DataFrame, k: int, items: str = "items") -> DataFrame:
    """(item, rank) of the k most frequent items, rank 1 = most frequent,
    ties by item. At most k rows: numbering them in one partition is
    bounded work, and the frame is safe to broadcast."""
    from pyspark.sql import Window

    top = top_k_items(df, k, items)
    order = Window.orderBy(F.col("n").desc(), F.col("item").asc())
    return top.select("item", F.row_number().over(order).alias("rank"))


def ranked_items(df: DataFrame, k: int, items: str = "items") -> Column:
    """The k most frequent items in rank order, as one array (a scalar subquery of k rows)."""
    ranked = ranked_top_k(df, k, items).agg(F.sort_array(F.collect_list(F.struct("rank", "item"))).alias("r"))
    return ranked.select(F.col("r.item")).scalar()


def one_hot_by_rank(
    df: DataFrame, key: str, k: int, items: str = "items", prefix: str = "f", rank_source: DataFrame | None = None
) -> DataFrame:
    """(key, f01..fk): does the row hold the i-th most frequent item?

    One narrow projection with the k items as a scalar subquery: every row
    keeps its own flags, whether or not ``key`` is unique, and nothing is
    shuffled beyond the item counts. False for an item beyond the last.
    """
    names = feature_names([""] * k, prefix, by_rank=True)
    top = ranked_items(rank_source if rank_source is not None else df, k, items)
    held = df.select(key, F.coalesce(F.col(items), F.array().cast("array<string>")).alias("_items"), top.alias("_top"))
    flag = [F.coalesce(F.array_contains("_items", F.get("_top", F.lit(i))), F.lit(False)) for i in range(k)]
    return held.select(key, *[c.alias(n) for c, n in zip(flag, names)])
