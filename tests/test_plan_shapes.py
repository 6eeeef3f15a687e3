"""Plan-shape rules for the registered queries (scale design, not values):
no cartesian product or nested-loop join and no Python in the plan; single
passes where the operators promise them, on the executed plan."""

import re

import pytest

from conftest import SF_SMALL

# Queries whose returned frame is a small model or file result: their work is
# covered by the invariant tests, and their final plan is a local scan.
_SKIP = {"tree_grid", "kmeans_centers", "pca_variance", "clustering_compare", "silhouette"}


def executed(df):
    """The plan that ran, stages and all."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def _names():
    from quarry.plans.registry import load_all

    return [n for n in load_all() if n not in _SKIP]


@pytest.mark.parametrize("name", _names())
def test_plan_shape(spark, name):
    import __spark_entry__ as e

    df = e.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan), name
    assert not re.search(r"BatchEvalPython|ArrowEvalPython", plan), name
    assert "MapInArrow" not in plan and "MapInPandas" not in plan, name


def test_weighted_f1_reads_and_counts_once(spark):
    from quarry.plans.registry import load_all

    plan = executed(load_all()["weighted_f1"].build(spark, SF_SMALL))
    assert plan.count("FileScan") == 1 and plan.count("Join") == 0


def test_long_profile_explodes_once(spark):
    from quarry.plans.registry import load_all

    plan = executed(load_all()["group_profile_long"].build(spark, SF_SMALL))
    assert len(re.findall(r"Generate inline", plan)) == 1


def test_support_threshold_counts_once(spark):
    from quarry.operators import baskets as bk

    df = spark.createDataFrame([(["a", "b"],), (["a"],)], "items array<string>")
    plan = executed(bk.frequent_items(df, min_support="0.6"))
    assert "Generate" not in plan  # exploded and counted when it was written
