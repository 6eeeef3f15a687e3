"""Summarise the final physical plan of every registered query.

Usage: python tools/plan_report.py [sf_dir] [name ...]

Each query is built and collected, then its final adaptive plan is scanned
for shuffles, broadcasts, reused exchanges, subqueries, Python stages and
parquet scans with pushed filters. Prints a markdown table.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarry.plans.registry import load_all  # noqa: E402
from quarry.session import build_session  # noqa: E402

PATTERNS = {
    "shuffles": r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)",
    "broadcasts": r"BroadcastExchange",
    "reused": r"ReusedExchange",
    "subqueries": r"Subquery subquery",
    "python": r"MapInArrow|ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas",
    "pushed_scans": r"PushedFilters: \[[^\]]+\]",
}


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(text: str) -> str:
    """Drop every "Initial Plan" section (the main one and the subqueries')."""
    kept, skip_indent = [], None
    for line in text.splitlines():
        indent = len(line) - len(line.lstrip())
        if skip_indent is not None:
            if indent > skip_indent:
                continue
            skip_indent = None
        if "== Initial Plan ==" in line:
            skip_indent = indent
            continue
        kept.append(line)
    return "\n".join(kept)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    wanted = set(sys.argv[2:])
    spark = build_session("local[8]", 8, app_name="quarry-plans", extra_conf={"spark.driver.memory": "16g"})
    print("| query | shuffles | broadcasts | reused | subqueries | python | scans w/ pushed filters |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for name, q in load_all().items():
        if wanted and name not in wanted:
            continue
        df = q.build(spark, sf_dir)
        df.collect()
        text = plan_text(df)
        # A reused exchange repeats the text of the one it reuses.
        final = "\n".join(x for x in final_plan(text).splitlines() if "ReusedExchange" not in x)
        counts = {k: len(re.findall(p, final_plan(text) if k == "reused" else final)) for k, p in PATTERNS.items()}
        print(f"| {name} | " + " | ".join(str(counts[k]) for k in PATTERNS) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
