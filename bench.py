"""Benchmark the headline queries.

Runs every query registered with ``bench=True`` (plus any named on the
command line) at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS]. Each query is run $BENCH_RUNS times (default 2) on a
full collect and its fastest run is reported; a small warm-up query first
keeps JVM start-up out of the timings. Prints ONE JSON line:

{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarry.plans.registry import load_all  # noqa: E402
from quarry.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    extra = sys.argv[1:]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus), app_name="quarry-bench", extra_conf={"spark.driver.memory": "16g"})
    registry = load_all()
    names = [n for n, q in registry.items() if q.bench or n in extra]
    # Warm-up: one small query so JVM start-up and code loading are not
    # charged to the first timed query.
    registry["item_counts"].build(spark, sf_dir).collect()
    runs = max(1, int(os.environ.get("BENCH_RUNS", "2")))
    timings: dict[str, float] = {}
    all_runs: dict[str, list[float]] = {}
    rows: dict[str, int] = {}
    errors: dict[str, str] = {}
    for name in names:
        try:
            for _ in range(runs):
                t0 = time.perf_counter()
                out = registry[name].build(spark, sf_dir).collect()
                all_runs.setdefault(name, []).append(round(time.perf_counter() - t0, 3))
                rows[name] = len(out)
            timings[name] = min(all_runs[name])
        except Exception as exc:  # noqa: BLE001 - one failure must not lose the record
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "rows": rows,
                "runs": all_runs,
                "errors": errors,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
