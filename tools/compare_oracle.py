"""Run registered queries in Spark and their SQL in DuckDB; compare results.

Usage: python tools/compare_oracle.py [sf_dir] [name ...]

Rows are compared as multisets after sorting columns by name; doubles are
rounded to 6 places. Prints one line per query and a summary.
"""

from __future__ import annotations

import collections
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarry.session import build_session  # noqa: E402
from quarry.plans.registry import load_all  # noqa: E402
from quarry.sources.driver_tables import TABLES  # noqa: E402


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "toArray"):
        return tuple(_norm(float(x)) for x in v.toArray())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = set(sys.argv[2:])
    spark = build_session("local[8]", 8, extra_conf={"spark.driver.memory": "16g"})
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    bad = 0
    for name, q in load_all().items():
        if wanted and name not in wanted:
            continue
        t0 = time.time()
        try:
            df = q.build(spark, sf_dir)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if not q.oracle:
            print(f"rows {name}: {len(s_rows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            res = con.execute(q.oracle)
            d_cols = [d[0] for d in res.description]
            d_rows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:300]}")
            bad += 1
            continue
        same_cols = sorted(s_cols) == sorted(d_cols)
        same = same_cols and _rows(s_cols, s_rows) == _rows(d_cols, d_rows)
        status = "ok  " if same else "FAIL"
        bad += 0 if same else 1
        print(f"{status} {name}: spark {len(s_rows)} rows, duckdb {len(d_rows)} rows {ts:.1f}s"
              + ("" if same_cols else f" cols {sorted(s_cols)} vs {sorted(d_cols)}"))
        if not same and same_cols:
            a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
            print("   only spark:", list((a - b).items())[:3])
            print("   only duckdb:", list((b - a).items())[:3])
    spark.stop()
    print("mismatches:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
