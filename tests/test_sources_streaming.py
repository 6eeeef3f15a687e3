"""Readers, sinks, the file stream, and the driver contract."""

import glob
import os

import duckdb
import pytest

from quarry.operators import baskets as bk
from quarry.operators import tokens
from quarry.sources import readers, sinks
from quarry.streaming.token_stream import prefix_counts_from_files

from conftest import SF_SMALL


def test_scanner_schema_keeps_dash_strings(spark, scratch):
    # Micro-fixture "ports_csv" (Q3): values like 2000-12 must give 2 ports.
    path = f"{scratch}/profile.csv"
    with open(path, "w") as fh:
        fh.write("numports,ports_scanned_str,mirai,extra\n2,2000-12,true,x\n2,80-443,false,y\n")
    df = readers.read_scanner_profile(spark, path)
    assert dict(df.dtypes) == {"numports": "int", "ports_scanned_str": "string", "mirai": "boolean", "extra": "string"}
    items = [r["items"] for r in bk.to_items(df, "ports_scanned_str").orderBy("extra").collect()]
    assert items == [["2000", "12"], ["80", "443"]]


def test_read_lines(spark, scratch):
    path = f"{scratch}/tweets.txt"
    with open(path, "w") as fh:
        fh.write("#a b\n  #a\n")
    got = {r["token"]: r["n"] for r in tokens.prefix_counts(readers.read_lines(spark, path), "#").collect()}
    assert got == {"#a": 2}


def test_sinks_round_trip(spark, scratch):
    df = spark.createDataFrame([("#a", 3), ("#b", 1)], "token string, n long")
    sinks.write_pairs_text(df, f"{scratch}/pairs", "token", "n")
    lines = sorted(r["value"] for r in spark.read.text(f"{scratch}/pairs").collect())
    assert lines == ["('#a', 3)", "('#b', 1)"]
    sets = spark.createDataFrame([(["a", "b"], 4)], "items array<string>, n long")
    sinks.write_result(sets, f"{scratch}/sets")
    back = spark.read.option("header", True).csv(f"{scratch}/sets").first()
    assert back["items"] == "a-b" and back["n"] == "4"
    sinks.write_csv(df, f"{scratch}/plain", header=False)
    assert spark.read.csv(f"{scratch}/plain").count() == 2


def test_stream_over_arriving_files_equals_batch(spark, scratch):
    src = f"{scratch}/days"
    os.makedirs(src)
    texts = {"day1.txt": "#x #y\n#x\n", "day2.txt": "#y #z\n", "day3.txt": "no tags\n#x\n"}
    for name, body in texts.items():
        with open(f"{src}/{name}", "w") as fh:
            fh.write(body)
    streamed = prefix_counts_from_files(spark, src, "value string", "#", "value", fmt="text", multi_line=False, max_files_per_trigger=1)
    got = {r["token"]: r["n"] for r in streamed.collect()}
    batch = {r["token"]: r["n"] for r in tokens.prefix_counts(spark.read.text(src), "#").collect()}
    assert got == batch == {"#x": 3, "#y": 2, "#z": 1}


def test_entry_and_registry(spark):
    import __spark_entry__ as entry_mod

    out = entry_mod.entry(spark)
    assert out.columns == ["item_1", "item_2", "n"]
    assert out.count() >= 0
    qs = entry_mod.queries()
    oracles = entry_mod.oracle_sql()
    assert set(oracles) <= set(qs)
    assert len(qs) >= 30


@pytest.mark.parametrize(
    "name",
    ["prefix_token_counts", "count_change_full", "frequent_pairs", "frequent_triples", "extreme_rows",
     "group_profile", "silhouette", "weighted_f1", "one_hot_top_k"],
)
def test_oracles_at_smallest_scale(spark, name):
    import __spark_entry__ as entry_mod

    con = duckdb.connect()
    for path in glob.glob(f"{SF_SMALL}/*.parquet"):
        t = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    df = entry_mod.queries()[name](spark, SF_SMALL)
    res = con.execute(entry_mod.oracle_sql()[name])
    d_cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(d_cols)

    def norm(cols, rows):
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        return sorted(
            tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order) for r in rows
        )

    assert norm(df.columns, [tuple(r) for r in df.collect()]) == norm(d_cols, res.fetchall())


def test_prefix_filter_reaches_scan(spark):
    from quarry.sources import driver_tables as dt

    counts = tokens.text_prefix_counts(dt.document_text(spark, SF_SMALL), "th")
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "StringContains(text,th)" in plan  # pushed to the parquet scan
    assert "ReadSchema: struct<text:string>" in plan  # only the text column is read
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_pair_lines_quote_like_python(spark):
    keys = ["plain", "don't", 'say "hi"', "both ' and \"", "back\\slash", "tab\there", "nl\nx", "é#"]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "token string, n long")
    got = [r["value"] for r in sinks.pair_lines(df, "token", "n").collect()]
    assert got == [str((k, i)) for i, k in enumerate(keys)]


def test_entry_runs_from_another_directory(tmp_path):
    # Python workers must import the package even when the caller's working
    # directory is elsewhere (the package is shipped with addPyFile).
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "import __spark_entry__ as e\n"
        "print('ROWS', len(e.entry(s).collect()))\n"
        "s.stop()\n"
    ) % repo
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "ROWS 159" in out.stdout


@pytest.mark.parametrize("files", [0, 1, 3])
def test_stream_reads_a_table_that_is_a_folder(spark, scratch, files):
    from quarry.plans.token_plans import prefix_token_counts, prefix_token_counts_stream

    docs = spark.createDataFrame([(i, f"the that {'th' + str(i % 3)} x\nthe other") for i in range(30)], "doc_id long, text string")
    docs.limit(30 if files else 0).repartition(files or 1).write.parquet(f"{scratch}/documents.parquet")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(prefix_token_counts_stream(spark, scratch)) == rows(prefix_token_counts(spark, scratch))
    docs.coalesce(1).write.parquet(f"{scratch}/one")
    [part] = glob.glob(f"{scratch}/one/part-*.parquet")
    os.mkdir(f"{scratch}/single")
    os.link(part, f"{scratch}/single/documents.parquet")
    got = rows(prefix_token_counts_stream(spark, f"{scratch}/single/"))
    assert got == [("th0", 10), ("th1", 10), ("th2", 10), ("that", 30), ("the", 60)]
