"""The pipeline and the registered queries."""

from __future__ import annotations

import re
from collections import defaultdict

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from quarry.llm import queries

SMALL = "/root/testdata/sf0.001"
NAMES = ("documents", "benchmark", "labels", "conversations", "embeddings", "pages")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


def test_every_operator_has_a_query():
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_with_sql(spark, oracle, name):
    got = queries.QUERIES[name](spark, SMALL)
    found = oracle.execute(queries.ORACLES[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(got.columns)
    rows = [tuple(r[c] for c in names) for r in got.collect()]
    assert sorted(map(str, rows)) == sorted(map(str, found.fetchall()))


def test_pipeline_stages(spark, oracle):
    """Each stage against a plain account of it, on what the stage before it kept."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.staged(stage(spark, docs, SMALL), name)
        assert docs.columns == columns
        kept.append({r.doc_id: r.text for r in docs.collect()})
    toxic, exact, near, clean = kept
    assert len(toxic) < 200
    largest = {}
    for i, t in toxic.items():
        largest[t] = max(i, largest.get(t, -1))
    assert set(exact) == set(largest.values())
    groups = spark.createDataFrame(sorted(exact.items()), "doc_id long, text string")
    from quarry.llm import simhash

    assert set(near) == {r.component_id for r in simhash.near_duplicates(groups).collect()}
    oracle.register("left_docs", __import__("pyarrow").table({"doc_id": list(near), "text": list(near.values())}))
    sql = queries.ORACLES["op3_decontamination"].replace("FROM documents", "FROM left_docs")
    assert set(clean) == {i for (i,) in oracle.execute(f"SELECT doc_id FROM ({sql}) WHERE NOT contaminated").fetchall()}


def test_pipeline_packs_what_is_left(spark):
    got = corpus_pipeline.run(spark, SMALL).collect()
    tokens = defaultdict(int)
    for r in got:
        tokens[r.doc_id] += r.length
    assert all(tokens[r.doc_id] == r.doc_tokens for r in got)
    lengths = defaultdict(int)
    for r in got:
        lengths[r.sequence_id] += r.length
    assert all(n == 4096 or (n < 4096 and np.bitwise_count(n) == 1) for n in lengths.values())
