"""Empty tables, and one very long text among short ones, through the operators."""

from __future__ import annotations

import hashlib

import pytest

from quarry.llm import decontaminate, exact, lines, packing, simhash, substring
from tests.llm.test_llm import DOCS, docs_of

LONG = "\n".join(" ".join(f"word{(7 * i + j) % 9973}" for j in range(10)) for i in range(8000))  # 80,000 words
ROWS = [(1, LONG), (2, "short text of a few words"), (3, LONG), (4, None), (5, LONG + " end")]


@pytest.mark.parametrize(
    "run",
    [
        simhash.near_duplicates,
        simhash.drop_near_duplicates,
        exact.exact_classes,
        exact.exact_dedup,
        packing.pack_documents,
        lines.line_dedup,
        substring.substring_dedup,
    ],
    ids=lambda f: f.__name__,
)
def test_no_documents(spark, run):
    assert run(spark.createDataFrame([], DOCS)).collect() == []


def test_a_long_text_is_deduplicated(spark):
    got = {r.doc_id: r for r in exact.exact_classes(docs_of(spark, ROWS)).collect()}
    assert (got[1].keep_id, got[3].kept, got[5].group_size) == (3, True, 1)
    assert got[3].text_sha256 == hashlib.sha256(LONG.encode()).hexdigest()
    near = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs_of(spark, ROWS)).collect()}
    assert near[1] == near[3] == near[5] == 1 and near[2] == 2
    rest = {r.doc_id: (r.n_lines, r.n_removed) for r in lines.line_dedup(docs_of(spark, ROWS)).collect()}
    assert rest[1] == (8000, 0) and rest[3] == (8000, 8000) and rest[5] == (8000, 7999)


def test_a_long_text_is_searched_and_packed(spark):
    items = spark.createDataFrame([(9, " ".join(LONG.split()[40_000:40_012])), (10, "nowhere to be found in any of these long texts")], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.contamination(docs_of(spark, ROWS), items).collect()}
    assert got[1].n_words == 80_000 and got[1].n_items == 1 and got[1].n_hit >= 12 and not got[2].contaminated
    pieces = packing.pack_documents(docs_of(spark, ROWS)).collect()
    for doc in (1, 3, 5):
        own = sorted((r for r in pieces if r.doc_id == doc), key=lambda r: r.start)
        assert [r.start for r in own] == [sum(p.length for p in own[:n]) for n in range(len(own))]
        assert sum(r.length for r in own) == own[0].doc_tokens > 80_000
