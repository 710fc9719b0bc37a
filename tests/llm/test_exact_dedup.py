"""Exact copies against DuckDB and a plain grouping."""

import pandas as pd
import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from contrail.llm import exact_dedup

SCHEMA = "doc_id long, text string, keep_id string, row string"
ROWS = [(1, "a"), (2, "A"), (3, "a"), (4, "a "), (5, None), (6, ""), (7, "\u00e9"), (8, "e\u0301"), (9, "a"), (9, "a")]
ROWS += [(None, "a"), (None, "only nulls"), (None, "only nulls"), (10, "x" * 300_000), (11, "x" * 300_000), (12, "x" * 299_999)]


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "clash", f"r{i}") for i, r in enumerate(rows)], SCHEMA).repartition(5)


def plain(rows, pick):
    groups = {}
    for doc, text in rows:
        groups.setdefault(text or "", []).append(doc)
    out = []
    for doc, text in rows:
        own = groups[text or ""]
        keep = pick([d for d in own if d is not None], default=None)
        out.append((doc, text, keep, len(own), doc == keep))
    return sorted(out, key=str)


@pytest.mark.parametrize("keep,pick", [("smallest", min), ("largest", max)])
@pytest.mark.parametrize("digest", [exact_dedup.content_hash, lambda text: F.lit(b"same"), lambda text: F.length(text)])
def test_collisions_stay_apart(spark, keep, pick, digest):
    got = exact_dedup.mark(frame(spark), keep=keep, digest=digest)
    rows = got.select("row.doc_id", "row.text", "keep_id", "group_size", "kept").collect()
    assert sorted(map(tuple, rows), key=str) == plain(ROWS, pick)
    assert got.select("row.*").columns == ["doc_id", "text", "keep_id", "row"]


def test_query_and_sql(spark):
    con = connect("/root/testdata/sf0.001")
    documents = pd.DataFrame(ROWS, columns=["doc_id", "text"]).astype({"doc_id": "Int64"})
    con.execute("DROP VIEW documents")
    con.register("documents", documents)
    assert difference(exact_dedup.op2(frame(spark)), con, exact_dedup.OP2_SQL) is None
    assert exact_dedup.op2(frame(spark, [])).count() == 0


def test_stage_leaves_one_row_of_a_group(spark):
    kept = exact_dedup.drop_copies(frame(spark))
    assert kept.columns == ["doc_id", "text", "keep_id", "row"]
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    want = [(1, "a"), (2, "A"), (4, "a "), (5, None), (7, "\u00e9"), (8, "e\u0301"), (None, "only nulls"), (10, "x" * 300_000), (12, "x" * 299_999)]
    assert got == sorted(want, key=str)


def test_hot_group(spark, monkeypatch):
    monkeypatch.setattr("contrail.plans.skew.HOT_ROWS", 10)
    rows = [(i, "copy" if i % 3 else f"text {i}") for i in range(900)]
    got = exact_dedup.mark(frame(spark, rows)).select("row.doc_id", "row.text", "keep_id", "group_size", "kept")
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows, min)
