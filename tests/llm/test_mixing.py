"""Targets and the mix against a plain run and DuckDB."""

import random
import re
from collections import Counter, defaultdict
from math import floor

import duckdb
import pandas as pd
from compare import difference
from pyspark.sql import functions as F

from contrail.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string, n_chars long, size string, target string"


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    """Share by weight, cut at the limit, share the excess again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    got, open_ = dict.fromkeys(order, 0.0), set(order)
    left = float(sum(sizes.values()))
    while left > 1e-9 and open_:
        unit = left / sum(weight[s] for s in open_)
        left = 0.0
        for s in list(open_):
            got[s] += unit * weight[s]
            if got[s] >= most * sizes[s]:
                left += got[s] - most * sizes[s]
                got[s] = float(most * sizes[s])
                open_.discard(s)
    return got


def documents(seed, n=300):
    rng = random.Random(seed)
    sources = ["hot"] * 8 + ["b", "é", "Z", "", None, "tiny"]
    rows = [(i, " ".join(["w"] * int(rng.expovariate(0.05))), rng.choice(sources)) for i in range(n)]
    rows += [(n, None, "hot"), (n + 1, "", "empty"), (n + 2, "one word\x1ftoo", "b"), (None, "no id", "b"), (5, "again", "b"), (5, "again", "b")]
    return rows


def frame(spark, rows):
    data = [(i, t, s, len(t or ""), "clash", None) for i, t, s in rows]
    return spark.createDataFrame(data, SCHEMA).repartition(6)


def test_query_against_sql_and_plain_targets(spark):
    for seed in (1, 2):
        rows = documents(seed)
        con = duckdb.connect()
        con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"}))
        got = mixing.op1(frame(spark, rows))
        assert difference(got, con, mixing.OP1_SQL) is None
        sizes = Counter()
        for _, text, source in rows:
            sizes[source] += len(WORD.findall(text or ""))
        want = plain_targets(sizes)
        marked = mixing.mix(frame(spark, rows), mixing.words(F.col("text"))).select("row.source", "size", "source_size", "target", "taken")
        taken = Counter()
        for r in marked.collect():
            taken[r.source] += r.taken
            assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * (1 + want[r.source])
            assert 0 <= r.taken <= 3 * r.size
        for source, target in want.items():
            assert abs(taken[source] - target) < 1.001  # exact to the word
        assert sorted(map(tuple, mixing.op1(frame(spark, rows)).collect()), key=str) == sorted(map(tuple, got.collect()), key=str)


def test_no_rows_and_no_words(spark):
    assert mixing.op1(frame(spark, [])).count() == 0
    got = mixing.op1(frame(spark, [(1, None, "a"), (2, " ", None)])).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2
    [only] = mixing.op1(frame(spark, [(1, "a b c", None)])).collect()
    assert (only.target, only.taken) == (3.0, 3)


def test_native(spark):
    plan = mixing.op1(frame(spark, documents(3)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_the_mix_itself(spark):
    rows = [(i, t, s) for i, t, s in documents(4) if i is not None and i != 5]
    rows += [(5000, "  first\tsecond \n third ", "few"), (5001, "x " * 100_000, "hot")]
    docs = frame(spark, rows)
    marked = {r.doc_id: r for r in mixing.op1(docs).collect()}
    text = {i: t for i, t, _ in rows}
    copies = defaultdict(list)
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    for r in mixed.collect():
        copies[r.doc_id].append(r.text)
        assert r.n_chars == len(r.text) and (text[r.doc_id] or "").startswith(r.text)
    for doc, r in marked.items():
        own = sorted((len(WORD.findall(t)) for t in copies[doc]), reverse=True)
        assert sum(own) == r.taken
        assert all(n == r.size for n in own[:-1])
    assert sum(floor(r.taken / r.size) for r in marked.values() if r.size) > 0


def test_rows_of_one_id_fall_in_all_ranges(spark):
    rows = [(0 if i % 3 else i, f"w{i} " * (i % 4), "hot", None, None, None) for i in range(30_000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    marked = mixing.keyed(docs, mixing.words(F.col("text")), mixing.text_hash(F.col("text")))
    some = marked.withColumn("_range", F.substring("_range", 1, 1)).groupBy("_range").count().collect()
    # Empty texts of the one id are alike: a sixth of all rows.
    assert len(some) == 16 and sorted(r["count"] for r in some)[-2] < 3000
    assert mixing.op1(docs).agg(F.sum("taken")).first()[0] == mixing.op1(docs).agg(F.sum("size")).first()[0]
