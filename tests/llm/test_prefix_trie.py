"""The trie of rebuilt conversations against DuckDB, which compares whole lists of turns; list ranks against a plain walk."""

import random

import duckdb
import pandas as pd
import pytest
from compare import difference

from contrail.llm import list_ranking, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, node string, hi string"


def compare(spark, rows, **ranking):
    frame = spark.createDataFrame([(*r, "clash", None, "x") for r in rows], SCHEMA).repartition(5)
    con = duckdb.connect()
    known = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"])
    con.register("known", known.astype({"conv_id": "Int64", "turn": "Int64", "role": "string", "text": "string"}))
    con.execute("CREATE VIEW conversations AS SELECT conv_id, turn, role::VARCHAR AS role, text::VARCHAR AS text FROM known")
    got = prefix_trie.prefix_trie(frame, **ranking).cache()
    assert difference(got, con, prefix_trie.OP11_SQL) is None
    return {(r.conv_id, r.depth): r for r in got.collect()}


@pytest.mark.parametrize("ranking", [{}, {"sole": 60, "gap": 3, "parts": 13}])
def test_random_conversations(spark, ranking):
    rng = random.Random(11)
    rows = []
    for conv in rng.sample(range(1000), 250):
        for turn in range(rng.randint(1, 7)):
            rows.append((conv, turn if rng.random() < 0.9 else None, rng.choice(["user", "assistant", None]), rng.choice(["a", "bb", "", None])))
    nodes = compare(spark, rows, **ranking)
    root = nodes[min(r[0] for r in rows), 0]
    assert root.n_convs == 250 and root.parent_conv_id is None
    assert root.n_leaves == sum(r.n_children == 0 for r in nodes.values())


def test_odd_rows(spark):
    rows = [(0, 0, "user", "hi"), (0, 0, "user", "hi"), (0, 1, None, None), (None, 0, "user", "hi"), (-5, 3, "a", "x")]
    rows += [(101, 0, "user", "base is absent"), (102, None, "user", "é" * 9), (102, None, None, "\x00"), (103, 0, "a", "x" * 300_000)]
    rows += [(7, 0, "a", "b"), (8, 0, "a", "b"), (9, 0, "ab", ""), (10, 0, "", "ab")]
    assert compare(spark, rows)
    assert prefix_trie.op11(spark.createDataFrame([], SCHEMA)).count() == 0
    only = prefix_trie.op11(spark.createDataFrame([(101, 0, "a", "b", "", "", "")], SCHEMA)).collect()
    assert [(r.depth, r.n_leaves) for r in only] in ([(0, 1)], [(0, 1), (1, 1)])


def test_hot_conversation_and_hot_node(spark):
    rows = [(0, i, "user", f"turn {i % 7}") for i in range(1200)]
    rows += [(100 * c, 0, "user", "the same") for c in range(1, 1500)]
    rows += [(100 * c, 1, "user", f"own {c}") for c in range(1, 700)]
    nodes = compare(spark, rows, sole=100, parts=9)
    assert nodes[100, 1].n_convs == 1499 and nodes[100, 1].n_children == 699


def test_ends_are_streamed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 20)
    rows = [(100 * c, 0, "user", "the same") for c in range(300)]
    assert compare(spark, rows)[0, 1].n_convs == 300


@pytest.mark.parametrize(("n", "sole", "gap", "near"), [(1, 1, 2, 1), (700, 60, 3, 700), (3000, 50, 16, 40), (900, 5000, 16, 900)])
def test_positions(spark, n, sole, gap, near):
    """`near` is how far apart in the list ids of one neighbourhood may be."""
    rng = random.Random(n)
    ids = [10 * i for i in range(n)]
    for start in range(0, n, near):
        part = ids[start : start + near]
        rng.shuffle(part)
        ids[start : start + near] = part
    rows = list(zip(ids, [*ids[1:], -1]))
    rng.shuffle(rows)
    links = spark.createDataFrame(rows, "id long, next long")
    got = list_ranking.positions(links, ids[0], parts=7, sole=sole, gap=gap)
    assert {r.id: r.position for r in got.collect()} == {x: i for i, x in enumerate(ids)}
