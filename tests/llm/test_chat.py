"""Collapsed and rendered conversations against DuckDB, which compares whole lists of turns."""

import random

import duckdb
import pandas as pd
from compare import difference

from contrail.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, start string, prefix string"


def compare(spark, rows):
    frame = spark.createDataFrame([(*r, "clash", None) for r in rows], SCHEMA).repartition(5)
    con = duckdb.connect()
    known = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"])
    con.register("known", known.astype({"conv_id": "Int64", "turn": "Int64", "role": "string", "text": "string"}))
    con.execute("CREATE VIEW conversations AS SELECT conv_id, turn, role::VARCHAR AS role, text::VARCHAR AS text FROM known")
    got = chat.op9(frame)
    assert difference(got, con, chat.OP9_SQL) is None
    return {r.conv_id: r for r in got.collect()}


def test_snapshots_collapse(spark):
    rng = random.Random(3)
    rows, logged = [], []
    for conv in range(300):
        base = list(rng.choice(logged)) if logged and rng.random() < 0.7 else []
        base = base[: rng.randint(0, len(base))] if rng.random() < 0.5 else base
        base += [(rng.choice(["user", "assistant", None]), rng.choice("abc")) for _ in range(rng.randint(0, 3))]
        if not base:
            continue
        logged.append(base)
        first = rng.choice([0, 1, 10])
        rows += [(conv, first + i, role, text) for i, (role, text) in enumerate(base)]
    kept = compare(spark, rows)
    assert 0 < len(kept) < len(logged)


def test_odd_rows(spark):
    rows = [(1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, 1, None, None), (2, 0, "user", "hi"), (3, 5, "user", "hi")]
    rows += [(None, 0, "user", "hi"), (4, None, "user", ""), (4, 0, "user", None), (5, 0, "b", "x"), (5, 0, "a", "y")]
    rows += [(6, 0, "a", "y"), (6, 0, "a", "z"), (7, 0, "a", "x" * 300_000), (8, 0, "a", "é")]
    kept = compare(spark, rows)
    assert kept[1].text == "<|user|>\nhi\n<|end|>\n<|unknown|>\n\n<|end|>\n"
    assert not {2, 3, None} & set(kept)
    assert chat.op9(spark.createDataFrame([], SCHEMA)).count() == 0


def test_one_conversation_of_many_turns(spark):
    rows = [(9, i, "user" if i % 2 else "assistant", f"turn {i % 7}") for i in range(2000)]
    rows += [(8, i, role, text) for _, i, role, text in rows[:1999]] + [(7, i, r, t) for _, i, r, t in rows]
    kept = compare(spark, rows)
    assert set(kept) == {7}
