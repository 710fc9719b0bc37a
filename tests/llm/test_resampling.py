"""Importance resampling: overlapped scans against plain word lists, draws against DuckDB and a plain sort."""

import random
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
from compare import difference

from contrail.llm import resampling

SCHEMA = "doc_id long, text string, score string, row string, rank string"
WORDS = "alpha Beta gamma-Ray d3lta é über ÉTÉ 中文 x1 don't under_score a b c".split()


def plain_words(text):
    words, word = [], ""
    for c in (text or "") + " ":
        if "A" <= c <= "Z":
            c = c.lower()
        if "0" <= c <= "9" or "a" <= c <= "z" or ord(c) >= 128:
            word += c
        elif word:
            words.append(word)
            word = ""
    return words


@pytest.mark.parametrize("max_n", [1, 2, 4])
def test_features(max_n):
    rng = random.Random(max_n)
    texts = [None, "", "  ", "-", "one", " a  b,c\x00d ", "İ K \x7f[x]`y{z}", "word " * 5000]
    texts += ["".join(rng.choice(WORDS) + rng.choice([" ", ", ", "\n", "--"]) for _ in range(rng.randint(0, 30))) for _ in range(200)]
    for text in texts:
        words = plain_words(text)
        runs = [" ".join(words[i : i + n]) for n in range(1, max_n + 1) for i in range(len(words) - n + 1)]
        count, found = resampling.features(text, max_n, 997)
        assert count == len(words)
        assert found.tolist() == [zlib.crc32(r.encode()) % 997 for r in runs]


def compare(spark, rows, target):
    frame = spark.createDataFrame([(*r, "clash", None, "x") for r in rows], SCHEMA).repartition(5)
    con = duckdb.connect()
    known = pd.DataFrame(rows, columns=["doc_id", "text"]).astype({"doc_id": "Int64", "text": "string"})
    con.register("known", known)
    con.execute("CREATE VIEW documents AS SELECT doc_id, text::VARCHAR AS text FROM known")
    con.register("wanted", pd.DataFrame({"text": pd.Series(target, dtype="string")}))
    con.execute("CREATE VIEW benchmark AS SELECT text::VARCHAR AS text FROM wanted")
    got = resampling.op13(frame, spark.createDataFrame([(t,) for t in target], "text string")).cache()
    assert difference(got, con, resampling.OP13_SQL) is None
    return got.collect()


def sentence(rng, least=0):
    return " ".join(rng.choice(WORDS) for _ in range(rng.randint(least, 40)))


def test_draw(spark):
    rng = random.Random(2)
    rows = [(i, sentence(rng)) for i in range(700)]
    rows += [(None, sentence(rng, 20)), (None, None), (3, None), (4, ""), (5, "alpha " * 60_000), (-9, "中 " * 19), (-8, "中 " * 20)]
    rows += [(77, "alpha beta " * 15)] * 400
    got = compare(spark, rows, ["alpha alpha beta", None, "", "unseen words"])
    able = sum(len(plain_words(t)) >= 20 for _, t in rows)
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, able // 10 + 1))
    assert len(got) == len(rows)


def test_empty_tables(spark):
    rng = random.Random(3)
    rows = [(i, sentence(rng, 20)) for i in range(50)]
    assert sum(r["rank"] is not None for r in compare(spark, rows, [])) == 5
    assert compare(spark, [], ["alpha"]) == []


def test_ties_go_to_the_smaller_id(spark):
    frame = spark.createDataFrame([(i, i, 20, 20, 0, 7) for i in (5, 3, 9, 1, 8, 2, 6, 4, 7, 0)] + [(None, 10, 20, 20, 0, 7)], "id long, row long, n_words long, n_features long, weight long, score long")
    got = {r.id: r["rank"] for r in resampling.ranked(frame, percent=50).collect()}
    assert got == {**dict.fromkeys([5, 6, 7, 8, 9, None]), 0: 1, 1: 2, 2: 3, 3: 4, 4: 5}


def test_the_draw_leans_to_the_target(spark):
    rng = random.Random(5)
    near = [(i, " ".join(rng.choice(["sun", "moon", "star"]) for _ in range(30))) for i in range(200)]
    far = [(1000 + i, " ".join(rng.choice(["tax", "form", "law"]) for _ in range(30))) for i in range(1800)]
    docs = spark.createDataFrame(near + far, "doc_id long, text string")
    target = spark.createDataFrame([("sun moon star " * 20,)], "text string")
    drawn = resampling.resample(docs, target, max_n=2)
    assert drawn.columns == ["doc_id", "text"]
    ids = [r.doc_id for r in drawn.collect()]
    assert len(ids) == 200 and np.mean([i < 1000 for i in ids]) > 0.6
