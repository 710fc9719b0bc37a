"""Licence scans against DuckDB, which tries every place, and against a plain reading."""

import random
import re

import duckdb
import pandas as pd
from compare import difference

from contrail.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, n_words string, labels string"


def plain_base(text):
    words = WORD.findall((text or "").translate(str.maketrans(licenses.UPPER, licenses.LOWER)))
    at, labels = [], set()
    for t in licenses.BASE:
        key = t.key.split()
        for i in range(len(words)):
            if words[i : i + len(key)] == key:
                at.append(i)
                labels.add(t.label)
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_scan_against_all_places(spark):
    rng = random.Random(7)
    vocabulary = sorted({w for t in licenses.TEMPLATES for w in t.text.split()}) + ["the", "É", "x1"]
    texts = [None, "", " -- ", "MIT license", "mit-License.", "cc\tby cc by SA", "cc by", "K İ 日本   x"]
    for _ in range(250):
        parts = []
        for _ in range(rng.randrange(6)):
            t = rng.choice(licenses.TEMPLATES)
            words = t.text.split()
            if rng.random() < 0.5:
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            parts += words[rng.randrange(3) :] if rng.random() < 0.3 else words
            parts += rng.choices(vocabulary, k=rng.randrange(4))
        text = rng.choice([" ", ", ", "\n// "]).join(parts)
        texts.append(rng.choice([text, text.upper(), text.title()]))
    data = [(i, t, "clash", None) for i, t in enumerate(texts)] + [(None, "apache license", None, None)] * 2
    got = licenses.op7(spark.createDataFrame(data, SCHEMA))
    documents = pd.DataFrame(data, columns=["doc_id", "text", "n_words", "labels"]).astype({"doc_id": "Int64"})
    con = duckdb.connect()
    con.register("documents", documents)
    assert difference(got, con, licenses.sql()) is None
    rows = {r.doc_id: r for r in got.collect()}
    for i, text in enumerate(texts):
        r = rows[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain_base(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
    long = "GNU general public\nlicense " * 30_000
    [r] = licenses.op7(spark.createDataFrame([(1, long, "", "")], SCHEMA)).collect()
    assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain_base(long)
    assert sum(r.labels != r.base_labels for r in rows.values()) > 50


def test_no_rows_and_native_plan(spark):
    found = licenses.op7(spark.createDataFrame([], SCHEMA))
    assert found.count() == 0
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
