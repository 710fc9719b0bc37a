"""Exact round trips of the coder and of the files."""

import random
from zlib import crc32

import numpy as np
import pytest

from contrail.llm import coder, token_store
from contrail.llm.tokens import Encoder, tokenizer_path
from contrail.session import scratch

SCHEMA = "doc_id long, text string, start string, part int"


def samples():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 5, 127, 128, 129, 1000, 40_000):
        yield rng.integers(0, 50_000, n)
        yield np.zeros(n, int)
        yield rng.zipf(1.3, n) % 49_000
        yield np.tile([5, 6, 7, 8], n)[:n]
        yield np.full(n, (1 << 18) - 1)


def test_round_trips():
    for ids in samples():
        assert (coder.decode(coder.encode(ids)) == ids).all()
    with pytest.raises(ValueError):
        coder.encode(np.array([1 << 18]))


def test_predictions_pay():
    rng = np.random.default_rng(1)
    text = np.tile(rng.integers(0, 49_000, 3000), 60)  # order 2 knows it after the first time
    assert len(coder.encode(text)) < 0.5 * len(text)
    some = rng.integers(0, 200, 100_000)  # order 0: 200 ids are 7.6 bits
    assert len(coder.encode(some)) < 1.15 * len(some)


def test_damage_is_found():
    block = coder.encode(np.random.default_rng(2).integers(0, 3000, 2000))
    rng = random.Random(3)
    for _ in range(60):
        at = rng.randrange(len(block))
        with pytest.raises(ValueError):
            coder.decode(block[:at] + bytes([block[at] ^ rng.randint(1, 255)]) + block[at + 1 :])
    for cut in (0, 3, 19, 25, len(block) - 1):
        with pytest.raises(ValueError):
            coder.decode(block[:cut])


def plain(rows):
    own = Encoder(tokenizer_path(token_store.TOKENIZER), False)
    start, out = 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = own.whole([text or ""])[0] + (1).to_bytes(4, "little")
        out.append((doc, start, len(ids) // 4, crc32(ids)))
        start += len(ids) // 4
    return out


def test_files(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i * 7 % 1009, " ".join(rng.choice(["One", "two", "três", "x1"]) for _ in range(rng.randrange(50)))) for i in range(400)]
    rows += [(2000, None), (2001, ""), (None, "no id"), (-5, "word " * 50_000)]
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(7)
    for size in (1 << 19, 500):
        monkeypatch.setattr(token_store, "BLOCK_IDS", size)
        assert sorted(map(tuple, token_store.op8(frame).collect()), key=str) == sorted(plain(rows), key=str)
    same = spark.createDataFrame([(3, "a b", "", 0)] * 5 + [(1, "c", "", 0)], SCHEMA)
    assert sorted(map(tuple, token_store.op8(same).collect())) == plain([(3, "a b")] * 5 + [(1, "c")])
    assert token_store.op8(same.limit(0)).count() == 0


def test_ids_come_back(spark):
    path = scratch(spark, "ids")
    token_store.write(spark.createDataFrame([(2, "Hello world", "", 0), (1, None, "", 0)], SCHEMA), path)
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in token_store.read(spark, path).collect()}
    own = Encoder(tokenizer_path(token_store.TOKENIZER), False).tokenizer
    assert got == {1: [1], 2: [*own.encode("Hello world", add_special_tokens=False).ids, 1]}


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, token_store.op8(docs).collect())) == plain(rows)


def test_rows_alike_are_split(spark):
    rows = spark.range(6000, numPartitions=4).selectExpr("if(id % 3 < 2, 7, id) AS doc_id", "if(id % 3 < 2, 'same words', 'w' || id) AS text")
    path = scratch(spark, "hot-ids")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        token_store.write(rows, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = token_store.read(spark, path).groupBy("part").count().collect()
    assert sum(r["count"] for r in parts) == 6000 and max(r["count"] for r in parts) < 2000
    assert token_store.digests(spark, path).select("start").distinct().count() == 6000
