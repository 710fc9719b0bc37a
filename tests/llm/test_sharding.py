"""Virtual slots: the map's edits, its versions, and every row's place, against DuckDB."""

import random
import zlib
from collections import Counter

import duckdb
import pandas as pd
import pytest
from compare import difference

from contrail.llm import sharding
from contrail.session import scratch

SCHEMA = "doc_id long, text string, shard string, slot string, size string"


def compare(spark, rows):
    frame = spark.createDataFrame([(*r, "clash", None, "x") for r in rows], SCHEMA).repartition(5)
    con = duckdb.connect()
    known = pd.DataFrame(rows, columns=["doc_id", "text"]).astype({"doc_id": "Int64", "text": "string"})
    con.register("known", known)
    con.execute("CREATE VIEW documents AS SELECT doc_id, text::VARCHAR AS text FROM known")
    got = sharding.op12(frame)
    assert difference(got, con, sharding.OP12_SQL) is None
    return got.collect()


def test_places_and_growth(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["", "é", "word " * rng.randint(1, 50), None])) for i in range(3000)]
    rows += [(None, "no id"), (None, None), (1, "other text of id 1"), (-7, "x" * 5_000)]
    rows += [(4242, "a repeated row")] * 1500
    got = compare(spark, rows)
    for shard in range(8):
        own = sorted(r.slot for r in got if r.shard == shard)
        assert own == list(range(len(own))) and own
    assert all(r.grown_shard in (r.shard, 8) for r in got)
    assert {r.text_crc32 for r in got if r.doc_id == 4242} == {zlib.crc32(b"a repeated row")}
    assert compare(spark, []) == []


def test_a_part_of_the_rows_gets_the_same_shards(spark):
    rows = [(i, f"text {i}", "", "", "") for i in range(500)]
    whole = {r.doc_id: r.shard for r in sharding.op12(spark.createDataFrame(rows, SCHEMA)).collect()}
    some = {r.doc_id: r.shard for r in sharding.op12(spark.createDataFrame(rows[100:130], SCHEMA)).collect()}
    assert some == {i: whole[i] for i in some} and len(some) == 30


@pytest.mark.parametrize("shards", [1, 2, 8, 31])
def test_growth_and_removal(shards):
    found = sharding.map_for(shards, 1000)
    grown = found.grown()
    sizes = Counter(grown.shards)
    assert len(sizes) == shards + 1 and max(sizes.values()) - min(sizes.values()) <= 1
    assert {grown.shards[s] for s in found.moved(grown)} == {shards}
    assert grown == sharding.map_for(shards + 1, 1000)
    gone = grown.without(0)
    sizes = Counter(gone.shards)
    assert len(sizes) == shards and sum(sizes.values()) == 1000
    assert sum(a != b and a not in (0, shards) for a, b in zip(grown.shards, gone.shards)) == 0


def test_balance_by_bytes(spark):
    rng = random.Random(9)
    weights = [int(rng.paretovariate(1.2) * 1000) for _ in range(4096)]
    found = sharding.map_for(8)
    even = found.balanced(weights)
    load = lambda m: [sum(w for w, s in zip(weights, m.shards) if s == k) for k in range(8)]
    assert max(load(even)) <= max(load(found))
    assert max(load(even)) <= max(sum(weights) / 8 * 1.01, max(weights))
    assert even.version == found.version + 1 and len(found.moved(even)) < 1000
    one = [0] * 4096
    one[5] = 1 << 40
    assert found.balanced(one).moved(found) == []


def test_versions_are_kept(spark):
    path = scratch(spark, "shard-map")
    first = sharding.map_for(3, 64)
    second = first.balanced(range(64))
    for found in (first, second):
        sharding.save_map(spark, found, path)
    assert sharding.load_map(spark, path) == second
    assert sharding.load_map(spark, path, first.version) == first
    with pytest.raises(Exception, match="(?i)exists"):
        sharding.save_map(spark, first, path)
    with pytest.raises(ValueError, match="no whole map"):
        sharding.load_map(spark, path, 99)


def test_written_shards(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(400)] + [(None, None)], "doc_id long, text string")
    found, path = sharding.map_for(4), scratch(spark, "shards")
    sharding.write_shards(docs, found, path)
    back = spark.read.parquet(f"{path}/map={found.version}").collect()
    want = {r.id: found.shards[r.virtual_slot] for r in sharding.sized(docs).collect()}
    assert {r.doc_id: r["shard"] for r in back} == want and len(back) == 401
