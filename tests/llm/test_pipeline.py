"""The pipeline, stage by stage, against plain runs of what each stage is to do."""

from collections import defaultdict

import test_ngram_join
from pyspark.sql import functions as F

import corpus_pipeline
from contrail.llm import mixing, packing
from contrail.llm.tokens import Encoder, tokenizer_path

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "ngram_join", "mixing", "packing"]
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    junk = [(90001, None, "en"), (90002, "", "en"), (90003, "12 34 -- 56", "de"), (None, "no id but words of the text", "en")]
    junk = spark.createDataFrame([(*r, "src0", len(r[1] or "")) for r in junk], documents.schema)
    docs = documents.union(junk).withColumn("extra", F.lit("kept"))
    stages = dict(corpus_pipeline.STAGES)

    known = stages["language_id"](spark, docs, SF_DIR)
    assert known.columns == docs.columns
    assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in known.collect()} == {90001, 90002, 90003}

    single = stages["exact_dedup"](spark, known, SF_DIR)
    rows = known.collect()
    first = {}
    for r in rows:
        first[r.text] = min(first.get(r.text, r.doc_id), r.doc_id) if r.doc_id is not None else None
    assert single.columns == docs.columns
    assert sorted((r.doc_id for r in single.collect()), key=str) == sorted(first.values(), key=str)

    apart = stages["ngram_join"](spark, single, SF_DIR)
    pairs = [(r.doc_id if r.doc_id is not None else -1, r.text) for r in single.collect()]
    firsts = {c for _, _, c in test_ngram_join.plain_groups(pairs, 5, 80)}
    assert apart.columns == docs.columns
    assert {-1 if r.doc_id is None else r.doc_id for r in apart.collect()} == firsts

    mixed = stages["mixing"](spark, apart, SF_DIR)
    taken = mixing.mix(apart, mixing.words(F.col("text"))).select("row.source", "taken").collect()
    want, got = defaultdict(int), defaultdict(int)
    for r in taken:
        want[r.source] += r.taken
    for r in mixed.collect():
        got[r.source] += len(r.text.split())
    assert mixed.columns == docs.columns and {s: n for s, n in want.items() if n} == dict(got)

    packed = stages["packing"](spark, mixed, SF_DIR).collect()
    own = Encoder(tokenizer_path(packing.TOKENIZER), True)
    tokens = sum(len(own.whole([r.text])[0]) // 4 + 1 for r in mixed.collect())
    assert sum(r.length for r in packed) == tokens
    assert len({r.sequence_id for r in packed}) <= -(-tokens // 1024) * 1.01 + 1


def test_run(spark):
    out = corpus_pipeline.run(spark, SF_DIR)
    assert out.count() > 0 and "sequence_id" in out.columns
