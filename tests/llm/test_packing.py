"""Tokens and packing against plain runs."""

import random
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from contrail.llm import packing, tokens
from contrail.llm.tokens import Encoder, tokenizer_path

ODD_TEXTS = [
    "", " ", "  ", "\n", "a  b", " a", "a ", "it's don't I'LL", "a\n\nb", "a \n b", "\t\ta\r\nb", "x\xa0\n\ny", "a\u3000 b",
    "a <|endoftext|>  b", "\x1c\x1da b", "12 345  6", "é e\u0301 \u0301x", "日本 語", "a" * 300 + " b", "ΑΣ ΑΣ. Σ", "😀 👍🏽x", "\u2028a \u2028",
    "K İstanbul ﬁ", "\x00 \x00a",
]


def random_texts(n):
    rng = random.Random(5)
    alphabet = "abab  .,\n'st.,!1 2\n\t é日\u0301\xa0\u2003\u3000Σİ-_<|>\r\x0b\x1c\x85\u200b"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(n)]


@pytest.mark.parametrize("name,byte_level", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_ids_by_parts_are_ids_of_the_whole(name, byte_level, monkeypatch):
    own = Encoder(tokenizer_path(name), byte_level)
    texts = ODD_TEXTS + random_texts(20000)
    texts += ["one,two, three.\nFour\n", "ñu. ñu, ñu\nñu", "x,. y.,\n.z", "don't, Don'T.", "a.b, \nc", "Σ, σ. ä́."]
    texts += ["Été... ÉTÉ&&& (été)", "\nLa===\nla'S.-", "x_y ß* *ß \nÑ%'t", "Abc" * 40 + "," + " " + "b" * 99, "µ ª º, ×x ÷."]
    whole = own.whole(texts)
    for _ in range(2):
        assert list(own.encode(texts)) == whole
    assert max(map(len, own.known)) <= tokens.MAX_WORD
    monkeypatch.setattr(tokens, "MAX_WORDS", 50)
    assert list(own.encode(texts[:500])) == whole[:500]


MARKS = [",", ".", "!?", ";", ")", "...", "_", "="]


@pytest.mark.parametrize("name,byte_level", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_marks_beside_words_are_learned_apart(name, byte_level):
    words = ["alpha", "beta", "été", "gamma", "delta", "mañana"]
    texts = [f" {w}{a} {b}{w}\n{w}" for w in words for a in MARKS for b in MARKS]
    own = Encoder(tokenizer_path(name), byte_level)
    assert list(own.encode(texts)) == own.whole(texts)
    # Words with and without a blank, marks likewise, and white space.
    assert len(own.known) <= 2 * (len(words) + len(MARKS)) + 2


def test_words_met_of_late_are_not_learned_again(monkeypatch):
    monkeypatch.setattr(tokens, "MAX_WORDS", 100)
    monkeypatch.setattr(tokens, "AT_ONCE", 1)
    own = Encoder(tokenizer_path("byte_bpe_50k.json"), True)
    learned = Counter()
    letters = own._letters

    def counted(words):
        learned.update(words)
        return letters(words)

    monkeypatch.setattr(own, "_letters", counted)
    rare = ["".join(chr(97 + i // 26**k % 26) for k in range(3)) for i in range(2000)]
    texts = [f" common {' '.join(rare[i : i + 20])}" for i in range(0, len(rare), 20)]
    assert list(own.encode(texts)) == own.whole(texts)
    assert learned[" common"] == 1
    assert len(own.known) + len(own.earlier) <= 100


def check_plan(counts, capacity):
    """Places every piece once, gapless; returns the number of sequences."""
    filled = {}
    seen = Counter()
    for length, first, count, sequence, per, offset in packing.plan(counts, capacity):
        assert first == seen[length]
        seen[length] += count
        for i in range(count):
            filled.setdefault(sequence + i // per, []).append((offset + i % per * length, length))
    assert seen == Counter({k: n for k, n in counts.items() if n})
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(filled)


def test_plan_is_close_to_the_bound():
    rng = random.Random(1)
    for _ in range(200):
        capacity = rng.choice([10, 37, 1024])
        counts = Counter(rng.randint(1, capacity) for _ in range(rng.randrange(400)))
        used = check_plan(counts, capacity)
        bound = -(-sum(k * n for k, n in counts.items()) // capacity)
        assert used <= 11 * bound / 9 + 1
    assert check_plan({}, 1024) == 0
    assert check_plan({1024: 7, 1: 5000}, 1024) == 12


def optimum(lengths, capacity):
    """Fewest sequences, by trying every assignment."""
    best = len(lengths)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= lengths[i]:
                rooms[k] -= lengths[i]
                go(i + 1, rooms)
                rooms[k] += lengths[i]
        go(i + 1, [*rooms, capacity - lengths[i]])

    go(0, [])
    return best


def test_reduction_keeps_the_optimum():
    """Where the reduction alone settles an instance, it is settled as well as can be."""
    rng = random.Random(3)
    for _ in range(150):
        lengths = [rng.randint(4, 12) for _ in range(rng.randint(1, 8))]
        assert check_plan(Counter(lengths), 12) <= optimum(sorted(lengths, reverse=True), 12) + 1
    assert check_plan(Counter([7, 5, 8, 4, 9, 3, 6, 6]), 12) == 4


def test_cut():
    assert packing.cut(1, 4) == [(0, 1)]
    assert packing.cut(4, 4) == [(0, 4)]
    assert packing.cut(9, 4) == [(0, 1), (1, 4), (5, 4)]


def rows(spark, data):
    return spark.createDataFrame(data, "doc_id long, text string, length string, piece int")


def test_pack_documents(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["alpha", "beta", "x", "größe"]) for _ in range(rng.randrange(900))) for _ in range(150)]
    data = [(i, t, "clash", 3) for i, t in enumerate(texts)] + [(900, None, None, None), (901, "", "", 0), (None, "y", "", 0)]
    data += [(902, "same words", "", 0)] * 40
    got = packing.op4(rows(spark, data)).collect()
    own = Encoder(tokenizer_path(packing.TOKENIZER), True)
    want = Counter()
    for doc, text, *_ in data:
        ids = own.whole([text or ""])[0] + (2).to_bytes(4, "little")
        for i, (start, n) in enumerate(packing.cut(len(ids) // 4, 1024)):
            want[(doc, i, start, n, crc32(ids[4 * start : 4 * (start + n)]))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    filled = {}
    for r in got:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(filled) <= sum(r.length for r in got) // 1024 + 2


def test_pack_nothing(spark):
    empty = packing.op4(rows(spark, []))
    assert empty.count() == 0
    assert empty.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = packing.op4(docs)
    used = got.agg(F.countDistinct("sequence_id"), F.sum("length")).first()
    assert used[0] <= -(-used[1] // 1024) * 1.01 + 1


def test_pieces_alike_fall_in_all_ranges(spark):
    rows = spark.range(30_000, numPartitions=4).selectExpr("if(id % 3 = 0, 7, id) AS doc_id", "0 AS piece", "0L AS start", "5L AS length", "1L AS ids_crc32")
    assert packing.ranged(rows).groupBy("_range").count().agg({"count": "max"}).first()[0] < 60
    got = packing.pack(rows)
    assert got.count() == 30_000
    assert got.groupBy("sequence_id", "offset").count().filter("count > 1").count() == 0
