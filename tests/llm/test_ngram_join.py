"""Links and groups against comparing all pairs."""

import random
import re

import pytest

from contrail.llm import ngram_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_set(text, n):
    words = WORD.findall((text or "").translate(LOWER))
    if 0 < len(words) < n:
        return {tuple(words)}
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def plain_groups(rows, n, percent):
    sets = [plain_set(text, n) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), doc), doc)
    return sorted((doc, len(sets[i]), low[find(i)]) for i, (doc, _) in enumerate(rows))


def corpus(seed, n_docs):
    """Chains of edits, groups of near copies, copies, shared passages, short and odd texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeÉ") for _ in range(rng.randint(1, 4)))
    passage = [word() for _ in range(30)]
    texts = ["", " \n", "one", "One", "ONE two", "one\ttwo", "É", "é", "a\x0bb\x0cc\x1cd", "x " * 5000]
    base = [word() for _ in range(120)]
    while len(texts) < n_docs:
        kind = rng.randrange(6)
        if kind == 0:
            base = [word() for _ in range(rng.randint(1, 150))]
        elif kind == 1:
            texts.append(" ".join(base + passage))
        elif kind == 2:
            texts.append(" ".join(base).upper())
        edited = list(base)
        for _ in range(rng.randrange(6)):
            edited[rng.randrange(len(edited))] = word()
        if kind == 3:
            base = edited
        texts.append("  ".join(edited))
    return list(enumerate(texts))


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80)])
def test_groups_are_those_of_all_pairs(spark, n, percent):
    rows = corpus(n, 500)
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "text AS size", "1 AS id")
    got = ngram_join.groups(frame, n=n, percent=percent).select("id", "n_shingles", "component_id").collect()
    want = plain_groups(rows, n, percent)
    assert sorted(map(tuple, got)) == want
    assert any(c != d for d, _, c in want)


def test_stage_keeps_one_of_a_group(spark):
    rows = corpus(9, 200) + [(None, None), (None, "all alone here"), (7000, "same id"), (7000, "other words")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS _gone")
    kept = ngram_join.drop_near_copies(frame)
    assert kept.columns == frame.columns
    got = sorted((r.doc_id for r in kept.collect()), key=str)
    firsts = {c for _, _, c in plain_groups(corpus(9, 200), 5, 80)}
    assert got == sorted([*firsts, None, None, 7000, 7000], key=str)


def test_query_on_odd_rows(spark):
    rows = [(3, "a b c d"), (3, "a b c d"), (2, "A b C d"), (None, None), (4, None), (5, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, ngram_join.op6(frame).collect()), key=str)
    assert got == sorted([(3, 2, 2), (3, 2, 2), (2, 2, 2), (None, 0, None), (4, 0, 4), (5, 0, 5)], key=str)
    assert ngram_join.op6(frame.limit(0)).collect() == []


def test_a_hot_group_of_near_copies(spark):
    """Edits of one text: most link to it, some only through others, some not at all."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(100)]
    rows = [(0, " ".join(base))]
    for i in range(1, 300):
        edited = list(base)
        for _ in range(rng.randint(1, 6)):
            edited[rng.randrange(100)] = rng.choice(["p", "q", f"r{i}"])
        rows.append((i, " ".join(edited)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, ngram_join.op6(frame).collect())) == plain_groups(rows, 3, 90)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, ngram_join.op6(docs).collect())) == plain_groups(rows, 3, 90)
