"""Rank-order profiles against a plain reading of the method."""

import random
from collections import Counter
from zlib import crc32

from pyspark.sql import functions as F

from contrail.llm import language_id
from contrail.llm.language_id import Profiles, count_grams

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, guess string"


def plain_grams(text):
    text = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    found = Counter()
    for word in text.split():
        padded = f" {word} "
        for n in (1, 2, 3):
            for i in range(len(padded) - n + 1):
                gram = padded[i : i + n]
                if gram.strip() and " " not in gram[1:-1]:
                    found[gram] += 1
    return found


def packed(gram):
    code = 0
    for c in gram:
        code = code << 21 | (language_id.BLANK if c == " " else ord(c))
    return code


def test_grams_are_those_of_the_words(monkeypatch):
    rng = random.Random(4)
    texts = ["", " ", "a", "ab c", "  É1é??日本 x", "😀", "I", "İstanbul"]
    texts += ["".join(rng.choice("ab é.1") for _ in range(rng.randrange(60))) for _ in range(300)]
    for size in (1 << 20, 7):
        monkeypatch.setattr(language_id, "CHUNK", size)
        for text in texts:
            grams, counts = count_grams(text)
            assert dict(zip(grams.tolist(), counts.tolist())) == {packed(g): n for g, n in plain_grams(text).items()}
    assert len(count_grams(None)[0]) == 0


def plain_predict(profiles, text, length):
    own = sorted(((-n, packed(g)) for g, n in plain_grams(text).items()))[:length]
    if not own:
        return "und", 0.0
    best = None
    for lang in sorted(profiles):
        place = {g: i for i, g in enumerate(profiles[lang])}
        d = sum(abs(place[g] - i) if g in place else length for i, (_, g) in enumerate(own))
        if best is None or d < best[0]:
            best = d, lang
    return best[1], 1 - best[0] / (length * len(own))


def test_predict_is_the_out_of_place_distance():
    rng = random.Random(6)
    word = lambda a: "".join(rng.choice(a) for _ in range(rng.randint(1, 6)))
    texts = {k: " ".join(word(a) for _ in range(300)) for k, a in (("x", "abcde"), ("y", "cdefg"), ("z", "efgäö"))}
    lists = {
        k: [g for _, g in sorted((-n, packed(g)) for g, n in plain_grams(t).items())[:50]] for k, t in texts.items()
    }
    profiles = Profiles.of(lists, 50)
    for _ in range(300):
        text = " ".join(word(rng.choice(["abcde", "cdefg", "efgäö", "qrs", "1 "])) for _ in range(rng.randrange(30)))
        got, want = profiles.predict(text), plain_predict(lists, text, 50)
        assert got[0] == want[0] and abs(got[1] - want[1]) < 1e-12


def test_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = docs.select("doc_id", "lang").collect()
    truth = {r.doc_id: r.lang for r in rows}
    got = language_id.op5(docs).collect()
    assert len(got) == len(rows)
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) >= 0.98 * len(held)
    # Labels of held-out rows, ids and sources play no part.
    from pyspark.sql import functions as F

    other = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, "zz").otherwise(F.col("lang")))
    assert sorted(map(tuple, language_id.op5(other).collect())) == sorted(map(tuple, got))


def test_odd_rows(spark):
    data = [(1, "the cat and the hat", "en", ""), (3, "le chat et la souris", "fr", ""), (None, None, None, None)]
    data += [(5, "", "en", ""), (6, "123 456", None, ""), (7, "the the", None, ""), (7, "the the", None, "")]
    data += [(9, "the cat " * 200_000, None, "")]
    frame = spark.createDataFrame(data, SCHEMA)
    got = {(r.doc_id, r.lang_pred) for r in language_id.op5(frame).collect()}
    assert got >= {(None, "und"), (5, "und"), (6, "und"), (7, "en"), (9, "en")}
    kept = language_id.known_language(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 7, 7, 9]
    nothing = spark.createDataFrame([], SCHEMA)
    assert language_id.op5(nothing).count() == 0
    unlabelled = language_id.op5(frame.selectExpr("doc_id", "text", "cast(null AS string) AS lang"))
    assert {r.lang_pred for r in unlabelled.collect()} == {"und"}


def test_known_language_has_a_limit_from_the_labels(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    other = [(-1, "xyzzy qwv kjq"), (-2, "zx"), (-3, "Wkx qzj e vvq"), (-4, "Это текст a")]
    rows = docs.select("doc_id", "text", "lang").union(spark.createDataFrame(other, "doc_id long, text string").selectExpr("*", "null"))
    kept = {r.doc_id for r in language_id.known_language(rows).select("doc_id").collect()}
    assert kept == {r.doc_id for r in docs.select("doc_id").collect()}


def test_known_language_without_labels_keeps_all(spark):
    frame = spark.createDataFrame([(1, "some text", None, ""), (2, None, None, ""), (3, "12", None, "")], SCHEMA)
    assert sorted(r.doc_id for r in language_id.known_language(frame).collect()) == [1, 2, 3]


def test_counts_of_any_size_can_be_drawn_from(spark):
    rows = [(d, n) for n in (1, 7, 2000, 2001, 20_000, 10**11) for d in (0, 1, 21, 22, (1 << 30) - 1, (2000 << 30) // 2001, 107374182, 107374183)]
    frame = spark.createDataFrame(rows, "draw long, n long")
    got = frame.select("draw", "n", language_id.drawn(F.col("draw"), F.col("n"), 2000).alias("yes")).collect()
    assert all(r.yes == (r.draw * r.n < 2000 << 30) for r in got)
    assert {r.yes for r in got} == {True, False}
