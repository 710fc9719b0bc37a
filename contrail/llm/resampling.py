"""Importance resampling towards a target: hashed n-gram features, log ratios, Gumbel top-k."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache
from zlib import crc32

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import running, stored

# Buckets of features, words that a document needs to be drawn, share drawn, and the draw's seed.
BUCKETS, MIN_WORDS, PERCENT, SEED = 10_000, 20, 10, 2024

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
# What separates words. Of a character beyond ASCII every byte is 0x80 or more, so bytes will do.
_SEPARATORS = regex.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@cache
def _runs(n: int) -> regex.Pattern:
    """Runs of `n` words in a text whose separators are single spaces; they start and end with a word."""
    return regex.compile(rb"(?<![^ ])(?:[^ ]+ ){%d}[^ ]+(?![^ ])" % (n - 1))


def features(text: str | None, max_n: int = 1, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """Number of words of a whole text, and the buckets of its runs of 1 to `max_n` words, repeats too."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER)
    line = _SEPARATORS.sub(b" ", raw).strip(b" ")
    found = [
        np.fromiter((crc32(m[0]) for m in _runs(n).finditer(line, overlapped=True)), np.uint32)
        for n in range(1, max_n + 1)
    ]
    return len(found[0]), np.concatenate(found) % np.uint32(buckets)


def scanned(docs: DataFrame, id_col: str, text_col: str, max_n: int, buckets: int, name: str) -> DataFrame:
    """(id, row, n_words, features) of every row, stored: a text is scanned once. `row` is any number of its own."""

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [features(text, max_n, buckets) for text in frame["_text"]]
            yield pd.DataFrame(
                {
                    "id": frame["_id"].astype("Int64"),
                    "row": frame["_row"],
                    "n_words": [n for n, _ in found],
                    "features": [f.astype(np.uint32).tobytes() for _, f in found],
                }
            )

    rows = docs.select(
        F.col(id_col).cast("long").alias("_id"),
        F.col(text_col).alias("_text"),
        F.monotonically_increasing_id().alias("_row"),
    )
    return stored(rows.mapInPandas(scan, "id long, row long, n_words long, features binary"), name)


def bucket_counts(rows: DataFrame, buckets: int) -> np.ndarray:
    """How many features of all `rows` fall in each bucket; a task sends its sums, the driver gets `buckets` rows."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for frame in frames:
            for packed in frame["features"]:
                total += np.bincount(np.frombuffer(packed, np.uint32), minlength=buckets)
        used = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": used, "n": total[used]})

    found = np.zeros(buckets, np.int64)
    for row in rows.select("features").mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        found[row["bucket"]] = row["n"]
    return found


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's share in the target and in the source, one added to each count."""
    n, s, t = len(source), int(source.sum()), int(target.sum())
    ratio = lambda i: float((int(target[i]) + 1) * (s + n)) / float((int(source[i]) + 1) * (t + n))
    return np.array([math.floor(1000 * math.log(ratio(i))) for i in range(n)], np.int64)


def gumbel(doc_id: Column, seed: int) -> Column:
    """Thousandths of a Gumbel variate that the id and the seed decide; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def importance(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    max_n: int = 1,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """(id, row, n_words, n_features, weight, score) of every row of `docs`.

    Words are lower-cased runs of letters, digits and characters beyond ASCII; features are runs of 1 to
    `max_n` of them, hashed into `buckets`. `weight` is the floored mean of the gains of a document's
    features, 0 without any; `score` adds a Gumbel variate, so that the highest scores are a draw without
    replacement in proportion to the weights' exponential. Null and empty texts have no features. Rows that repeat an id get
    the same variate. An empty target makes all its counts 0. Other columns play no part.

    All rows of both tables count; a task holds one count a bucket and one batch of texts.
    """
    rows = scanned(docs, id_col, text_col, max_n, buckets, "resampling-features")
    wanted = scanned(target.withColumn("_none", F.lit(None).cast("long")), "_none", target_col, max_n, buckets, "resampling-target")
    gain = docs.sparkSession.sparkContext.broadcast(gains(bucket_counts(rows, buckets), bucket_counts(wanted, buckets)))

    def weigh(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [gain.value[np.frombuffer(f, np.uint32)] for f in frame["features"]]
            frame["n_features"] = [len(g) for g in found]
            frame["weight"] = [int(g.sum()) // max(len(g), 1) for g in found]
            yield frame[["id", "row", "n_words", "n_features", "weight"]].astype({"id": "Int64"})

    weighed = rows.mapInPandas(weigh, "id long, row long, n_words long, n_features long, weight long")
    weighed = stored(weighed, "resampling-weights")
    return weighed.withColumn("score", F.col("weight") + gumbel(F.col("id"), seed))


def ranked(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """`scored` with `rank`: of rows with `min_words` words, the `percent` % of highest score are numbered from 1.

    The share is rounded down; ties go to the smaller id, null ids last; rows of one id and score are
    numbered in any order. Other rows have a null rank. Places are prefix sums over ranges, so that no task sees all rows.
    """
    able = F.col("n_words") >= min_words
    drawn = scored.filter(able).count() * percent // 100
    keyed = scored.filter(able).withColumns({"_low": -F.col("score"), "_no_id": F.col("id").isNull()})
    places = running(keyed, [], ["_low", "_no_id", "id", "row"], {"_place": F.lit(1)}, "resampling-places")
    rank = F.when(F.col("_place") < drawn, F.col("_place") + 1).cast("long").alias("rank")
    rest = scored.filter(~able).select(*scored.columns, F.lit(None).cast("long").alias("rank"))
    return places.select(*scored.columns, rank).union(rest)


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, **options
) -> DataFrame:
    """The rows of `docs` that are drawn, in its columns. Rows with the id of a drawn one are drawn with it."""
    chosen = ranked(importance(docs, target, id_col, text_col, **options), percent).filter(F.col("rank").isNotNull())
    ids = chosen.select(F.col("id").alias("_drawn_id")).distinct()
    return docs.join(ids, F.col(id_col).cast("long").eqNullSafe(F.col("_drawn_id")), "left_semi")


def op13(docs: DataFrame, target: DataFrame) -> DataFrame:
    """The query's columns, for every document: single words, the benchmark's texts as the target."""
    scored = ranked(importance(docs.select("doc_id", "text"), target.select("text")))
    return scored.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


OP13_SQL = rf"""
WITH lowered AS (
  SELECT true AS own, doc_id, text FROM documents UNION ALL SELECT false, NULL, text FROM benchmark
),
numbered AS (SELECT *, row_number() OVER () AS row FROM lowered),
split AS (
  SELECT own, row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM numbered
),
words AS (SELECT own, row, unnest(w) AS word FROM split),
bytes AS (SELECT word, hex(encode(word)) AS hx FROM (SELECT DISTINCT word FROM words)),
crcs AS (
  SELECT word, xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(range(0, len(hx) // 2), lambda i:
                     list_transform(range(0, 8), lambda b: (('0x' || substr(hx, 2 * i + 1, 2))::BIGINT >> b) & 1))),
                   lambda c, bit: xor(c >> 1, (xor(c, bit) & 1) * 3988292384)), 4294967295) % {BUCKETS} AS bucket
  FROM bytes
),
feature AS (SELECT own, row, bucket FROM words JOIN crcs USING (word)),
counts AS (SELECT bucket, count(*) FILTER (own) AS s, count(*) FILTER (NOT own) AS t FROM feature GROUP BY bucket),
totals AS (SELECT sum(s)::BIGINT AS s_all, sum(t)::BIGINT AS t_all FROM counts),
gain AS (
  SELECT bucket, floor(1000 * ln(((t + 1) * (s_all + {BUCKETS}))::DOUBLE / ((s + 1) * (t_all + {BUCKETS}))::DOUBLE))::BIGINT AS gain
  FROM counts, totals
),
weighed AS (SELECT row, count(*) AS n_features, sum(gain)::BIGINT AS total FROM feature JOIN gain USING (bucket) WHERE own GROUP BY row),
scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features,
         coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0) AS weight,
         (('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296 AS u
  FROM split LEFT JOIN weighed USING (row) WHERE own
),
final AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln(u)))::BIGINT AS score FROM scored),
places AS (
  SELECT *, n_features >= {MIN_WORDS} AS able,
         row_number() OVER (PARTITION BY n_features >= {MIN_WORDS} ORDER BY score DESC, doc_id NULLS LAST) AS place,
         count(*) FILTER (n_features >= {MIN_WORDS}) OVER () AS n
  FROM final
)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= {PERCENT} * n // 100 THEN place END AS rank FROM places
"""
