"""Language of a text by rank-order profiles of its character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import bounded

UNDETERMINED = "und"
# Length of a profile, and of the list of a document's n-grams that is compared with it.
PROFILE = 300
# Labelled documents of each language that the profiles are made from, on average: a share of
# them by a hash of the id, and all where there are fewer.
SAMPLE = 2000

# A text is in none of the languages if it scores less than this part of what all but this share of the
# documents that carry the language's label reach; texts unlike the labelled ones have room below those.
LOW, PART = 0.01, 0.5

# An n-gram of up to three letters is one integer, 21 bits a letter. A run of other characters
# counts as one blank, which has a code above all letters and only begins or ends an n-gram.
BITS = 21
BLANK = 0x110000
CHUNK = 1 << 20


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(BLANK)])


def _grams(codes: np.ndarray) -> np.ndarray:
    """N-grams that start in `codes`, but for its last two."""
    one = codes[:-2]
    two = codes[1:-1]
    first = one << BITS | two
    return np.concatenate(
        [
            one[one != BLANK],
            first[(one != BLANK) | (two != BLANK)],
            (first << BITS | codes[2:])[two != BLANK],
        ]
    )


def count_grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a whole text, and how often each occurs."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not text:
        return none
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    codes = np.where(_letters()[codes], codes, BLANK)
    codes = codes[(codes != BLANK) | (np.append(BLANK, codes[:-1]) != BLANK)]
    if not (codes != BLANK).any():
        return none
    codes = np.concatenate([[BLANK], codes, [BLANK] * (1 if codes[-1] == BLANK else 2)])
    # Bounded memory for any length: chunks overlap by two codes.
    parts = [np.unique(_grams(codes[i : i + CHUNK + 2]), return_counts=True) for i in range(0, len(codes) - 2, CHUNK)]
    if len(parts) == 1:
        return parts[0]
    grams, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return grams, np.bincount(where, np.concatenate([p[1] for p in parts])).astype(np.int64)


def _most_frequent(grams: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """The most frequent n-grams, in that order; ties by n-gram."""
    if len(grams) > most:
        least = np.partition(counts, -most)[-most]
        grams, counts = grams[counts >= least], counts[counts >= least]
    return grams[np.argsort(-counts, kind="stable")][:most]


@dataclass
class Profiles:
    """The most frequent n-grams of each language; rank `length` stands for an absent one."""

    languages: list[str]
    grams: np.ndarray
    ranks: np.ndarray
    length: int

    @classmethod
    def of(cls, lists: dict[str, list[int]], length: int) -> Profiles:
        languages = sorted(lists)
        grams = np.unique(np.array([g for x in lists.values() for g in x], np.int64))
        ranks = np.full((len(grams) + 1, len(languages)), length, np.int32)
        for k, language in enumerate(languages):
            own = np.array(lists[language], np.int64)
            ranks[np.searchsorted(grams, own), k] = np.arange(len(own))
        return cls(languages, grams, ranks, length)

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language of least out-of-place distance (ties: the first by name), and how near it is.

        1 means the same order, 0 that no n-gram is shared.
        """
        grams, counts = count_grams(text)
        if not len(grams) or not self.languages:
            return UNDETERMINED, 0.0
        own = _most_frequent(grams, counts, self.length)
        at = np.searchsorted(self.grams, own)
        at[at == len(self.grams)] = 0
        ranks = self.ranks[np.where(self.grams[at] == own, at, len(self.grams))]
        apart = np.abs(ranks - np.arange(len(own), dtype=np.int32)[:, None])
        apart[ranks == self.length] = self.length
        distance = apart.sum(0)
        best = int(distance.argmin())
        return self.languages[best], float(1 - distance[best] / (self.length * len(own)))


def drawn(draw: Column, count: Column, sample: int) -> Column:
    """Is a 30-bit draw among about `sample` of `count`? Divided and not multiplied, so that no count overflows."""
    return draw <= F.call_function("div", F.lit((sample << 30) - 1), count)


def learn(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample: int = SAMPLE,
    length: int = PROFILE,
) -> Profiles:
    """Profiles of every non-null value of `lang_col`; rows with a null label or text are left out.

    Only the profiles reach the driver, `length` n-grams a language. Without labelled rows there
    are none, and every text is undetermined.
    """
    bounded(labelled.sparkSession)
    rows = labelled.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    ).filter("lang IS NOT NULL AND text IS NOT NULL")
    counts = rows.groupBy("lang").count()
    draw = F.pmod(F.xxhash64(F.lit("profile"), "id"), F.lit(1 << 30))
    some = rows.join(F.broadcast(counts), "lang").filter(drawn(draw, F.col("count"), sample))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for lang, texts in frame.groupby("lang")["text"]:
                found = [count_grams(t) for t in texts]
                grams, where = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
                sums = np.bincount(where, np.concatenate([n for _, n in found]), minlength=len(grams))
                yield pd.DataFrame({"lang": lang, "gram": grams, "n": sums.astype(np.int64)})

    summed = some.select("lang", "text").mapInPandas(count, "lang string, gram long, n long")
    summed = summed.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # The distinct n-grams of the sample, cut to `length` in each of 64 parts and then in all.
    top = summed.selectExpr("lang", "struct(-n AS n, gram) AS x").groupBy("lang", F.pmod("x.gram", F.lit(64)))
    top = top.agg(F.slice(F.sort_array(F.collect_list("x")), 1, length).alias("x")).groupBy("lang")
    best = top.agg(F.slice(F.sort_array(F.flatten(F.collect_list("x"))), 1, length).alias("x"))
    return Profiles.of({r["lang"]: [x["gram"] for x in r["x"]] for r in best.collect()}, length)


def predicted(text: Column, profiles: Profiles) -> Column:
    """struct(lang, score) of each text: `und` and 0 where it is null or has no letter."""

    @F.pandas_udf("lang string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([profiles.predict(t) for t in texts], columns=["lang", "score"])

    return predict(text)


def limits(docs: DataFrame, profiles: Profiles, text_col: str = "text", lang_col: str = "lang") -> dict[str, float]:
    """The least score of a text of each language, from all documents that carry its label and are found to be in it."""
    rows = docs.filter(F.col(lang_col).isNotNull())
    rows = rows.select(F.col(lang_col).cast("string").alias("lang"), predicted(F.col(text_col), profiles).alias("guess"))
    own = F.when(F.col("guess.lang") == F.col("lang"), F.col("guess.score"))
    low = rows.groupBy("lang").agg(F.percentile_approx(own, LOW).alias("low")).filter("low IS NOT NULL")
    return {r["lang"]: PART * r["low"] for r in low.collect()}


def known_language(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", least: float | None = None
) -> DataFrame:
    """The rows of `docs` whose text is in one of the languages that its labels name.

    Rejected are texts that are null or without letters, those that share no n-gram with any profile, and
    those whose score is `least` or less: by default, the language's own of `limits`. Where
    no row has a label there is no language to keep to, and all rows stay.
    """
    profiles = learn(docs, id_col, text_col, lang_col)
    if not profiles.languages:
        return docs
    low = limits(docs, profiles, text_col, lang_col) if least is None else dict.fromkeys(profiles.languages, least)

    # One function decides, so that a text is compared once whatever the filter asks of it.
    @F.pandas_udf("boolean")
    def known(texts: pd.Series) -> pd.Series:
        guesses = (profiles.predict(t) for t in texts)
        return pd.Series([lang != UNDETERMINED and score > low.get(lang, 0.0) for lang, score in guesses], dtype=bool)

    return docs.filter(known(F.col(text_col)))


def op5(docs: DataFrame) -> DataFrame:
    """The query's columns, for every document."""
    docs = docs.select("doc_id", "text", "lang")
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    docs = docs.withColumn("held_out", F.crc32(name) % 4 == 2)
    guess = predicted(F.col("text"), learn(docs.filter("NOT held_out")))
    return docs.withColumn("guess", guess).select(
        "doc_id", "held_out", F.col("guess.lang").alias("lang_pred"), F.col("guess.score").alias("score")
    )
