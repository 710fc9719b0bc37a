"""Licence scans by a positional index of rare words, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words: digits, letters and everything beyond ASCII. (Lower-casing makes no word from a non-word.)
WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A template's label needs so much of its words in place around its key phrase.
SHARE = 0.8


@dataclass(frozen=True)
class Template:
    """A licence text: `key` must stand in it word for word, `text` (which holds it) for the most part."""

    label: str
    key: str
    text: str
    base: bool = False

    @property
    def key_words(self) -> list[str]:
        return self.key.split()

    @property
    def text_words(self) -> list[str]:
        return self.text.split()

    @property
    def offset(self) -> int:
        """Where the key phrase begins in the text."""
        n, words = len(self.key_words), self.text_words
        return next(i for i in range(len(words)) if words[i : i + n] == self.key_words)


# The phrases and labels of the contract.
BASE = [
    Template("gpl", "gnu general public license", "gnu general public license", True),
    Template("apache", "apache license", "apache license", True),
    Template("cc-by", "cc by", "cc by", True),
    Template("mit", "mit license", "mit license", True),
]
# Names and openings of well-known licences.
MORE = [
    Template("agpl", "affero general public license", "gnu affero general public license"),
    Template(
        "apache",
        "licensed under the apache license",
        "licensed under the apache license version 2 0 the license you may not use this file "
        "except in compliance with the license",
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms",
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met",
    ),
    Template("bsd", "bsd license", "bsd license"),
    Template("bsl", "boost software license", "boost software license"),
    Template("cc-by-sa", "cc by sa", "cc by sa"),
    Template("cc0", "cc0 1 0 universal", "cc0 1 0 universal"),
    Template("epl", "eclipse public license", "eclipse public license"),
    Template("eupl", "european union public licence", "european union public licence"),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software",
        "permission to use copy modify and or distribute this software for any purpose with or without fee "
        "is hereby granted",
    ),
    Template("lgpl", "lesser general public license", "gnu lesser general public license"),
    Template(
        "mit",
        "permission is hereby granted free of charge",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files",
    ),
    Template("mpl", "mozilla public license", "mozilla public license"),
    Template(
        "unlicense",
        "free and unencumbered software released into the public domain",
        "this is free and unencumbered software released into the public domain",
    ),
]
TEMPLATES = BASE + MORE


def _text(value: str) -> str:
    return f"'{value}'"


def _array(words: Sequence[str]) -> str:
    return f"array({', '.join(map(_text, words))})"


def _any_case(text: Column) -> Column:
    """Words to count, and to look for licence words in: all letters in lower case."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORDS), F.lit(0))


def document_frequencies(docs: DataFrame, text_col: str, templates: Sequence[Template]) -> dict[str, int]:
    """In how many documents each word of the key phrases occurs, over all of `docs`."""
    words = sorted({w for t in templates for w in t.key_words})
    found = F.array_intersect(F.expr(_array(words)), _any_case(F.col(text_col)))
    counts = docs.select(F.explode(found).alias("word")).groupBy("word").count().collect()
    return dict.fromkeys(words, 0) | {r["word"]: r["count"] for r in counts}


def _rarest(template: Template, frequency: dict[str, int]) -> list[int]:
    """Places in the key phrase of its two words of highest IDF; ties: the first."""
    order = sorted(range(len(template.key_words)), key=lambda i: (frequency[template.key_words[i]], i))
    return order[:2]


def _starts(template: Template, frequency: dict[str, int]) -> str:
    """SQL for where the key phrase begins: the rarest word's postings, moved by its place in the
    phrase, those kept that the next word's postings agree with, and there the whole phrase compared."""
    words = template.key_words
    first, second = _rarest(template, frequency)
    moved = f"transform(filter(_posts, p -> p.word = {_text(words[first])}), p -> p.pos - {first})"
    agree = f"get(_words, s + {second}) <=> {_text(words[second])}"
    return f"filter({moved}, s -> s >= 0 AND {agree} AND slice(_words, s + 1, {len(words)}) = {_array(words)})"


def scan(
    docs: DataFrame, text_col: str = "text", templates: Sequence[Template] = TEMPLATES, share: float = SHARE
) -> DataFrame:
    """One row per row of `docs`: (row, n_words, n_base, first_word, last_word, base_labels, labels, score).

    `row` is the input row as a struct. Places of base templates are counted, each phrase on its own.
    `score` is the largest share of a template's words found in place around its key phrase, 0 if
    no key phrase occurs. A null text is an empty one: no words, null places, empty labels.
    Repeated rows are scanned each; an empty table gives no rows.

    Nothing is shuffled but the words' document frequencies. A document without any template's
    rarest word is done after its words are counted.
    """
    frequency = document_frequencies(docs, text_col, templates)
    rare = sorted({t.key_words[_rarest(t, frequency)[0]] for t in templates})
    text = F.coalesce(F.col(text_col), F.lit(""))
    rough = _any_case(F.col(text_col))
    exact = F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORDS), F.lit(0))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.size(rough).cast("long").alias("n_words"),
        F.when(F.arrays_overlap(rough, F.expr(_array(rare))), exact).alias("_words"),
    )
    posted = "transform(_words, (w, i) -> named_struct('word', w, 'pos', i))"
    rows = rows.withColumn("_posts", F.expr(f"filter({posted}, p -> array_contains({_array(rare)}, p.word))"))
    rows = rows.withColumns({f"_at{k}": F.expr(_starts(t, frequency)) for k, t in enumerate(templates)})
    shares = {}
    for k, t in enumerate(templates):
        n = len(t.text_words)
        here = f"if(get(_words, s - {t.offset} + j) <=> element_at({_array(t.text_words)}, j + 1), 1, 0)"
        matched = f"aggregate(sequence(0, {n - 1}), 0, (a, j) -> a + {here})"
        shares[f"_share{k}"] = F.expr(
            f"if(size(_at{k}) > 0, 1D, 0D)"
            if t.text == t.key
            else f"coalesce(array_max(transform(_at{k}, s -> {matched})) / {n}D, 0D)"
        )
    rows = rows.withColumns(shares)
    base = [k for k, t in enumerate(templates) if t.base]
    places = F.expr(f"concat({', '.join(f'_at{k}' for k in base)})")

    def labels(some: Sequence[int]) -> Column:
        found = ", ".join(f"if(_share{k} >= {share}, {_text(templates[k].label)}, NULL)" for k in some)
        return F.coalesce(F.expr(f"array_join(array_sort(array_distinct(array({found}))), ',')"), F.lit(""))

    return rows.select(
        "row",
        "n_words",
        F.greatest(F.coalesce(F.size(places), F.lit(0)), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        labels(base).alias("base_labels"),
        labels(range(len(templates))).alias("labels"),
        F.greatest(*[F.col(f"_share{k}") for k in range(len(templates))]).alias("score"),
    )


def op7(docs: DataFrame) -> DataFrame:
    """The query's columns, for every document."""
    found = scan(docs.select("doc_id", "text"))
    return found.select("row.doc_id", *found.columns[1:])


def sql(templates: Sequence[Template] = TEMPLATES, share: float = SHARE) -> str:
    """The same by trying every place of every text."""
    starts, shares = [], []
    for k, t in enumerate(templates):
        key, whole, n = t.key_words, t.text_words, len(t.text_words)
        starts.append(
            f"CASE WHEN list_has_all(w, {key}) THEN "
            f"list_filter(range(len(w) - {len(key) - 1}), lambda i: w[i + 1 : i + {len(key)}] = {key}) "
            f"ELSE []::BIGINT[] END AS at{k}"
        )
        same = " + ".join(
            f"(i - {t.offset} + {j} >= 0 AND w[i - {t.offset} + {j + 1}] IS NOT DISTINCT FROM '{x}')::INT"
            for j, x in enumerate(whole)
        )
        shares.append(f"coalesce(list_max(list_transform(at{k}, lambda i: {same})), 0) / {n}e0 AS share{k}")
    base = [k for k, t in enumerate(templates) if t.base]

    def labels(some: Sequence[int]) -> str:
        found = ", ".join(f"CASE WHEN share{k} >= {share} THEN '{templates[k].label}' END" for k in some)
        return f"array_to_string(list_sort(list_distinct([{found}])), ',')"

    places = " || ".join(f"at{k}" for k in base)
    return f"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
),
found AS (SELECT doc_id, w, {', '.join(starts)} FROM split),
shared AS (SELECT *, {', '.join(shares)} FROM found)
SELECT doc_id, len(w) AS n_words, len({places})::BIGINT AS n_base,
       list_min({places}) AS first_word, list_max({places}) AS last_word,
       {labels(base)} AS base_labels, {labels(range(len(templates)))} AS labels,
       greatest({', '.join(f'share{k}' for k in range(len(templates)))}) AS score
FROM shared
"""
