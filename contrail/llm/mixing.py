"""Mixing sources to target weights, by DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import WORD, code_point_key, fresh, running, stored

# The leading hex digits of a row's random key name its range; so many digits, 16 to this power.
RANGE_DIGITS = 3


def words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(_source, source_size) of each source, with the words that the mix should take: `target`.

    Sources in order weigh `weights`, repeating, and share the sum of all sizes. No target is
    above `most` times its source; what is cut off goes to the others by weight until none is
    above. That is target = least(most * size, level * weight) for one level, found with prefix
    sums in order of size / weight.
    """
    n = len(weights)
    table = F.array(*[F.lit(w) for w in weights])
    ranked = running(sizes, [], ["_source"], {"_rank": F.lit(1)}, "source-ranks")
    ranked = ranked.withColumn("_weight", F.element_at(table, (F.col("_rank") % n + 1).cast("int")).cast("long"))
    ranked = ranked.withColumn("_ratio", F.col("source_size") * most / F.col("_weight"))
    before = running(
        ranked, [], ["_ratio", "_rank"], {"_full": F.col("source_size") * most, "_used": F.col("_weight")}, "source-levels"
    )
    before = stored(before, "source-targets")
    every, weight = before.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("_weight"), F.lit(0))).first()
    # From here on a source and all of larger ratio are below their limit: the first such source sets the level.
    free, left = F.lit(every) - F.col("_full"), F.lit(weight) - F.col("_used")
    level = (
        before.filter(free <= F.col("_ratio") * left)
        .agg(F.min_by(free / left, F.struct("_ratio", "_rank")))
        .first()[0]
    )
    return before.select(
        "_source",
        "source_size",
        F.least(F.col("source_size") * F.lit(float(most)), F.lit(level or 0.0) * F.col("_weight")).alias("target"),
    )


def keyed(
    docs: DataFrame, size: Column, own: Column, id_col: str = "doc_id", source_col: str = "source", seed: str = "mix"
) -> DataFrame:
    """(row, size, _source, _key, _range): rows with their random key and the range that it falls in.

    The key also takes size and `own`, a hash of the text, so that rows of one id, however many, fall in all ranges.
    """
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(
        row.alias("row"),
        size.alias("size"),
        code_point_key(F.col(source_col)).alias("_source"),
        F.md5(F.concat_ws(":", name, F.lit(seed), size.cast("string"), own)).alias("_key"),
    ).withColumn("_range", F.substring("_key", 1, RANGE_DIGITS))


def text_hash(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def mix(
    docs: DataFrame,
    size: Column,
    id_col: str = "doc_id",
    source_col: str = "source",
    weights: Sequence[int] = (1, 2, 3),
    most: int = 3,
    seed: str = "mix",
    own: Column | None = None,
) -> DataFrame:
    """One row per row of `docs`: (row, size, source_size, target, taken).

    `row` is the input row as a struct. Rows of a source are put in order of a random key (a hash
    of id, seed, size and `own`, which is for what else tells rows of one id apart). The source's whole budget, floor(target), is dealt out exactly: every row as
    often as the source fits in it, and what is left to the first rows of the order, of which
    the last may be taken in part. Null ids and null sources are values like others (a null
    source comes last); equal ids follow their size. An empty table gives no rows.

    A source or an id of any share of the rows is split by the leading digits of the key; only rows
    alike in id, size and `own` share a range. Sums by source
    and range make the prefix of each range, and a window within the range the rest.
    """
    rows = keyed(docs, size, F.lit("") if own is None else own, id_col, source_col, seed)
    ranges = stored(rows.groupBy("_source", "_range").agg(F.sum("size").alias("_sum")), "mix-ranges")
    goals = targets(ranges.groupBy("_source").agg(F.sum("_sum").alias("source_size")), weights, most)
    earlier = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # At most 16 ** RANGE_DIGITS rows of a source.
    starts = ranges.select("_source", "_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    starts = starts.join(goals, "_source")
    within = Window.partitionBy("_source", "_range").orderBy("_key", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_before", F.coalesce(F.sum("size").over(within), F.lit(0)))
    budget = F.floor("target")
    left = budget % F.col("source_size")
    first = F.least(F.greatest(left - F.col("_start") - F.col("_before"), F.lit(0)), F.col("size"))
    every = F.floor(budget / F.col("source_size"))
    return placed.join(starts, ["_source", "_range"]).select(
        "row",
        "size",
        "source_size",
        "target",
        F.when(F.col("source_size") == 0, 0).otherwise(every * F.col("size") + first).cast("long").alias("taken"),
    )


def mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (1, 2, 3),
    most: int = 3,
) -> DataFrame:
    """The mix itself, in the columns of `docs`: a row for each time a document is taken.

    A document taken in part is cut after the last word taken; a number of characters in a column
    `n_chars` follows its text. Documents of which no word is taken, those without words too, go.
    """
    text = F.col(text_col)
    marked = mix(docs, words(text), id_col, source_col, weights, most, own=text_hash(text)).filter("taken > 0")
    copy = F.explode(F.sequence(F.lit(0), F.floor((F.col("taken") - 1) / F.col("size")).cast("int")))
    copies = marked.withColumn("_copy", copy).withColumn("_words", F.col("taken") - F.col("_copy") * F.col("size"))
    out = copies.select("row.*", F.col("_words") < F.col("size"), "_words").toDF(
        *docs.columns, cut := fresh(docs, "cut"), count := fresh(docs, "words")
    )
    # Parts that end with a word: the first `count` of them.
    parts = F.split(F.col(text_col), r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    head = F.array_join(F.slice(parts, F.lit(1), F.col(count).cast("int")), "")
    out = out.withColumn(text_col, F.when(F.col(cut), head).otherwise(F.col(text_col)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(cut), F.length(text_col).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.drop(cut, count)


def op1(docs: DataFrame) -> DataFrame:
    """The query's columns, for every row of `docs`."""
    sized = stored(docs.select("doc_id", "source", words(F.col("text")).alias("size"), text_hash(F.col("text")).alias("hash")), "mix-sizes")
    marked = mix(sized, F.col("size"), own=F.col("hash"))
    return marked.select("row.doc_id", "size", "source_size", "target", "taken")


OP1_SQL = r"""
WITH sized AS (
  SELECT doc_id, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS src,
         md5(coalesce(doc_id::VARCHAR, '') || ':mix:' || size || ':' || md5(coalesce(text, ''))) AS k
  FROM documents
),
sources AS (
  SELECT src, sum(size)::BIGINT AS source_size FROM sized GROUP BY src
),
weighed AS (
  SELECT *, (row_number() OVER (ORDER BY src) - 1) % 3 + 1 AS w FROM sources
),
levels AS (
  SELECT *, (source_size * 3) / w AS ratio FROM weighed
),
sums AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(source_size * 3) OVER before, 0) AS free,
         sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS remaining
  FROM levels
  WINDOW before AS (ORDER BY ratio, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
goals AS (
  SELECT src, source_size,
         least(source_size * 3e0,
               (SELECT (free::DOUBLE / remaining::DOUBLE) FROM sums WHERE free <= ratio * remaining ORDER BY ratio, src LIMIT 1) * w) AS target
  FROM sums
),
placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY src ORDER BY k, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized
)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0
            ELSE floor(target)::BIGINT // source_size * size
                 + least(greatest(floor(target)::BIGINT % source_size - before, 0), size) END::BIGINT AS taken
FROM placed JOIN goals USING (src)
"""
