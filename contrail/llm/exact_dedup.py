"""Exact de-duplication: 128-bit content hash, smallest or largest id kept, bytes compared."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import fresh, stored
from contrail.plans.skew import hot_keys, salted_join


def content_hash(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _classes(keyed: DataFrame, keep: str) -> DataFrame:
    """One row per distinct text: (_hash, _sha, keep_id, group_size).

    The text itself is a grouping key, so texts of one hash that differ in a byte stay apart.
    Copies are merged in each task before they are shuffled.
    """
    pick = {"smallest": F.min, "largest": F.max}[keep]
    return stored(
        keyed.groupBy("_hash", "_text")
        .agg(pick("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("_hash", F.sha2("_text", 256).alias("_sha"), "keep_id", "group_size"),
        "text-classes",
    )


def mark(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    digest: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """One row per row of `docs`: (row, keep_id, group_size, kept, text_sha256).

    `row` is the input row as a struct, so its columns can't clash with the others. A null text
    is an empty one. `kept` marks the rows that carry the kept id; null ids are never preferred,
    and a group of null ids keeps them all. Rows that repeat an id and a text count, and are all
    kept or all dropped (`drop_copies` leaves one). An empty table gives no rows.

    Hot groups: copies meet only after a merge in each task, and the join back salts them.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    text = F.coalesce(F.col(text_col), F.lit(""))
    whole = docs.select(F.col(id_col).alias("_id"), text.alias("_text"), digest(text).alias("_hash"))
    classes = _classes(whole, keep)
    total = classes.agg(F.coalesce(F.sum("group_size"), F.lit(0))).first()[0]
    narrow = docs.select(
        row.alias("row"), F.col(id_col).alias("_id"), digest(text).alias("_hash"), F.sha2(text, 256).alias("_sha")
    )
    keys = ["_hash", "_sha"]
    joined = salted_join(narrow, classes, keys, hot_keys(classes, keys, "group_size", total))
    return joined.select(
        "row",
        "keep_id",
        "group_size",
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """`docs` with one row of each group of equal texts, in the columns of `docs`.

    Where the kept id repeats, the first row by its other columns (as text) stays.
    """
    kept = mark(docs, id_col, text_col, keep).filter("kept").select("row.*", "text_sha256")
    kept = kept.toDF(*docs.columns, sha := fresh(docs, "sha"))
    first = Window.partitionBy(sha).orderBy(*[F.col(f"`{c}`").cast("string").asc_nulls_last() for c in docs.columns])
    return kept.withColumn(rank := fresh(kept, "rank"), F.row_number().over(first)).filter(F.col(rank) == 1).drop(sha, rank)


def op2(docs: DataFrame) -> DataFrame:
    """The query's columns, for every row of `docs`; the largest doc_id stays."""
    marked = mark(docs.select("doc_id", "text"), keep="largest")
    return marked.select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP2_SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
