"""Joins whose large side has hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot above this many rows, or above its share of all rows: so at most
# MAX_HOT keys can be hot, which bounds what `salted_join` broadcasts.
HOT_ROWS = 1_000_000
MAX_HOT = 10_000


def hot_keys(counts: DataFrame, keys: list[str], weight: str, total: int) -> DataFrame:
    """Hot keys and the number of parts to split each into; at most MAX_HOT rows.

    `counts` has one row per key, `weight` its number of rows, `total` their sum.
    """
    limit = max(HOT_ROWS, -(-total // MAX_HOT))
    return counts.filter(F.col(weight) > limit).select(
        *keys, F.ceil(F.col(weight) / F.lit(limit)).cast("int").alias("_parts")
    )


def salted_join(big: DataFrame, small: DataFrame, keys: list[str], hot: DataFrame) -> DataFrame:
    """Inner join in which the rows of a hot key are spread over several tasks."""
    hot = F.broadcast(hot)
    parts = F.coalesce("_parts", F.lit(1))
    spread = big.join(hot, keys, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*big.columns), parts.cast("long")).cast("int")
    )
    copies = small.join(hot, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1)))
    return (
        spread.drop("_parts").join(copies.drop("_parts"), [*keys, "_salt"]).drop("_salt")
    )
