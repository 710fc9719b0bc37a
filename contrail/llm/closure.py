"""Groups of documents that links connect."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import stored
from contrail.plans.skew import hot_keys, salted_join


def _stars(links: DataFrame) -> DataFrame:
    """(a, low, degree): each node's smallest neighbour or itself, and how many links it has."""
    return links.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"), F.count(F.lit(1)).alias("degree"))


def _with_low(links: DataFrame, name: str) -> DataFrame:
    """`links` (a, b) with `low` of a; a node with very many links is spread over tasks."""
    stars = stored(_stars(links), name)
    total = stars.agg(F.coalesce(F.sum("degree"), F.lit(0))).first()[0]
    return salted_join(links, stars.select("a", "low"), ["a"], hot_keys(stars, ["a"], "degree", total))


def roots(links: DataFrame) -> DataFrame:
    """(node, root) of every node with a link in `links` (a, b); root is the smallest node that links reach.

    Stars are contracted in turn (Kiveris et al., SoCC 2014): first every node hands its larger neighbours to its smallest
    one, then its smaller ones. Links only shrink in number, and rounds grow with the logarithm of the longest path. No node's
    neighbours are gathered: smallest ones are found by partial aggregation, and joins salt hot nodes.
    """
    now = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "closure-links")
    mark = None
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _with_low(both, "closure-large").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        large = stored(large, "closure-links")
        small = _with_low(large, "closure-small")
        kept = small.filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        now = stored(kept.union(small.select("a", F.col("low").alias("b"))).distinct(), "closure-links")
        state = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
        if state == mark:
            break
        mark = state
    centres = now.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return centres.union(now.select(F.col("a").alias("node"), F.col("b").alias("root")))
