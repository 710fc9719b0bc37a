"""Ranks of a linked list that no task holds: chains within ranges, then rulers, then one bounded walk."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import stored

# Links that one task shortens at a time, and the most that a single task walks through.
RANGE_ROWS = 1 << 19
SOLE_ROWS = 1 << 17
# One in so many links is a ruler.
GAP = 16


def _to_heads(ids: np.ndarray, nexts: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted `ids`: index of the head of each link's chain, the weight of the links before it there, and which are tails.

    A chain is as long as the next link is among `ids`; doubling steps take the logarithm of its length.
    """
    at = np.searchsorted(ids, nexts)
    inside = ids[np.minimum(at, len(ids) - 1)] == nexts
    before = np.arange(len(ids))
    before[at[inside]] = np.flatnonzero(inside)
    ahead = np.where(before == np.arange(len(ids)), 0, weights[before])
    while (before != (further := before[before])).any():
        ahead, before = ahead + ahead[before], further
    return before, ahead, ~inside


def _chains(links: DataFrame, parts: int) -> DataFrame:
    """(id, head, ahead, next, length): each link's chain within its range of ids; the last two only for heads, of their chain."""

    def shorten(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [f for f in frames if len(f)]
        if not held:
            return
        frame = pd.concat(held).sort_values("id")
        ids, nexts = frame["id"].to_numpy(), frame["next"].to_numpy()
        head, ahead, tail = _to_heads(ids, nexts, np.ones(len(ids), np.int64))
        out = pd.DataFrame({"id": ids, "head": ids[head], "ahead": ahead})
        ends = pd.DataFrame({"id": ids[head[tail]], "next": nexts[tail], "length": ahead[tail] + 1})
        out = out.merge(ends, "left", "id")
        yield out.astype({"next": "Int64", "length": "Int64"})

    ranged = links.repartitionByRange(parts, "id")
    return stored(ranged.mapInPandas(shorten, "id long, head long, ahead long, next long, length long"), "list-chains")


def _starts(links: DataFrame, first: int, sole: int, gap: int, level: int = 0) -> DataFrame:
    """(id, start) of links (id, next, length): the sum of the lengths before each, from `first` on.

    A list too long for one task is thinned: every link jumps, twice as far each time, until it meets a ruler; the
    rulers, about one in `gap` links, are ranked in the same way.
    """
    if links.count() <= sole:

        def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held = [f for f in frames if len(f)]
            if held:
                frame = pd.concat(held).sort_values("id")
                ids = frame["id"].to_numpy()
                yield pd.DataFrame({"id": ids, "start": _to_heads(ids, frame["next"].to_numpy(), frame["length"].to_numpy())[1]})

        return stored(links.coalesce(1).mapInPandas(walk, "id long, start long"), "list-starts")
    rules = (F.pmod(F.xxhash64("id", F.lit(level)), F.lit(gap)) == 0) | (F.col("id") == first) | (F.col("next") < 0)
    links = stored(links.withColumn("ruler", rules), "list-links")
    rulers, others = links.filter("ruler"), links.filter("NOT ruler")
    known = rulers.select(F.col("id").alias("next"), F.lit(True).alias("met"))
    met = F.coalesce("met", F.lit(False)).alias("met")
    jumps = others.join(known, "next", "left").select("id", F.col("next").alias("to"), F.col("length").alias("far"), met)
    jumps = jumps.checkpoint()
    while not jumps.filter("NOT met").isEmpty():
        ahead = jumps.select(F.col("id").alias("to"), F.col("to").alias("_to"), F.col("far").alias("_far"), F.col("met").alias("_met"))
        moved = jumps.filter("NOT met").join(ahead, "to").select("id", F.col("_to").alias("to"), (F.col("far") + F.col("_far")).alias("far"), F.col("_met").alias("met"))
        jumps = jumps.filter("met").union(moved).checkpoint()
    ahead = jumps.select(F.col("id").alias("next"), "to", "far")
    thinned = rulers.join(ahead, "next", "left").select(
        "id",
        F.coalesce("to", "next").alias("next"),
        (F.col("length") + F.coalesce("far", F.lit(0))).alias("length"),
    )
    starts = _starts(stored(thinned, "list-rulers"), first, sole, gap, level + 1)
    rest = jumps.join(starts.select(F.col("id").alias("to"), "start"), "to").select("id", (F.col("start") - F.col("far")).alias("start"))
    return starts.union(rest)


def positions(links: DataFrame, first: int, parts: int = 0, sole: int = SOLE_ROWS, gap: int = GAP) -> DataFrame:
    """(id, position) of the list `links` (id, next) that begins with `first`; `next` is -1 at its end.

    Links whose ids lie close are shortened to chains first, range by range, so neighbours should have close ids;
    any order gives the right places. Ranges and the last walk are bounded, whatever the length of the list.
    """
    links = stored(links.select("id", "next"), "list")
    ranges = max(links.count() // RANGE_ROWS + 1, parts)
    chains = _chains(links, ranges)
    heads = chains.filter(F.col("next").isNotNull()).select("id", "next", "length")
    starts = _starts(heads, first, sole, gap).select(F.col("id").alias("head"), "start")
    return chains.join(starts, "head").select("id", (F.col("start") + F.col("ahead")).alias("position"))
