"""Prefix trie of conversations: nodes by prefix hash, subtree figures by the Euler tour's list ranks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import running, stored
from contrail.llm.list_ranking import positions
from contrail.plans.skew import hot_keys, salted_join

# Conversations of one hundred share what the first of them began with: up to HEADS - 1 turns.
FAMILY, HEADS = 100, 6
# A prefix of turns is named by four sums of 32-bit hashes, one a turn and its depth: 128 bits.
LANES = 4
MASK = (1 << 32) - 1
# Characters of ids that one row carries to the digest of a node's ends.
PIECE = 1 << 16

KEY = ["depth", "hi", "lo"]
EMPTY = hashlib.sha256(b"").hexdigest()


def numbered(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv_id, place, digest, size) of all turns, place from 0.

    Turns are ordered by number, then role, then the MD5 of their text, null numbers first. Null roles and
    texts are empty ones; rows that repeat are turns each; rows without a conversation are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = conversations.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).alias("turn"),
        role.alias("role"),
        F.unhex(F.md5(text)).alias("digest"),
        F.length(text).cast("long").alias("size"),
    )
    placed = running(turns, ["conv_id"], ["turn", "role", "digest"], {"place": F.lit(1)}, "trie-places")
    named = F.unhex(F.md5(F.concat(F.col("role"), F.lit("\x00"), F.hex("digest"))))
    return stored(placed.select("conv_id", "place", named.alias("digest"), "size"), "trie-turns")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, total) and their turns (conv_id, total, depth, digest, size), rebuilt.

    Conversation c begins with the first h turns of c - c % FAMILY (all if fewer, none if absent) and goes on with its own
    after its first h; h is the CRC-32 of c in decimal, modulo HEADS. A head goes to less than twice FAMILY conversations.
    """
    own = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    own = stored(own.withColumns({"base": F.col("conv_id") - F.col("conv_id") % FAMILY, "h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS}), "trie-own")
    bases = own.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    taken = F.least("h", F.coalesce("n_base", F.lit(0)))
    convs = own.join(bases, "base", "left").withColumn("taken", taken)
    convs = stored(convs.withColumn("total", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "trie-convs")
    heads = turns.filter((F.col("place") < HEADS - 1) & (F.col("conv_id") % FAMILY == 0)).withColumnRenamed("conv_id", "base")
    begun = heads.join(convs.select("base", "conv_id", "taken", "total"), "base").filter("place < taken")
    columns = ["conv_id", "total", "depth", "digest", "size"]
    begun = begun.withColumn("depth", F.col("place") + 1).select(*columns)
    total = convs.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    after = salted_join(turns, convs.select("conv_id", "h", "taken", "total"), ["conv_id"], hot_keys(convs, ["conv_id"], "n", total))
    after = after.filter("place >= h").withColumn("depth", F.col("place") - F.col("h") + F.col("taken") + 1)
    return convs.select("conv_id", "total"), begun.union(after.select(*columns))


def hashed(turns: DataFrame) -> DataFrame:
    """Rebuilt turns (conv_id, depth, total, size) with the name of the prefix they end (hi, lo) and of the one before (up_hi, up_lo).

    The hashes' sums over a prefix name it in whatever order they are added, so they carry from range to range.
    """
    digest = F.md5(F.concat_ws(":", "depth", F.hex("digest")))
    lanes = {f"_h{i}": F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(LANES)}
    summed = running(turns.withColumns(lanes), ["conv_id"], ["depth"], {f"_s{i}": F.col(f"_h{i}") for i in range(LANES)}, "trie-prefixes")

    def pair(lane: list[Column], at: int) -> Column:
        high, low = (lane[i].bitwiseAND(F.lit(MASK)) for i in (at, at + 1))
        return F.shiftleft(high, 32).bitwiseOR(low)

    before = [F.col(f"_s{i}") for i in range(LANES)]
    here = [F.col(f"_s{i}") + F.col(f"_h{i}") for i in range(LANES)]
    return summed.select(
        "conv_id", "depth", "total", "size",
        pair(here, 0).alias("hi"), pair(here, 2).alias("lo"), pair(before, 0).alias("up_hi"), pair(before, 2).alias("up_lo"),
    )


def trie(prefixes: DataFrame, convs: DataFrame) -> DataFrame:
    """Nodes (node, KEY, conv_id, n_convs, size, up_hi, up_lo); conversations are counted in each task first.

    Numbers follow (smallest member, depth), so a path that one conversation leads has consecutive ones.
    """
    found = prefixes.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("size").alias("size"),
        F.max("up_hi").alias("up_hi"),
        F.max("up_lo").alias("up_lo"),
    )
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    root = root.select(*[zero.alias(c) for c in KEY], "conv_id", "n_convs", zero.alias("size"), F.lit(None).cast("long").alias("up_hi"), F.lit(None).cast("long").alias("up_lo"))
    return stored(found.union(root).repartitionByRange("conv_id", "depth").withColumn("node", F.monotonically_increasing_id()), "trie-nodes")


def linked(nodes: DataFrame) -> DataFrame:
    """`nodes` with parent, parent_conv_id, n_children, first child and next sibling."""
    below = nodes.filter("depth > 0")
    group = ["depth", "up_hi", "up_lo"]
    families = below.groupBy((F.col("depth") - 1).alias("depth"), F.col("up_hi").alias("hi"), F.col("up_lo").alias("lo")).agg(
        F.count(F.lit(1)).alias("n_children"), F.min("node").alias("child")
    )
    whole = nodes.join(families, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    whole = stored(whole, "trie-families")
    kids = running(below.select(*group, "node"), group, ["node"], {"place": F.lit(1)}, "trie-siblings")
    kids = stored(kids, "trie-siblings")
    after = kids.select(*group, (F.col("place") - 1).alias("place"), F.col("node").alias("sibling"))
    parents = whole.filter("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("hi").alias("up_hi"), F.col("lo").alias("up_lo"),
        F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children",
    )
    total = parents.agg(F.coalesce(F.sum("n_children"), F.lit(0))).first()[0]
    hot = hot_keys(parents, group, "n_children", total)
    kin = salted_join(kids.join(after, [*group, "place"], "left"), parents.drop("n_children"), group, hot)
    return stored(whole.join(kin.select("node", "sibling", "parent", "parent_conv_id"), "node", "left"), "trie-links")


def subtree_sums(nodes: DataFrame, **ranking: int) -> DataFrame:
    """(node, n_leaves, saved_tokens) over every node's subtree.

    The Euler tour enters a node, tours its children and leaves it: arc 2 * node to enter, 2 * node + 1 to leave. Ranks
    of the arcs put them in order; what stands between a node's two arcs is its subtree.
    """
    first = nodes.filter("depth = 0").select("node").first()
    if first is None:
        return nodes.sparkSession.createDataFrame([], "node long, n_leaves long, saved_tokens long")
    enter, leave = F.col("node") * 2, F.col("node") * 2 + 1
    down = F.coalesce(F.col("child") * 2, leave)
    up = F.coalesce(F.col("sibling") * 2, F.col("parent") * 2 + 1, F.lit(-1))
    links = nodes.select(F.explode(F.array(F.struct(enter.alias("id"), down.alias("next")), F.struct(leave.alias("id"), up.alias("next")))).alias("l"))
    ranks = positions(links.select("l.id", "l.next"), 2 * first["node"], **ranking)
    weights = nodes.select(enter.alias("id"), (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("size")).alias("saving"))
    arcs = ranks.join(weights, "id", "left").fillna(0, ["leaf", "saving"])
    summed = running(arcs, [], ["position"], {"leaves": F.col("leaf"), "saved": F.col("saving")}, "trie-tour")
    between = lambda c: F.max(c) - F.min(c)
    return summed.groupBy(F.shiftright("id", 1).alias("node")).agg(between("leaves").alias("n_leaves"), between("saved").alias("saved_tokens"))


def end_digests(ends: DataFrame) -> DataFrame:
    """(KEY, ends_sha256) of nodes where conversations end: SHA-256 of their ids, ascending, joined by commas.

    `ends` has KEY and conv_id. Ids are joined to pieces range by range; a node's pieces stream through its digest, so
    that a node of any number of ends is held nowhere.
    """

    def join(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, part, ids, size, n = None, 0, [], 0, 0
        for frame in frames:
            out = []
            for depth, hi, lo, part, conv in zip(*(frame[c].tolist() for c in (*KEY, "part", "conv_id"))):
                if (depth, hi, lo) != key or size > PIECE:
                    if ids:
                        out.append((*key, part, n, ",".join(ids)))
                    key, ids, size, n = (depth, hi, lo), [], 0, n + 1
                ids.append(str(conv))
                size += len(ids[-1]) + 1
            yield pd.DataFrame(out, columns=[*KEY, "part", "n", "ids"])
        if ids:
            yield pd.DataFrame([(*key, part, n, ",".join(ids))], columns=[*KEY, "part", "n", "ids"])

    def digest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, hashing = None, None
        for frame in frames:
            out = []
            for depth, hi, lo, ids in zip(*(frame[c].tolist() for c in (*KEY, "ids"))):
                if (depth, hi, lo) == key:
                    hashing.update(b",")
                else:
                    if key:
                        out.append((*key, hashing.hexdigest()))
                    key, hashing = (depth, hi, lo), hashlib.sha256()
                hashing.update(ids.encode())
            yield pd.DataFrame(out, columns=[*KEY, "ends_sha256"])
        if key:
            yield pd.DataFrame([(*key, hashing.hexdigest())], columns=[*KEY, "ends_sha256"])

    longs = ", ".join(f"{c} long" for c in KEY)
    ranged = ends.repartitionByRange(*KEY, "conv_id").withColumn("part", F.spark_partition_id().cast("long"))
    pieces = ranged.sortWithinPartitions(*KEY, "conv_id").mapInPandas(join, f"{longs}, part long, n long, ids string")
    return pieces.repartition(*KEY).sortWithinPartitions(*KEY, "part", "n").mapInPandas(digest, f"{longs}, ends_sha256 string")


def prefix_trie(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    **ranking: int,
) -> DataFrame:
    """One row per node of the trie of rebuilt conversations (see `rebuilt`, and `numbered` for the order of turns).

    Columns: conv_id (the smallest member), depth, parent_conv_id (null for the root), n_convs (members), n_children,
    n_leaves (childless nodes in its subtree), saved_tokens (over its subtree, members beyond the first times characters of
    the last text), ends_sha256 (of the members with no further turn). Equal conversations are members each. Conversations of
    no turn end at the root. A table without conversations gives no rows. Other columns play no part. `ranking` goes to
    `list_ranking.positions`.
    """
    turns = numbered(conversations, conv_col, turn_col, role_col, text_col)
    convs, whole = rebuilt(turns)
    prefixes = stored(hashed(whole), "trie-rows")
    nodes = linked(trie(prefixes, convs))
    sums = subtree_sums(nodes, **ranking)
    zero = F.lit(0).cast("long")
    turnless = convs.filter("total = 0").select(*[zero.alias(c) for c in KEY], "conv_id")
    ends = prefixes.filter("depth = total").select(*KEY, "conv_id").union(turnless)
    out = nodes.join(sums, "node").join(end_digests(ends), KEY, "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )


def op11(conversations: DataFrame) -> DataFrame:
    """The query's columns, for every node."""
    return prefix_trie(conversations)


OP11_SQL = f"""
WITH source AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r, md5(t)) - 1 AS place FROM source
),
convs AS (
  SELECT conv_id, conv_id - conv_id % {FAMILY} AS base,
         xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(range(1, len(conv_id::VARCHAR) + 1), lambda i:
               list_transform(range(0, 8), lambda b: (ascii(substr(conv_id::VARCHAR, i, 1)) >> b) & 1))),
             lambda c, bit: xor(c >> 1, (xor(c, bit) & 1) * 3988292384)), 4294967295) % {HEADS} AS h
  FROM (SELECT DISTINCT conv_id FROM source)
),
parts AS (
  SELECT c.conv_id, 0 AS part, place, r, t FROM convs c JOIN placed p ON p.conv_id = c.base WHERE place < h
  UNION ALL
  SELECT c.conv_id, 1, place, r, t FROM convs c JOIN placed p ON p.conv_id = c.conv_id WHERE place >= h
),
deep AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, place) AS depth, r, t FROM parts),
prefixes AS (
  SELECT conv_id, depth, t, list(struct_pack(r := r, t := t)) OVER (PARTITION BY conv_id ORDER BY depth) AS prefix FROM deep
  UNION ALL
  SELECT conv_id, 0, '', []::STRUCT(r VARCHAR, t VARCHAR)[] FROM convs
),
members AS (SELECT conv_id, depth, t, min(conv_id) OVER (PARTITION BY depth, prefix) AS node FROM prefixes),
nodes AS (SELECT node, depth, count(*) AS n_convs, (count(*) - 1) * max(length(t)) AS saving FROM members GROUP BY node, depth),
parents AS (
  SELECT n.*, m.node AS parent_conv_id FROM nodes n LEFT JOIN members m ON m.conv_id = n.node AND m.depth = n.depth - 1
),
kids AS (SELECT parent_conv_id AS node, depth - 1 AS depth, count(*) AS n_children FROM parents WHERE depth > 0 GROUP BY ALL),
known AS (SELECT p.*, coalesce(n_children, 0) AS n_children FROM parents p LEFT JOIN kids USING (node, depth)),
sums AS (
  SELECT m.node, m.depth, count(*) FILTER (k.n_children = 0) AS n_leaves, sum(k.saving) AS saved
  FROM known k JOIN members m ON m.conv_id = k.node AND m.depth <= k.depth GROUP BY m.node, m.depth
),
last AS (SELECT conv_id, max(depth) AS depth FROM members GROUP BY conv_id),
ends AS (
  SELECT m.node, m.depth, sha256(string_agg(m.conv_id::VARCHAR, ',' ORDER BY m.conv_id)) AS ends
  FROM members m JOIN last USING (conv_id, depth) GROUP BY m.node, m.depth
)
SELECT k.node AS conv_id, k.depth, parent_conv_id, n_convs, n_children, n_leaves, saved::BIGINT AS saved_tokens,
       coalesce(ends, sha256('')) AS ends_sha256
FROM known k JOIN sums USING (node, depth) LEFT JOIN ends USING (node, depth)
"""
