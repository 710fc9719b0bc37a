"""Chat formatting: snapshots of a conversation collapse into the longest, which is rendered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import running, stored
from contrail.plans.skew import hot_keys, salted_join

# Turns in a row of rendered text.
CHUNK = 64
# A prefix of turns is named by four sums of 32-bit hashes, one a turn and its place.
LANES = 4
BEGIN, MIDDLE, END = "<|", "|>\n", "\n<|end|>\n"

# What names a turn.
TURN = ["conv_id", "turn", "role", "digest"]


def _lanes() -> list[Column]:
    """Hashes of a turn at its place: disjoint pieces of one MD5.

    Their sums over a prefix of turns name it in whatever order they are added up, so they can be
    carried from one range of a conversation to the next.
    """
    null = F.lit("\x00")
    turn = F.concat_ws(":", "place", F.coalesce(F.hex("digest"), null), F.coalesce("role", null))
    digest = F.md5(turn)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(LANES)]


def _numbered(turns: DataFrame) -> DataFrame:
    """Turns (TURN, size) with their place, where their text starts, and the prefix that they end."""
    placed = running(turns, ["conv_id"], TURN[1:], {"place": F.lit(1), "start": F.col("size")}, "chat-places")
    hashed = placed.withColumns({f"_h{i}": h for i, h in enumerate(_lanes())})
    summed = running(hashed, ["conv_id"], ["place"], {f"_s{i}": F.col(f"_h{i}") for i in range(LANES)}, "chat-prefixes")
    prefix = F.concat_ws(":", *[F.col(f"_s{i}") + F.col(f"_h{i}") for i in range(LANES)])
    return summed.select(*TURN, "size", "place", "start", prefix.alias("prefix"))


def rendered(role: Column, text: Column) -> Column:
    """A turn as text; a null role is `unknown`, a null text an empty one."""
    return F.concat(
        F.lit(BEGIN), F.coalesce(role, F.lit("unknown")), F.lit(MIDDLE), F.coalesce(text, F.lit("")), F.lit(END)
    )


def maximal(numbered: DataFrame) -> DataFrame:
    """(conv_id, turns, snapshots) of conversations that begin no longer one; of equal ones, the smallest id.

    `snapshots` is how many conversations have exactly its turns. A conversation begins a longer one
    if more conversations have its turns as a prefix than end with them. Prefixes are counted in
    each task before they are shuffled, so turns that every conversation begins with cost a row a task.
    """
    last = numbered.groupBy("conv_id").agg(F.max(F.struct("place", "prefix")).alias("last"))
    ends = last.groupBy("last.place", "last.prefix").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("snapshots")
    )
    all_of = numbered.groupBy("place", "prefix").agg(F.count(F.lit(1)).alias("_all"))
    kept = ends.join(all_of, ["place", "prefix"]).filter("_all = snapshots")
    return kept.select("conv_id", (F.col("place") + 1).alias("turns"), "snapshots")


def format_chats(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    chunk: int = CHUNK,
) -> DataFrame:
    """Rows (conv_id, turns, snapshots, chunk, start, length, text) of the conversations that are kept.

    A conversation whose turns begin a longer one is a snapshot of it and goes; of equal ones the
    smallest id stays. The text of a kept one is its chunks, `chunk` turns each, one after the other;
    `start` counts the characters before. Turns are ordered by number, then role, then the MD5 of
    their text, nulls first; a row that repeats in all of these is one turn. Rows without a
    conversation id belong to none and are left out. An empty table gives no rows.

    A conversation of any length is numbered, hashed and rendered in ranges of its turns, and texts are
    shuffled only once it is known which are kept.
    """
    role, text = F.col(role_col), F.col(text_col)
    turns = conversations.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        role.alias("role"),
        F.unhex(F.md5(text)).alias("digest"),
        rendered(role, text).alias("text"),
    )
    sized = turns.select(*TURN, F.length("text").cast("long").alias("size")).distinct()
    numbered = stored(_numbered(sized), "chat-turns")
    kept = stored(maximal(numbered), "chat-kept")
    total = kept.agg(F.coalesce(F.sum("turns"), F.lit(0))).first()[0]
    own = salted_join(numbered, kept, ["conv_id"], hot_keys(kept, ["conv_id"], "turns", total))
    own = own.select(*[F.col(c).alias(f"_{c}") for c in TURN], "turns", "snapshots", "size", "place", "start")
    same = F.lit(True)
    for c in TURN:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    told = turns.dropDuplicates(TURN).join(own, same)
    parts = F.sort_array(F.collect_list(F.struct("place", "text")))  # at most `chunk` turns
    return told.groupBy("conv_id", "turns", "snapshots", F.floor(F.col("place") / chunk).alias("chunk")).agg(
        F.min("start").alias("start"),
        F.sum("size").alias("length"),
        F.array_join(F.transform(parts, lambda x: x["text"]), "").alias("text"),
    )


def op9(conversations: DataFrame) -> DataFrame:
    """The kept conversations as text."""
    return format_chats(conversations)


OP9_SQL = f"""
WITH turns AS (
  SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL
),
placed AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, md5(text) NULLS FIRST) - 1 AS place,
         role, text, '{BEGIN}' || coalesce(role, 'unknown') || '{MIDDLE}' || coalesce(text, '') || '{END}' AS rendered
  FROM turns
),
prefixes AS (
  SELECT *, list(struct_pack(r := role, t := text)) OVER w AS prefix, coalesce(sum(length(rendered)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM placed WINDOW w AS (PARTITION BY conv_id ORDER BY place)
),
ends AS (
  SELECT prefix, min(conv_id) AS conv_id, count(*) AS snapshots
  FROM (SELECT conv_id, max_by(prefix, place) AS prefix FROM prefixes GROUP BY conv_id) GROUP BY prefix
),
kept AS (
  SELECT conv_id, snapshots, len(e.prefix) AS turns FROM ends e
  WHERE NOT EXISTS (SELECT 1 FROM prefixes p JOIN (SELECT conv_id, max(place) AS final FROM placed GROUP BY conv_id) l USING (conv_id)
                    WHERE p.place < l.final AND p.prefix = e.prefix)
)
SELECT conv_id, turns, snapshots, place // {CHUNK} AS chunk, min(start)::BIGINT AS start,
       sum(length(rendered))::BIGINT AS length, string_agg(rendered, '' ORDER BY place) AS text
FROM prefixes JOIN kept USING (conv_id)
GROUP BY conv_id, turns, snapshots, place // {CHUNK}
"""
