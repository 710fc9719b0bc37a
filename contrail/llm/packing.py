"""Best-fit packing of documents into sequences of a fixed number of tokens."""

from __future__ import annotations

import heapq
from bisect import bisect_left, insort
from collections.abc import Iterator
from zlib import crc32

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import stored
from contrail.llm.tokens import encoder, tokenizer_path

CAPACITY = 1024
END_ID = 2
TOKENIZER = "byte_bpe_50k.json"
# Pieces of one length are numbered in so many ranges of a hash, each by its own window.
RANGES = 4096

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of `n` tokens: all are full but the first."""
    first = n - (n - 1) // capacity * capacity
    return [(0, first), *((start, capacity) for start in range(first, n, capacity))]


def pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    end_id: int = END_ID,
    capacity: int = CAPACITY,
) -> DataFrame:
    """Pieces of every document's ids and end id; a null text is an empty one."""
    path = path or tokenizer_path(TOKENIZER)
    end = end_id.to_bytes(4, "little")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path, byte_level=True).encode
        for frame in frames:
            rows = []
            for doc, ids in zip(frame.iloc[:, 0], encode(text or "" for text in frame.iloc[:, 1])):
                ids += end
                for i, (start, n) in enumerate(cut(len(ids) // 4, capacity)):
                    rows.append((doc, i, start, n, crc32(ids[4 * start : 4 * (start + n)])))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"]).astype(
                {"doc_id": "Int64"}
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(
        run, PIECES
    )


class _Sums:
    """Which totals can be made of given lengths, each used any number of times."""

    def __init__(self, lengths: list[int], capacity: int):
        self.bits = 1
        mask = (1 << (capacity + 1)) - 1
        for length in lengths:
            step = length
            while step <= capacity:  # doubling reaches every multiple
                self.bits |= self.bits << step & mask
                step *= 2

    def any_above(self, low: int, high: int) -> bool:
        """Is there a total over `low`, `high` at most?"""
        return bool(self.bits >> (low + 1) & ((1 << max(0, high - low)) - 1))


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """How many pieces of each length go where: (length, first, count, sequence, per, offset).

    Of the pieces of `length`, numbered from 0, those from `first` on, `count` of them, go `per` to a
    sequence into the sequences from `sequence` on, the first of each at `offset`.

    The instance is its number of pieces by length, at most `capacity` entries however many
    documents there are. First the reduction: for the longest length left, the set that dominates
    every other set with such a piece is fixed, where there is one: it alone, if nothing
    fits beside it; or it and the longest that fits, if they fill the sequence, or if no set of
    the others has a total between that one's length and the room. Each fixed set shrinks the
    instance, so it is gone through again until nothing changes. Then best-fit, longest first.
    """
    left = {length: n for length, n in counts.items() if n > 0}
    used = dict.fromkeys(left, 0)
    out: list[tuple[int, int, int, int, int, int]] = []
    sequences = 0

    def put(length: int, n: int, sequence: int, per: int, offset: int) -> None:
        out.append((length, used[length], n, sequence, per, offset))
        used[length] += n
        left[length] -= n
        if not left[length]:
            del left[length]

    changed = True
    while changed:
        changed = False
        for longest in sorted(left, reverse=True):
            if longest not in left:
                continue
            room = capacity - longest
            others = sorted(k for k, n in left.items() if k <= room and (k != longest or n > 1))
            if not others:
                n, partner = left[longest], None
            else:
                partner = others[-1]
                if partner < room and _Sums(others, room).any_above(partner, room):
                    continue
                n = left[longest] // 2 if partner == longest else min(left[longest], left[partner])
            put(longest, n, sequences, 1, 0)
            if partner:
                put(partner, n, sequences, 1, longest)
            sequences += n
            changed = True

    # Sequences that have room, by room: runs (first sequence, number).
    rooms: list[int] = []
    open_runs: dict[int, list[tuple[int, int]]] = {}

    def keep(room: int, sequence: int, n: int) -> None:
        if room and n:
            if room not in open_runs:
                insort(rooms, room)
                open_runs[room] = []
            heapq.heappush(open_runs[room], (sequence, n))

    for length in sorted(left, reverse=True):
        while length in left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                sequence, n = heapq.heappop(open_runs[room])
                if not open_runs[room]:
                    del open_runs[room]
                    del rooms[at]
            else:  # nothing has room: new sequences, as many as may be needed
                room, sequence = capacity, sequences
                n = -(-left[length] // (capacity // length))
                sequences += n
            # The best fit of the next piece is what is left of the same sequence while it fits there.
            per = room // length
            whole = min(n, left[length] // per)
            rest = left[length] - whole * per if whole < n else 0
            if whole:
                put(length, whole * per, sequence, per, capacity - room)
                keep(room - per * length, sequence, whole)
            if rest:
                put(length, rest, sequence + whole, rest, capacity - room)
                keep(room - rest * length, sequence + whole, 1)
            keep(room, sequence + whole + bool(rest), n - whole - bool(rest))
    return out


def ranged(parts: DataFrame) -> DataFrame:
    """`parts` with a range of a hash of each row and its place in the input, so that rows alike, however many, fall in all."""
    place = F.monotonically_increasing_id()
    return parts.withColumn("_range", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", place), F.lit(RANGES)).cast("int"))


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`parts` (columns of `pieces`) with sequence_id and offset.

    Only the number of pieces by length reaches the driver. Pieces of a length are numbered by a
    window for each range of a hash, so a length or an id that a third of them share is split. The ranges are
    stored with the rows, so that a task that runs again sees the same.
    No piece may be longer than `capacity`. An empty table gives no rows; pieces that are alike in all
    columns get a place each.
    """
    parts = stored(ranged(parts), "pieces")
    ranges = stored(parts.groupBy("length", "_range").agg(F.count(F.lit(1)).alias("_n")), "piece-counts")
    counts = {r["length"]: r["n"] for r in ranges.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    planned = parts.sparkSession.createDataFrame(
        plan(counts, capacity), "length long, _first long, _count long, _sequence long, _per long, _offset long"
    )
    earlier = Window.partitionBy("length").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select("length", "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    within = Window.partitionBy("length", "_range").orderBy("doc_id", "piece", "start", "ids_crc32")
    numbered = parts.withColumn("_row", F.row_number().over(within) - 1).join(starts, ["length", "_range"])
    number = F.col("_start") + F.col("_row")
    numbered = numbered.withColumn("_number", number)
    # A few rows for each of at most `capacity` lengths.
    rows = F.broadcast(planned.withColumnRenamed("length", "_length"))
    here = F.col("_number") - F.col("_first")
    placed = numbered.join(rows, (F.col("length") == F.col("_length")) & (here >= 0) & (here < F.col("_count")))
    return placed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("_sequence") + F.floor(here / F.col("_per"))).alias("sequence_id"),
        (F.col("_offset") + here % F.col("_per") * F.col("length")).alias("offset"),
    )


def op4(docs: DataFrame) -> DataFrame:
    """The query's columns, for every document."""
    return pack(pieces(docs))
