"""Sharding by fixed virtual slots: a record's slot never changes, a versioned map says which shard has it."""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.llm.common import running
from contrail.session import scratch

# Virtual slots; fixed for the life of a data set. The driver holds one number a slot, whatever the data.
SLOTS = 4096
SHARDS = 8

MAP_SCHEMA = "version int, slot int, shard int"


def virtual_slot(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a record, from 32 bits of the MD5 of its key as text; a null key counts as an empty one."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(slots)).cast("int")


@dataclass(frozen=True)
class SlotMap:
    """One version of the map: `shards[slot]` is the shard that holds the slot."""

    version: int
    shards: tuple[int, ...]

    @property
    def count(self) -> int:
        return max(self.shards) + 1

    def _edited(self, shards: Sequence[int]) -> SlotMap:
        return SlotMap(self.version + 1, tuple(shards))

    def grown(self) -> SlotMap:
        """With one shard more, which takes an even share of the slots, the last of those that have most; no other slot moves."""
        held: list[list[int]] = [[] for _ in range(self.count)]
        for slot, shard in enumerate(self.shards):
            held[shard].append(slot)
        shards, new = list(self.shards), self.count
        for _ in range(len(shards) // (new + 1)):
            fullest = max(range(new), key=lambda shard: (len(held[shard]), -shard))
            shards[held[fullest].pop()] = new
        return self._edited(shards)

    def without(self, gone: int) -> SlotMap:
        """Without shard `gone`: its slots go to the shards with fewest slots, and the last shard takes its number."""
        if self.count < 2:
            raise ValueError("the last shard must stay")
        last = self.count - 1
        sizes = [(sum(s == shard for s in self.shards), shard) for shard in range(self.count) if shard != gone]
        heapq.heapify(sizes)
        shards = list(self.shards)
        for slot, shard in enumerate(self.shards):
            if shard == gone:
                size, to = heapq.heappop(sizes)
                shards[slot] = to
                heapq.heappush(sizes, (size + 1, to))
        return self._edited(gone if shard == last else shard for shard in shards)

    def balanced(self, weights: Sequence[int], tolerance: float = 0.01) -> SlotMap:
        """Edited so that shards hold about as many bytes each; `weights` are the bytes of every slot.

        As long as the fullest shard is above the mean by more than `tolerance`, the largest of its slots that
        narrows its distance to the emptiest moves there. Each move lowers the sum of squares, so this ends.
        A slot is never cut: one that outweighs a shard's share stays alone in the end.
        """
        shards, load = list(self.shards), [0] * self.count
        held: list[list[int]] = [[] for _ in load]
        for slot, shard in enumerate(shards):
            load[shard] += weights[slot]
            held[shard].append(slot)
        limit = sum(load) / len(load) * (1 + tolerance)
        while True:
            high, low = max(range(len(load)), key=load.__getitem__), min(range(len(load)), key=load.__getitem__)
            gap = load[high] - load[low]
            fit = [slot for slot in held[high] if 0 < weights[slot] < gap]
            if load[high] <= limit or not fit:
                return self._edited(shards)
            slot = min(fit, key=lambda s: (abs(2 * weights[s] - gap), s))
            held[high].remove(slot)
            held[low].append(slot)
            shards[slot] = low
            load[high] -= weights[slot]
            load[low] += weights[slot]

    def moved(self, to: SlotMap) -> list[int]:
        """Slots whose shard differs in the other version: only their records need to be copied."""
        return [slot for slot, (a, b) in enumerate(zip(self.shards, to.shards)) if a != b]


def map_for(shards: int, slots: int = SLOTS) -> SlotMap:
    """The map that the number of shards alone decides: one shard, grown to so many."""
    if not 0 < shards <= slots:
        raise ValueError("a map needs from one shard to one a slot")
    found = SlotMap(1, (0,) * slots)
    while found.count < shards:
        found = found.grown()
    return found


def save_map(spark: SparkSession, found: SlotMap, path: str) -> None:
    """Adds a version to the stored map; a version is written once and never changed."""
    rows = [(found.version, slot, shard) for slot, shard in enumerate(found.shards)]
    frame = spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1)
    frame.drop("version").write.mode("error").parquet(f"{path}/version={found.version}")


def load_map(spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
    """A version of the stored map, the newest by default; as many rows as there are slots."""
    rows = spark.read.schema("slot int, shard int, version int").parquet(path)
    if version is None:
        version = rows.agg(F.max("version")).first()[0]
    found = {r.slot: r.shard for r in rows.filter(F.col("version") == version).collect()}
    if not found or sorted(found) != list(range(len(found))):
        raise ValueError(f"no whole map of version {version} in {path}")
    return SlotMap(version, tuple(found[slot] for slot in range(len(found))))


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """(id, size, text_crc32, virtual_slot) of every row: size is the text's UTF-8 bytes and one more; a null text has none."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
        virtual_slot(F.col(id_col), slots).alias("virtual_slot"),
    )


def slot_bytes(rows: DataFrame, slots: int = SLOTS) -> list[int]:
    """Bytes of every slot, summed in each task first; the driver gets one number a slot."""
    found = [0] * slots
    for r in rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes")).collect():
        found[r["virtual_slot"]] = r["bytes"]
    return found


def per_slot(spark: SparkSession, columns: dict[str, Sequence[int]]) -> DataFrame:
    """Figures of the slots as a table to join with: `virtual_slot` and the named columns (longs)."""
    names = list(columns)
    schema = T.StructType([T.StructField("virtual_slot", T.IntegerType())] + [T.StructField(n, T.LongType()) for n in names])
    rows = [(slot, *map(int, values)) for slot, values in enumerate(zip(*columns.values()))]
    return spark.createDataFrame(rows, schema)


def assigned(rows: DataFrame, found: SlotMap, grown: SlotMap, weights: Sequence[int]) -> DataFrame:
    """`rows` of `sized` with shard, grown_shard, slot_bytes, and `slot`: the row's place in its shard, without gaps from 0.

    Within a shard rows stand by virtual slot, then id (null first). The map is joined as a broadcast of one row a slot.
    Places are prefix sums over ranges, split further by any number of the row's own, so that neither a
    shard nor a repeated id is held by one task.
    """
    maps = per_slot(rows.sparkSession, {"shard": found.shards, "grown_shard": grown.shards, "slot_bytes": weights})
    maps = maps.withColumns({c: F.col(c).cast("int") for c in ("shard", "grown_shard")})
    placed = rows.withColumn("_row", F.monotonically_increasing_id()).join(F.broadcast(maps), "virtual_slot")
    order = ["virtual_slot", "id", "size", "text_crc32", "_row"]
    return running(placed, ["shard"], order, {"slot": F.lit(1)}, "shard-places").drop("_row")


def write_shards(
    docs: DataFrame, found: SlotMap, path: str, id_col: str = "doc_id", file_rows: int = 1_000_000, mode: str = "append"
) -> None:
    """The rows of `docs` as Parquet, a folder a shard and virtual slots in order within it; the map's version is in the path.

    A shard is written by as many tasks as the range partitions that it spans, so its size bounds no task.
    """
    maps = per_slot(docs.sparkSession, {"shard": found.shards})
    out = docs.withColumn("virtual_slot", virtual_slot(F.col(id_col), len(found.shards))).join(F.broadcast(maps), "virtual_slot")
    ranged = out.repartitionByRange("shard", "virtual_slot", F.xxhash64(*docs.columns)).sortWithinPartitions("shard", "virtual_slot")
    ranged.write.mode(mode).option("maxRecordsPerFile", file_rows).partitionBy("shard").parquet(f"{path}/map={found.version}")


def shard(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """Every row of `docs` with its shard by the law `key`: the id and the number of shards decide.

    Columns: id, size, text_crc32, virtual_slot, shard, grown_shard (with one shard more, which takes rows only into
    itself), slot_bytes (of the row's virtual slot) and slot (place in the shard). Both versions of the map are stored
    under `path` and read back. Null ids share one slot; rows that repeat an id stay together; empty
    texts have size 1; an empty table gives no rows. Other columns play no part.
    """
    spark = docs.sparkSession
    own = map_for(shards)
    for version in (own, own.grown()):
        save_map(spark, version, path)
    grown, found = load_map(spark, path), load_map(spark, path, own.version)
    rows = sized(docs, id_col, text_col)
    return assigned(rows, found, grown, slot_bytes(rows))


def op12(docs: DataFrame) -> DataFrame:
    """The query's columns, for every document."""
    found = shard(docs.select("doc_id", "text"), scratch(docs.sparkSession, "shard-map"))
    return found.select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard", "virtual_slot", "slot_bytes"
    )


def _op12_sql() -> str:
    found = map_for(SHARDS)
    return f"""
WITH tables AS (
  SELECT list_transform(range(0, 256), lambda b: list_reduce([b::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
                        lambda c, x: xor(c >> 1, (c & 1) * 3988292384))) AS crcs,
         {list(found.shards)} AS shards, {list(found.grown().shards)} AS grown
),
known AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx,
         (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % {SLOTS})::INT AS virtual_slot
  FROM documents
),
bytes AS (
  SELECT doc_id, virtual_slot, len(hx) // 2 + 1 AS size,
         list_transform(range(0, len(hx) // 2), lambda i: ('0x' || substr(hx, 2 * i + 1, 2))::BIGINT) AS b
  FROM known
),
hashed AS (
  SELECT doc_id, virtual_slot, size, shards[virtual_slot + 1]::INT AS shard, grown[virtual_slot + 1]::INT AS grown_shard,
         xor(list_reduce([4294967295::BIGINT] || b, lambda c, x: xor(c >> 8, crcs[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32
  FROM bytes, tables
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard, virtual_slot,
       row_number() OVER (PARTITION BY shard ORDER BY virtual_slot, doc_id NULLS FIRST, size, text_crc32) - 1 AS slot,
       (sum(size) OVER (PARTITION BY virtual_slot))::BIGINT AS slot_bytes
FROM hashed
"""


OP12_SQL = _op12_sql()
