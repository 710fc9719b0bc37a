"""Token ids of documents in compressed, checksummed blocks, in order of document id."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import groupby, repeat
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contrail.llm import coder
from contrail.llm.tokens import encoder, tokenizer_path
from contrail.session import scratch

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
# A block is closed at the end of the document with which it has so many ids.
BLOCK_IDS = 1 << 19

# A file holds blocks of whole documents; `part` and `block` put them in order.
BLOCKS = "part int, block int, n_ids long, doc_ids array<long>, lengths array<long>, ids binary"
DOCUMENTS = "part int, block int, doc_id long, before long"


def _blocks(docs: Iterator[tuple[int | None, bytes]]) -> Iterator[tuple[list, list[bytes]]]:
    """Documents in order, by blocks."""
    names, ids, size = [], [], 0
    for doc, own in docs:
        names.append(doc)
        ids.append(own)
        size += len(own) // 4
        if size >= BLOCK_IDS:
            yield names, ids
            names, ids, size = [], [], 0
    if names:
        yield names, ids


def _encoded(encode: Callable[[Iterable[str]], Iterator[bytes]], texts: Iterable[str]) -> Iterator[bytes]:
    """Ids of each text; texts that repeat one after the other are encoded once."""
    runs = [(text, len(list(same))) for text, same in groupby(texts)]
    for (_, n), ids in zip(runs, encode(text for text, _ in runs)):
        yield from repeat(ids, n)


def write(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    end_id: int = END_ID,
) -> None:
    """Writes the ids of every document, each with `end_id` after it, in ascending order of id.

    Null ids come first, and rows of one id in order of a hash of their text, then of their place in the
    input, so that rows alike are split over tasks too; a null text is an empty one. An empty table writes no
    block. A task that is run again writes the same blocks.
    """
    tokenizer = tokenizer or tokenizer_path(TOKENIZER)
    end = end_id.to_bytes(4, "little")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        text.alias("text"),
        F.xxhash64(text).alias("tie"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = ["id", "tie", "row"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer, byte_level=False).encode
        part = TaskContext.get().partitionId()
        docs = ((None if pd.isna(d) else int(d), x + end) for f in frames for d, x in zip(f["id"], _encoded(encode, f["text"])))
        for block, (names, ids) in enumerate(_blocks(docs)):
            joined = np.frombuffer(b"".join(ids), "<u4")
            row = (part, block, len(joined), names, [len(x) // 4 for x in ids], coder.encode(joined))
            yield pd.DataFrame([row], columns=["part", "block", "n_ids", "doc_ids", "lengths", "ids"])

    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.mapInPandas(run, BLOCKS).write.parquet(path)


def _decoded(spark: SparkSession, path: str, column: str, of: Callable[[bytes], bytes | int]) -> DataFrame:
    """DOCUMENTS, n_tokens and `column`, which is `of` each document's ids."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples():
                ids = coder.decode(r.ids).tobytes()
                ends = np.cumsum(r.lengths)
                if len(ids) != 4 * ends[-1]:
                    raise ValueError("a block has not the ids of its documents")
                own = [of(ids[4 * (e - n) : 4 * e]) for n, e in zip(r.lengths, ends)]
                docs = pd.array([None if pd.isna(d) else int(d) for d in r.doc_ids], "Int64")
                before, n = ends - r.lengths, r.lengths
                columns = {"doc_id": docs, "before": before, "n_tokens": n, column.split()[0]: own}
                yield pd.DataFrame(columns).assign(part=r.part, block=r.block)

    return spark.read.schema(BLOCKS).parquet(path).mapInPandas(run, f"{DOCUMENTS}, n_tokens long, {column}")


def read(spark: SparkSession, path: str) -> DataFrame:
    """(part, block, doc_id, before, n_tokens, ids) of every document in the files: its ids, 32 bits each,
    and how many ids of its block come before it. A damaged block is an error."""
    return _decoded(spark, path, "ids binary", bytes)


def starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, block, start): how many ids come before each block, from the blocks' sizes alone."""
    blocks = spark.read.schema(BLOCKS).parquet(path).select("part", "block", "n_ids")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    # One row for each file that was written.
    parts = parts.select("part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    within = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = blocks.withColumn("_in", F.coalesce(F.sum("n_ids").over(within), F.lit(0)))
    return inside.join(parts, "part").select("part", "block", (F.col("_start") + F.col("_in")).alias("start"))


def digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""

    docs = _decoded(spark, path, "ids_crc32 long", crc32)
    found = docs.join(starts(spark, path), ["part", "block"])
    return found.select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def op8(docs: DataFrame) -> DataFrame:
    """The query's columns, from files in the shared folder."""
    path = scratch(docs.sparkSession, "token-ids")
    write(docs, path)
    return digests(docs.sparkSession, path)
