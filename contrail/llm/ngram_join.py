"""Exact n-gram Jaccard join by rare-first prefix filtering, and the groups it links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.closure import roots as roots_of
from contrail.llm.common import release, stored
from contrail.plans.skew import hot_keys, salted_join

# Shingles are counted in so many buckets of their hash. The counts only set the order in which a
# document's shingles are taken into its prefix: any one order for all gives the same links.
COUNT_BITS = 18
# Blocks of buckets, which the counts travel in.
BLOCKS = 64
# Documents to verify are picked out of the texts by a set of so many bits; other documents
# that it lets through are dropped by the join after it.
PICK_BITS = 24
# Ranges of the hash in which the suffix filter counts a document's shingles, up to 255 in each.
RANGE_BITS = 7
# Longs of parity bits that a posting carries.
PARITIES = [f"p{i}" for i in range(4)]

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _SHIFT)) * _MIX
    return (h ^ (h >> _SHIFT)) * _MIX


def shingles(text: str | None, n: int) -> np.ndarray:
    """Distinct 64-bit hashes of the `n`-word shingles of a whole text, in order.

    A-Z are lower-cased; words are runs without ASCII white space. Fewer words make one shingle
    of them all; none, no shingle.
    """
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = min(n, len(h))
    rolled = h[: len(h) - n + 1]
    for i in range(1, n):
        rolled = _mixed(rolled) + h[i : len(h) - n + 1 + i]
    found = _mixed(rolled)
    found.sort()
    return found[np.append(True, found[1:] != found[:-1])]


def _bucket(found: np.ndarray) -> np.ndarray:
    return (found >> np.uint64(64 - COUNT_BITS)).astype(np.int64)


def range_counts(found: np.ndarray) -> bytes:
    """How many of a document's shingles lie in each range of the hash."""
    ranges = (found >> np.uint64(64 - RANGE_BITS)).astype(np.int64)
    return np.minimum(np.bincount(ranges, minlength=1 << RANGE_BITS), 255).astype(np.uint8).tobytes()


def parities(found: np.ndarray) -> np.ndarray:
    """Whether an odd number of a document's shingles falls on each of the parity bits, as longs.

    Where two sets differ in this, they differ in a shingle: the bits that differ are never more than the shingles.
    """
    bits = (found & np.uint64(64 * len(PARITIES) - 1)).astype(np.int64)
    return np.packbits(np.bincount(bits, minlength=64 * len(PARITIES)).astype(np.uint8) & 1).view(np.int64)


def shingle_counts(texts: DataFrame, n: int) -> np.ndarray:
    """How many documents' shingles fall in each bucket, over all rows of `texts` (one column).

    Each task sums its own; blocks of buckets are summed as they stream through a partition.
    """
    size = (1 << COUNT_BITS) // BLOCKS

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, waiting, held = np.zeros(1 << COUNT_BITS, np.int64), [], 0
        for frame in frames:
            for text in frame.iloc[:, 0]:
                waiting.append(_bucket(shingles(text, n)))
                held += len(waiting[-1])
                if held > 1 << COUNT_BITS:
                    total += np.bincount(np.concatenate(waiting), minlength=len(total))
                    waiting, held = [], 0
        if waiting:
            total += np.bincount(np.concatenate(waiting), minlength=len(total))
        if total.any():
            blocks = total.reshape(BLOCKS, size)
            yield pd.DataFrame({"block": range(BLOCKS), "counts": [b.tobytes() for b in blocks]})

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for frame in frames:
            for block, counts in zip(frame["block"], frame["counts"]):
                sums[block] = sums.get(block, 0) + np.frombuffer(counts, np.int64)
        yield pd.DataFrame({"block": list(sums), "counts": [s.tobytes() for s in sums.values()]})

    schema = "block int, counts binary"
    found = np.zeros(1 << COUNT_BITS, np.int64)
    for row in texts.mapInPandas(count, schema).repartition("block").mapInPandas(add, schema).collect():
        found[row["block"] * size : (row["block"] + 1) * size] = np.frombuffer(row["counts"], np.int64)
    return found


def _prefixes(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(id, text_hash, n_shingles, signature, ranges, parity, prefix); the last four are null without shingles.

    Two sets that overlap enough share a shingle of both prefixes. Rare buckets come first.
    """
    import xxhash

    counts = docs.sparkSession.sparkContext.broadcast(shingle_counts(docs.select("_text"), n))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for doc, text, text_hash in zip(frame["_id"], frame["_text"], frame["_text_hash"]):
                found = shingles(text, n)
                if not len(found):
                    out.append((doc, text_hash, 0, None, None, None, None))
                    continue
                order = np.argsort(counts.value[_bucket(found)], kind="stable")
                most = len(found) - (percent * len(found) + 99) // 100 + 1
                signature = xxhash.xxh3_128_digest(found.tobytes())
                prefix = found[order[:most]].view(np.int64)
                out.append((doc, text_hash, len(found), signature, range_counts(found), parities(found), prefix))
            columns = ["id", "text_hash", "n_shingles", "signature", "ranges", "parity", "prefix"]
            yield pd.DataFrame(out, columns=columns).astype({"id": "Int64"})

    return stored(
        docs.mapInPandas(
            run,
            "id long, text_hash long, n_shingles long, signature binary, ranges binary, parity array<long>, prefix array<long>",
        ),
        "shingle-prefixes",
    )


def _enough(overlap: Column, sizes: Column, percent: int) -> Column:
    """Jaccard of `percent` or more, from the overlap and the sum of both sizes."""
    return overlap * (100 + percent) >= sizes * percent


def _may_link(a: str, b: str, percent: int) -> Column:
    """Length filter, positional filter for two sets whose first shared shingle this is, and the parity bits' bound."""
    size_a, size_b = F.col(f"{a}.size").cast("long"), F.col(f"{b}.size").cast("long")
    room = F.least(size_a - F.col(f"{a}.pos"), size_b - F.col(f"{b}.pos"))
    longer, shorter = F.greatest(size_a, size_b), F.least(size_a, size_b)
    apart = sum((F.bit_count(F.col(f"{a}.{p}").bitwiseXOR(F.col(f"{b}.{p}"))) for p in PARITIES), F.lit(0))
    near = (size_a + size_b - apart) * (100 + percent) >= (size_a + size_b) * (2 * percent)
    return (shorter * 100 >= longer * percent) & _enough(room, size_a + size_b, percent) & near


def suffix_filter(sizes: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs may link, from the sum of both sizes and how many shingles each has in every range.

    What two sets hold in a range differs by the difference of its counts at least.
    """
    apart = np.abs(a.astype(np.int64) - b).sum(1)
    return (sizes - apart) * (100 + percent) >= 2 * percent * sizes


def overlaps(a: bytes, b: bytes, percent: int) -> bool:
    """Do two sets link?"""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    total = len(x) + len(y)
    shared = total - len(np.union1d(x, y))
    return shared * 100 >= percent * (total - shared)


def _bits(slots: DataFrame) -> np.ndarray:
    """Which of 2 ** PICK_BITS slots occur in the column `slot`; at most 2 ** PICK_BITS / 64 rows are collected."""
    words = slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, slot & 63)")).alias("bits")
    )
    found = np.zeros((1 << PICK_BITS) // 64, np.int64)
    for row in words.collect():
        found[row["word"]] = row["bits"]
    return np.unpackbits(found.view(np.uint8), bitorder="little").view(bool)


def _sets(docs: DataFrame, nodes: DataFrame, n: int) -> DataFrame:
    """(node, set) of `nodes` (node, signature, rep_id), from the texts."""
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << PICK_BITS)).cast("int").alias("slot")
    shared = docs.sparkSession.sparkContext.broadcast(_bits(nodes.select(slot("rep_id"))))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        for frame in frames:
            found = [s.tobytes() for t in frame["_text"][shared.value[frame["slot"].to_numpy()]] if len(s := shingles(t, n))]
            yield pd.DataFrame({"signature": [xxhash.xxh3_128_digest(s) for s in found], "set": found})

    found = docs.select("_text", slot("_id")).mapInPandas(run, "signature binary, set binary")
    found = found.dropDuplicates(["signature"]).join(nodes.select("node", "signature"), "signature")
    return stored(found.select("node", "set"), "shingle-sets")


def _verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, n: int, percent: int) -> DataFrame:
    """Those of `pairs` (a, b) that link: by the suffix filter first, then by the sets themselves."""
    counts = nodes.select("node", "n_shingles", "ranges")
    known = pairs.join(counts.toDF("a", "size_a", "ranges_a"), "a").join(counts.toDF("b", "size_b", "ranges_b"), "b")

    def pick(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                x, y = (np.frombuffer(b"".join(frame[c]), np.uint8).reshape(len(frame), -1) for c in ("ranges_a", "ranges_b"))
                sizes = (frame["size_a"] + frame["size_b"]).to_numpy()
                yield frame.loc[suffix_filter(sizes, x, y, percent), ["a", "b"]]

    pairs = stored(known.mapInPandas(pick, "a long, b long"), "shingle-candidates")
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = _sets(docs, nodes.join(ends, "node", "left_semi"), n)
    both = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.loc[[overlaps(x, y, percent) for x, y in zip(frame["set_a"], frame["set_b"])], ["a", "b"]]

    links = stored(both.select("a", "b", "set_a", "set_b").mapInPandas(run, "a long, b long"), "shingle-links")
    return release(links, sets, pairs)


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(F.col(a), F.col(b)).alias("a"), F.greatest(F.col(a), F.col(b)).alias("b")]


def _shared_postings(nodes: DataFrame) -> DataFrame:
    """(shingle, pos, size, node, PARITIES) of the prefix shingles that more than one set has.

    Of most shingles only the count is shuffled: postings are picked out by a set of bits before.
    """
    all_of = nodes.select(F.explode("prefix").alias("shingle"))
    lists = all_of.groupBy("shingle").agg(F.count(F.lit(1)).alias("_sets")).filter("_sets > 1").select("shingle")
    lists = stored(lists, "shingle-lists")
    slot = F.shiftrightunsigned("shingle", 64 - PICK_BITS).cast("int").alias("slot")
    shared = nodes.sparkSession.sparkContext.broadcast(_bits(lists.select(slot)))

    def pick(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            lengths = frame["prefix"].map(len).to_numpy()
            shingle = np.concatenate(frame["prefix"].to_list()).astype(np.int64)
            pos = np.arange(len(shingle)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            all_rows = pd.DataFrame(
                {
                    "shingle": shingle,
                    "pos": pos.astype(np.int32),
                    "size": np.repeat(frame["n_shingles"].to_numpy(np.int32), lengths),
                    "node": np.repeat(frame["node"].to_numpy(), lengths),
                }
                | dict(zip(PARITIES, np.repeat(np.stack(frame["parity"].to_list()), lengths, axis=0).T))
            )
            yield all_rows[shared.value[shingle.view(np.uint64) >> np.uint64(64 - PICK_BITS)]]

    schema = "shingle long, pos int, size int, node long, " + ", ".join(f"{p} long" for p in PARITIES)
    postings = nodes.select("node", "n_shingles", "parity", "prefix").mapInPandas(pick, schema)
    return release(stored(postings.join(lists, "shingle", "left_semi"), "shingle-postings"), lists)


def _linked(docs: DataFrame, nodes: DataFrame, n: int, percent: int) -> DataFrame:
    """(node, root): which of the distinct sets `nodes` are linked, directly or through others.

    First every posting list is compared with its leader, the set in whose prefix the shingle comes
    first: of near copies, the one that the others were made from. Then only sets of one list
    that are not linked yet are compared, so that a large group of near copies is not paired out.

    Postings are narrow rows of one width. A pair is made at every shingle that both prefixes share, where its lengths, places
    and parity bits still allow a link, and is counted once.
    """
    shared = _shared_postings(nodes)
    own = F.struct("pos", "size", "node", *PARITIES)
    leads = shared.groupBy("shingle").agg(F.min(own).alias("lead"))
    pairs = shared.select("shingle", own.alias("own")).join(leads, "shingle")
    pairs = pairs.filter(F.expr("own.node <> lead.node") & _may_link("own", "lead", percent))
    pairs = stored(pairs.select(*_pair("own.node", "lead.node")).distinct(), "shingle-pairs")
    links = _verified(pairs, docs, nodes, n, percent)
    roots = stored(roots_of(links), "shingle-roots")

    member = shared.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_lists = member.groupBy("shingle").agg(F.min("root").alias("l"), F.max("root").alias("h")).filter("l < h")
    member = stored(member.join(open_lists.select("shingle"), "shingle", "left_semi"), "shingle-members")
    release(shared, shared)
    x, y = (member.select("shingle", F.struct("pos", "size", "node", "root", *PARITIES).alias(side)) for side in "xy")
    rest = x.join(y, "shingle").filter(F.expr("x.node < y.node AND x.root <> y.root") & _may_link("x", "y", percent))
    rest = rest.select(*_pair("x.node", "y.node")).distinct().join(pairs, ["a", "b"], "left_anti")
    rest = release(stored(rest, "shingle-pairs"), member, pairs)
    if rest.isEmpty():
        return roots
    more = _verified(rest, docs, nodes, n, percent)
    return stored(roots_of(more.union(roots.select("node", "root"))), "shingle-roots")


def groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = 5,
    percent: int = 80,
) -> DataFrame:
    """One row per row of `docs`: (id, text_hash, n_shingles, component_id, first_hash).

    Two texts link when 100 * shared shingles >= `percent` * shingles of either. `component_id` is the
    smallest id that links reach; `first_hash` is the `text_hash` of that row. Texts that are null or have
    no word have no shingle and are linked with nothing, not even with each other. Equal sets link;
    repeated rows count once each. An empty table gives no rows. Other columns play no part.

    Texts with equal sets become one set before any comparison, merged in each task first.
    """
    text = F.col(text_col)
    docs = docs.select(
        F.col(id_col).cast("long").alias("_id"), text.alias("_text"), F.xxhash64(text).alias("_text_hash")
    )
    rows = _prefixes(docs, n, percent)
    nodes = (
        rows.filter("n_shingles > 0")
        .groupBy("signature")
        .agg(
            F.first("n_shingles").alias("n_shingles"),
            F.first("ranges").alias("ranges"),
            F.first("parity").alias("parity"),
            F.first("prefix").alias("prefix"),
            F.min(F.struct("id", "text_hash")).alias("first"),
            F.max("id").alias("rep_id"),
            F.count(F.lit(1)).alias("rows"),
        )
        .withColumn("node", F.monotonically_increasing_id())
    )
    nodes = stored(nodes, "shingle-nodes")
    roots = _linked(docs, nodes, n, percent)
    named = nodes.select("node", "signature", "first", "rows").join(roots, "node", "left")
    named = stored(named.withColumn("root", F.coalesce("root", "node")), "shingle-groups")
    first = named.groupBy("root").agg(F.min("first").alias("component"))
    named = named.join(first, "root").select("signature", "component", "rows")
    total = nodes.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    own = rows.select("id", "text_hash", "n_shingles", "signature")
    some = salted_join(own.filter("n_shingles > 0"), named, ["signature"], hot_keys(named, ["signature"], "rows", total))
    none = own.filter("n_shingles = 0")
    columns = ["id", "text_hash", "n_shingles"]
    return some.select(*columns, "component.id", "component.text_hash").union(
        none.select(*columns, "id", "text_hash")
    ).toDF(*columns, "component_id", "first_hash")


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80
) -> DataFrame:
    """`docs` with one document of each group of linked texts: the one of the smallest id.

    Rows that repeat both id and text are one document. Texts without words stay.
    """
    marked = groups(docs, id_col, text_col, n, percent)
    same = F.col("id").eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("first_hash"))
    gone = marked.filter(~same).select(F.col("id").alias("_gone_id"), F.col("text_hash").alias("_gone_hash")).distinct()
    match = F.col(id_col).cast("long").eqNullSafe(F.col("_gone_id")) & (F.xxhash64(F.col(text_col)) == F.col("_gone_hash"))
    return docs.join(gone, match, "left_anti")


def op6(docs: DataFrame) -> DataFrame:
    """The query's columns, for every document: three words, 90 percent."""
    return groups(docs, n=3, percent=90).select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


# All pairs that share a shingle, then the closure of the links.
OP6_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
shingle AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) BETWEEN 1 AND 2 THEN [array_to_string(w, ' ')]
                               ELSE list_transform(list_zip(w, w[2:], w[3:]), lambda t: t[1] || ' ' || t[2] || ' ' || t[3]) END) AS s
    FROM split)
  WHERE s IS NOT NULL
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_both FROM shingle x JOIN shingle y USING (s)
  WHERE x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id
),
link AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * n_both >= 90 * (p.n + q.n - n_both)
),
either AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
walk(doc_id, reached) AS (
  SELECT a, a FROM either
  UNION
  SELECT walk.doc_id, either.b FROM walk JOIN either ON either.a = walk.reached
),
first AS (SELECT doc_id, min(reached) AS component_id FROM walk GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN first USING (doc_id)
"""
