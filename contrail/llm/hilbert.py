"""Approximate nearest neighbours by windows on several Hilbert orderings."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import running, stored

CURVES = 4
# A key has so many bits for each of so many projected directions; both must fit in 62 bits.
DIRECTIONS = 8
BITS = 7
# Rows that the directions' quantiles and the window are fitted on, and queries among them.
SAMPLE = 4096
SAMPLE_QUERIES = 256
# Longest rows that may be neighbours of the sample's queries too: a few can be the nearest of every query.
LONG = 256
# Recall that the window must reach on the sample.
TARGET = 0.97
# Queries that meet the rows of their windows in one group; queries of a group are neighbours on the curve.
GROUP = 512
# A window is made of buckets of rows on the curve: so many cover the table, or buckets of LEAST rows.
BUCKETS = 64
LEAST = 256


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row of integer coordinates below 2 ** bits (Skilling, 2004)."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            t = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ t)
            x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where(x[n - 1] & q, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | x[i] >> b & 1
    return key


@dataclass
class Curves:
    """Orderings of vectors in which neighbours tend to be near each other.

    Vectors get one more coordinate, so that all have the norm of the longest: a larger inner product
    is then a smaller distance. Each curve projects them to random directions of its own and
    cuts each direction at quantiles, shifted by a part of a cell.
    """

    longest: float
    directions: np.ndarray  # curves x (dimensions + 1) x DIRECTIONS
    cuts: np.ndarray  # curves x DIRECTIONS x (2 ** BITS - 1)
    share: float = 1.0  # of all rows, on either side of a query

    @classmethod
    def fit(
        cls, sample: np.ndarray, ids: np.ndarray, longest: float, long: np.ndarray, long_ids: np.ndarray, seed: int = 7
    ) -> Curves:
        rng = np.random.default_rng(seed)
        dimensions = sample.shape[1] + 1
        width = min(DIRECTIONS, dimensions)
        made = [np.linalg.qr(rng.normal(size=(dimensions, dimensions)))[0][:, :width] for _ in range(CURVES)]
        curves = cls(longest, np.array(made), np.zeros((CURVES, width, (1 << BITS) - 1)))
        steps = np.arange((1 << BITS) - 1)
        for c in range(CURVES):
            levels = (steps + (c + 1) / CURVES) / (1 << BITS)
            curves.cuts[c] = np.quantile(curves.lifted(sample) @ curves.directions[c], levels, axis=0).T
        curves.share = curves._share(sample, ids, long, long_ids)
        return curves

    def lifted(self, x: np.ndarray) -> np.ndarray:
        norms = (x * x).sum(1)
        return np.hstack([x, np.sqrt(np.maximum(self.longest**2 - norms, 0))[:, None]])

    def keys(self, x: np.ndarray, query: bool) -> np.ndarray:
        """curves x rows. A query is scaled to the longest norm, which changes no order of its answers."""
        if query:
            x = np.hstack([x * (self.longest / np.sqrt((x * x).sum(1)))[:, None], np.zeros((len(x), 1))])
        else:
            x = self.lifted(x)
        out = []
        for directions, cuts in zip(self.directions, self.cuts):
            flat = x @ directions
            out.append(hilbert(np.stack([np.searchsorted(k, f) for k, f in zip(cuts, flat.T)], 1)))
        return np.array(out)

    def _share(self, sample: np.ndarray, ids: np.ndarray, long: np.ndarray, long_ids: np.ndarray) -> float:
        """The least window that finds TARGET of the sample's neighbours among itself and the `long` rows.

        Queries stand on the curves where `search` puts them. The neighbours are further away than
        those among all rows, so the share errs on the safe side.
        """
        if len(sample) < 64:
            return 1.0
        queries = np.arange(0, len(sample), max(1, len(sample) // SAMPLE_QUERIES))
        rows, row_ids = np.vstack([sample, long]), np.concatenate([ids, long_ids])
        scores = sample[queries] @ rows.T
        scores[ids[queries][:, None] == row_ids] = -np.inf
        near = nearest(scores, row_ids, 20)
        # Places count the sample's rows before, in the order of `search`: key, id, rows before queries.
        all_ids = np.concatenate([row_ids, ids[queries]])
        asks = np.arange(len(all_ids)) >= len(rows)
        counts = np.arange(len(all_ids)) < len(sample)
        apart = []
        for keys in np.hstack([self.keys(rows, False), self.keys(sample[queries], True)]):
            order = np.lexsort((asks, all_ids, keys))
            places = np.zeros(len(order), np.int64)
            places[order] = np.cumsum(counts[order]) - counts[order]
            apart.append(np.abs(places[near] - places[len(rows) :][:, None]))
        found = np.take_along_axis(scores, near, 1) > -np.inf
        least = np.min(apart, 0)[found]
        return float(min(1.0, (np.quantile(least, TARGET) + 1) / len(sample))) if len(least) else 1.0


def nearest(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Columns of the `k` best distinct ids in each row, each id where it scores best; fewer where there are fewer."""
    order = np.argsort(-scores, axis=1)
    firsts = [np.sort(np.unique(ids[some], return_index=True)[1])[:k] for some in order]
    return np.array([some[first] for some, first in zip(order, firsts)])


def _vectors(frame: pd.Series) -> np.ndarray:
    return np.array(frame.to_list(), np.float64).reshape(len(frame), -1)


def usable(vectors: DataFrame, vector: Column) -> DataFrame:
    """Rows whose vector is neither null, empty nor zero, and has no null or non-finite component."""
    double = vector.cast("array<double>")
    fine = F.forall(double, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.filter(vector.isNotNull() & fine & F.exists(double, lambda v: v != 0))


def search(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    every: int = 20,
    k: int = 20,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the `k` nearest found for every row whose id `every` divides.

    Nearest is the largest inner product in double precision, ties by smaller id; a row is no
    candidate of its own query. Vectors that aren't `usable`, or have another length than most, take no
    part; rows without an id are none either. Rows that repeat an id and a vector count once; of an id
    with several vectors, each is a query or candidate and the best counts. An empty table gives no rows.

    All rows are indexed. The rows that the curves and the window are fitted on are a sample of
    SAMPLE rows at most, those of smallest hash, and the LONG longest. Where vectors have no structure, or
    few of them are much longer than the rest, the window that recall needs is a large share of all rows.
    """
    spark = vectors.sparkSession
    double = F.col(vector_col).cast("array<double>")
    rows = usable(vectors, F.col(vector_col)).select(F.col(id_col).cast("long").alias("id"), double.alias("v"))
    rows = stored(rows.filter("id IS NOT NULL").distinct(), "vectors")
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    lengths = rows.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "n")
    most = lengths.first()
    if most is None:
        return empty
    rows = rows.filter(F.size("v") == most["n"])
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    total, longest = rows.agg(F.count(F.lit(1)), F.max(norm)).first()
    if not 0 < longest < float("inf"):
        raise ValueError("norms of the vectors overflow or vanish in double precision")
    sample = rows.orderBy(F.xxhash64("id", "v"), "id").limit(SAMPLE).collect()
    long = rows.orderBy(norm.desc(), "id", F.xxhash64("v")).limit(LONG).collect()
    of = [(np.array([r["v"] for r in some]), np.array([r["id"] for r in some], np.int64)) for some in (sample, long)]
    curves = Curves.fit(*of[0], longest, *of[1])
    fitted = spark.sparkContext.broadcast(curves)

    def index(query: bool):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                if len(frame):
                    for curve, keys in enumerate(fitted.value.keys(_vectors(frame["v"]), query)):
                        yield pd.DataFrame(
                            {"curve": curve, "key": keys, "asks": query, "id": frame["id"], "v": frame["v"]}
                        )

        return run

    # Of equal vectors no more than the k + 1 smallest ids can be an answer; Spark cuts the others before it shuffles.
    alike = Window.partitionBy("v").orderBy("id")
    data = rows.withColumn("nth", F.row_number().over(alike)).filter(F.col("nth") <= k + 1).select("id", "v")
    schema = "curve int, key long, asks boolean, id long, v array<double>"
    keyed = data.mapInPandas(index(False), schema).union(
        rows.filter(F.col("id") % every == 0).mapInPandas(index(True), schema)
    )
    ones = {"place": F.when(F.col("asks"), 0).otherwise(1), "nth": F.col("asks").cast("int")}
    placed = stored(running(keyed, ["curve"], ["key", "id", "asks"], ones, "vector-order"), "vector-places")

    # Neighbouring queries form a group; it needs the buckets around its queries' places.
    width = max(LEAST, -(-total // BUCKETS))
    reach = int(np.ceil(curves.share * total))
    groups = (
        placed.filter("asks")
        .groupBy("curve", F.floor(F.col("nth") / GROUP).alias("group"))
        .agg(F.min("place").alias("low"), F.max("place").alias("high"))
        .select(
            "curve",
            "group",
            F.explode(
                F.sequence(
                    F.floor(F.greatest(F.col("low") - reach, F.lit(0)) / width),
                    F.floor(F.least(F.col("high") + reach, F.lit(total)) / width),
                )
            ).alias("bucket"),
        )
    )
    data = placed.filter("NOT asks").withColumn("bucket", F.floor(F.col("place") / width))
    meeting = data.join(groups, ["curve", "bucket"]).select("curve", "group", "asks", "id", "v")
    queries = placed.filter("asks").select("curve", F.floor(F.col("nth") / GROUP).alias("group"), "asks", "id", "v")
    together = queries.union(meeting).repartition("curve", "group")
    together = together.sortWithinPartitions("curve", "group", F.desc("asks"), "id")

    def near(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Groups stream by, queries first; of each query the best so far are kept."""
        group: tuple | None = None
        best: Best | None = None
        for frame in frames:
            for key, part in frame.groupby(["curve", "group"], sort=False):
                if key != group:
                    if best:
                        yield best.rows()
                    group, best = key, Best(k)
                asks = part["asks"].to_numpy()
                if asks.any():
                    best.ask(part["id"].to_numpy()[asks], _vectors(part["v"][asks]))
                if not asks.all():
                    best.offer(part["id"].to_numpy()[~asks], _vectors(part["v"][~asks]))
        if best:
            yield best.rows()

    found = together.mapInPandas(near, "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


class Best:
    """The `k` best distinct ids for each of a group of queries, as batches of rows come by.

    An id counts with its best vector. Products by block find them; those kept are scored again one by one, in an order of summation that
    doesn't depend on the block, so equal vectors have equal scores.
    """

    def __init__(self, k: int):
        self.keep = k
        self.ids: np.ndarray = np.zeros(0, np.int64)
        self.vectors: np.ndarray | None = None

    def ask(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids = np.append(self.ids, ids)
        self.vectors = vectors if self.vectors is None else np.vstack([self.vectors, vectors])
        self.scores = np.full((len(self.ids), self.keep), -np.inf)
        self.found = np.full((len(self.ids), self.keep), np.iinfo(np.int64).max)

    def offer(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        for i in range(0, len(ids), 2048):
            self._offer(ids[i : i + 2048], vectors[i : i + 2048])

    def _offer(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        scores = self.vectors @ vectors.T
        scores[self.ids[:, None] == ids] = -np.inf
        # Products by block may differ in the last digits.
        slack = 1e-11 * np.sqrt((self.vectors**2).sum(1) * (vectors**2).sum(1).max())[:, None]
        # The best of each id: what is below the best of its own id is no candidate.
        starts = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
        repeats = len(starts) < len(ids)
        tops = np.maximum.reduceat(scores, starts, axis=1) if repeats else scores
        least = self.scores.min(1)
        if len(starts) > self.keep:
            least = np.maximum(least, -np.partition(-tops, self.keep - 1, axis=1)[:, self.keep - 1])
        candidate = (scores > -np.inf) & (scores >= least[:, None] - slack)
        if repeats:
            candidate &= scores >= np.repeat(tops, np.diff(np.append(starts, len(ids))), axis=1) - slack
        row, column = np.nonzero(candidate)
        if not len(row):
            return
        exact = np.concatenate(
            [np.zeros(0)]
            + [
                (self.vectors[row[i : i + 65536]] * vectors[column[i : i + 65536]]).sum(1)
                for i in range(0, len(row), 65536)
            ]
        )
        changed = np.unique(row)
        row = np.concatenate([np.repeat(changed, self.keep), row])
        exact = np.concatenate([self.scores[changed].ravel(), exact])
        found = np.concatenate([self.found[changed].ravel(), ids[column]])
        # An id's lesser scores become empty slots.
        order = np.lexsort((-exact, found, row))
        row, exact, found = row[order], exact[order], found[order]
        again = np.append(False, (row[1:] == row[:-1]) & (found[1:] == found[:-1]))
        exact[again], found[again] = -np.inf, np.iinfo(np.int64).max
        order = np.lexsort((found, -exact, row))
        row, exact, found = row[order], exact[order], found[order]
        # The first `keep` of each row; every row has as many, those it had before.
        first = np.searchsorted(row, changed)
        at = first[:, None] + np.arange(self.keep)
        self.scores[changed], self.found[changed] = exact[at], found[at]

    def rows(self) -> pd.DataFrame:
        some = self.scores > -np.inf
        return pd.DataFrame(
            {
                "query_id": np.repeat(self.ids, some.sum(1)),
                "vec_id": self.found[some],
                "score": self.scores[some],
            }
        )


def op3(vectors: DataFrame) -> DataFrame:
    """The query's columns."""
    return search(vectors)
