"""Nearest neighbours against comparing every query with every row."""

import itertools
import random

import numpy as np

from contrail.llm import hilbert

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def test_curve_visits_neighbours():
    for n, bits in ((2, 4), (3, 2), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=n)))
        keys = hilbert.hilbert(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        path = cells[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def brute(rows, every=20, k=20):
    """{query: [(id, score)]}, in order."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(np.float64)
    out = {}
    for q in sorted({i for i in ids if i % every == 0}):
        best = {}
        for at in np.flatnonzero(ids == q):
            for i, s in zip(ids, (x[at] * x).sum(1)):
                if i != q:
                    best[i] = max(best.get(i, -np.inf), s)
        out[int(q)] = sorted(best.items(), key=lambda p: (-p[1], p[0]))[:k]
    return out


def answers(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r.rank)):
        own = out.setdefault(r.query_id, [])
        own.append((r.vec_id, r.score))
        assert r.rank == len(own)
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in w}) / max(1, len(w)) for q, w in want.items()])


def check(spark, rows, least):
    frame = spark.createDataFrame([(i, [float(c) for c in v], 0, "clash") for i, v in rows], SCHEMA).repartition(6)
    got, want = answers(hilbert.op3(frame)), brute(rows)
    assert set(got) == set(want)
    for q, own in got.items():
        assert own == sorted(own, key=lambda p: (-p[1], p[0])) and q not in dict(own)
        known = dict(want[q])
        assert all(abs(known[i] - s) < 1e-12 for i, s in own if i in known)
    assert recall(got, want) >= least
    return got, want


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(1)
    got, want = check(spark, [(i, rng.normal(size=5)) for i in range(50)], 1)
    assert [[i for i, _ in x] for x in got.values()] == [[i for i, _ in x] for x in want.values()]
    assert len(check(spark, [(0, [1.0, 0.0]), (7, [1.0, 0.0])], 1)[0][0]) == 1
    check(spark, [(i, [1.0, 2.0]) for i in range(300)], 1)  # all alike: the smallest ids


def test_ties_go_to_the_smaller_id(spark):
    rng = np.random.default_rng(4)
    same = rng.normal(size=8)
    rows = [(i, same if i % 3 else rng.normal(size=8) * 0.2) for i in range(3000)]
    got, want = check(spark, rows, 0.95)
    hits = [q for q in want if len({s for _, s in want[q]}) == 1]
    assert hits and all([i for i, _ in got[q]] == [i for i, _ in want[q]] for q in hits)


def test_recall_without_structure_and_with_any_norm(spark):
    rng = np.random.default_rng(2)
    check(spark, [(i, rng.normal(size=32) * rng.uniform(0.5, 2)) for i in range(6000)], 0.9)


def test_recall_in_clusters(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 32)) * 3
    rows = [(i, centres[rng.integers(40)] + rng.normal(size=32) * 0.3) for i in range(6000)]
    check(spark, rows, 0.9)


def flat(rng, n, long):
    """Vectors of norm 1 in 4 of 32 dimensions, the first `long` of norm 10."""
    x = rng.normal(size=(n, 4)) @ rng.normal(size=(4, 32))
    x /= np.sqrt((x * x).sum(1))[:, None]
    x[:long] *= 10
    return [(i + 1, v) for i, v in enumerate(x)]


def test_recall_with_few_long_vectors(spark, monkeypatch):
    # Small groups and buckets, so that the window and not their size settles what is compared.
    monkeypatch.setattr(hilbert, "GROUP", 2)
    monkeypatch.setattr(hilbert, "LEAST", 16)
    monkeypatch.setattr(hilbert, "BUCKETS", 400)
    for long in (0, 1, 30):
        check(spark, flat(np.random.default_rng(5), 6000, long), 0.95)


def test_an_id_with_many_vectors_takes_one_slot(spark):
    # A third of all rows are one id's, all near the queries.
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=8) + 1) for i in range(1, 2001)]
    rows += [(7, 3 + rng.normal(size=8) * 0.1) for _ in range(1000)] + [(40, 3 + rng.normal(size=8)) for _ in range(60)]
    got, _ = check(spark, rows, 0.95)
    assert all(len(x) == 20 for x in got.values())


def test_best_ids_of_blocks():
    rng = np.random.default_rng(7)
    for k in (1, 3, 20):
        ids, x = rng.integers(0, 40, 6000), rng.normal(size=(6000, 4)).round(1)
        best = hilbert.Best(k)
        best.ask(np.array([3, 3, 99]), rng.normal(size=(3, 4)).round(1))
        for i in range(0, 6000, 2500):
            best.offer(ids[i : i + 2500], x[i : i + 2500])
        want = set()
        for q, v in zip(best.ids, best.vectors):
            top = {}
            for i, s in zip(ids.tolist(), (v * x).sum(1).tolist()):
                if i != q:
                    top[i] = max(top.get(i, -np.inf), s)
            want |= {(int(q), i, s) for i, s in sorted(top.items(), key=lambda p: (-p[1], p[0]))[:k]}
        assert set(best.rows().itertuples(index=False, name=None)) == want


def test_whole_table(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    got, want = answers(hilbert.op3(frame)), brute(rows)
    assert set(got) == set(want) and all(len(x) == 20 for x in got.values())
    assert recall(got, want) >= 0.9


def test_odd_rows(spark):
    rng = random.Random(1)
    data = [(i, [rng.random(), rng.random()], 0, "") for i in range(1, 30)]
    data += [(20, None, 0, ""), (40, [0.0, 0.0], 0, ""), (60, [1.0, None], 0, ""), (80, [float("nan"), 1.0], 0, "")]
    data += [(100, [float("inf"), 1.0], 0, ""), (120, [], 0, ""), (140, [1.0], 0, ""), (None, [1.0, 1.0], 0, "")]
    data += [(160, [0.5, 0.5], 0, ""), (160, [0.5, 0.5], 0, "")]
    frame = spark.createDataFrame(data, SCHEMA)
    got = answers(hilbert.op3(frame))
    assert set(got) == {20, 160} and len(got[160]) == 20
    assert hilbert.op3(frame.limit(0)).count() == 0
    assert hilbert.op3(frame.filter("vec_id = 40")).columns == ["query_id", "rank", "vec_id", "score"]
