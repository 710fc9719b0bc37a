"""Clustering against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from contrail.operators import cluster
from contrail.plans import skew

FIELDS = "event_id long, icao24 string, time_position long, latitude double, longitude double"


def brute_force(lat, lon, eps_km, min_pts):
    """Sequential density clustering over rows in order."""
    la, lo = np.radians(lat), np.radians(lon)
    a = np.sin((la[:, None] - la) / 2) ** 2 + np.cos(la[:, None]) * np.cos(la) * np.sin((lo[:, None] - lo) / 2) ** 2
    near = 2 * 6371.0 * np.arcsin(np.minimum(1, np.sqrt(a))) <= eps_km
    core = near.sum(axis=1) >= min_pts
    label = np.full(len(lat), -1)
    number = 0
    for start in range(len(lat)):
        if label[start] != -1 or not core[start]:
            continue
        label[start] = number
        todo = [start]
        while todo:
            for other in np.flatnonzero(near[todo.pop()]):
                if label[other] == -1:
                    label[other] = number
                    if core[other]:
                        todo.append(other)
        number += 1
    return label


def run(spark, lat, lon, eps_km, min_pts):
    rows = [(i, f"{i:06x}", i, float(a), float(b)) for i, (a, b) in enumerate(zip(lat, lon))]
    df = spark.createDataFrame(rows, FIELDS)
    got = cluster.dbscan(df, eps_km, min_pts).select("event_id", "cluster").collect()
    assert len(got) == len(rows)
    return np.array([c for _, c in sorted((r["event_id"], r["cluster"]) for r in got)])


def check(spark, lat, lon, eps_km=15, min_pts=5):
    expected = brute_force(np.array(lat), np.array(lon), eps_km, min_pts)
    assert (run(spark, lat, lon, eps_km, min_pts) == expected).all()
    return expected


@pytest.mark.parametrize("seed, eps_km, min_pts, spread", [(1, 15, 5, 2.2), (2, 15, 3, 3.0), (3, 50, 8, 7.0)])
def test_scattered(spark, seed, eps_km, min_pts, spread):
    rng = np.random.default_rng(seed)
    lat, lon = 20 + rng.uniform(0, spread, 400), 75 + rng.uniform(0, spread, 400)
    assert check(spark, lat, lon, eps_km, min_pts).max() > 0


def test_blobs_with_copies(spark):
    """A third of all rows at one place, others near the reach of it."""
    rng = np.random.default_rng(4)
    lat = np.concatenate([np.full(200, 10.0), rng.normal(10, 0.1, 250), rng.normal(11, 0.08, 150)])
    lon = np.concatenate([np.full(200, 70.0), rng.normal(70, 0.1, 250), rng.normal(70.5, 0.08, 150)])
    order = rng.permutation(len(lat))
    assert check(spark, lat[order], lon[order]).max() >= 1


def test_two_dense_arcs_at_the_reach(spark):
    """Dense cells whose points lie just within and just beyond reach of each other."""
    rng = np.random.default_rng(5)
    step = np.degrees(15 / 6371.0)
    ends = [step * 0.9999, step * 1.0001 * 2]
    lat = np.concatenate([rng.normal(0.05, 0.002, 60) * 0 + 0.05 + end for end in [0, *ends]])
    lon = np.concatenate([30 + rng.uniform(0, 0.002, 60) for _ in range(3)])
    check(spark, lat, lon)


def test_curved_gap(spark):
    """Many points on two arcs, so most boxes stay undecided for some rounds."""
    angle = np.linspace(0, np.pi / 2, 150)
    reach = np.degrees(15 / 6371.0)
    for factor in (0.999, 1.001):
        inner = np.stack([0.01 * np.sin(angle), 0.01 * np.cos(angle)])
        outer = np.stack([(0.01 + reach * factor) * np.sin(angle), (0.01 + reach * factor) * np.cos(angle)])
        both = np.concatenate([inner, outer], axis=1)
        check(spark, both[0] + 1.0, both[1] + 40.0)


@pytest.mark.parametrize("lat0, lon0, width", [(0, 180, 0.6), (60, -180, 1.2), (-80, 179.5, 3.0), (89.8, 0, 360.0)])
def test_wrap_and_poles(spark, lat0, lon0, width):
    rng = np.random.default_rng(6)
    lat = np.clip(lat0 + rng.uniform(-0.3, 0.3, 200), -90, 90)
    lon = (lon0 + rng.uniform(-width / 2, width / 2, 200) + 180) % 360 - 180
    check(spark, lat, lon)


def test_hot_cells_are_salted(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 10)
    monkeypatch.setattr(skew, "MAX_HOT", 1000)
    rng = np.random.default_rng(7)
    lat = np.concatenate([rng.normal(10, 0.02, 200), rng.normal(10, 0.3, 100), np.full(80, 10.0)])
    lon = np.concatenate([rng.normal(70, 0.02, 200), rng.normal(70, 0.3, 100), np.full(80, 70.0)])
    check(spark, lat, lon)


def test_nothing_to_cluster(spark):
    assert (run(spark, [0.0, 10.0, 20.0], [0.0, 10.0, 20.0], 15, 5) == -1).all()
    empty = spark.createDataFrame([], FIELDS)
    assert cluster.dbscan(empty).count() == 0
    with pytest.raises(ValueError):
        cluster.Grid(51)


def test_components(spark):
    rng = np.random.default_rng(8)
    pairs = [(i, i + 1) for i in range(40)] + [(100 + int(a), 100 + int(b)) for a, b in rng.integers(0, 60, (50, 2))]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a != b:
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    expected = {x: min(y for y in list(parent) if find(y) == find(x)) for x in list(parent)}
    edges = spark.createDataFrame(pairs, "a long, b long")
    got = {r["node"]: r["root"] for r in cluster.components(edges).collect()}
    assert got == expected


def test_date_line_is_one_place_however_written(spark):
    lat, lon = [10.0, 10.0, 10.05], [180.0, -180.0, -179.95]
    assert (run(spark, lat, lon, 15, 5) == -1).all()
    assert (run(spark, lat * 2, lon * 2, 15, 5) == 0).all()
    # Sites of several reports on either side, and apart.
    check(spark, [10.0, 10.0, 10.05, 10.05, 10.1, -10.0, 0.0, -0.0], [180.0, -180.0, 180.0, -179.99, 179.99, 180.0, 0.0, -0.0])
    rng = np.random.default_rng(11)
    at = rng.integers(0, 4, 120)
    check(spark, 10 + rng.integers(0, 40, 120) / 50, np.array([180.0, -180.0, 179.9, -179.95])[at])


def test_few_approach_reports_are_kept(spark):
    rows = spark.range(10).select(
        F.col("id").alias("time_position"),
        F.lit("801642").alias("icao24"),
        F.lit(100.0).alias("baro_altitude"),
        F.lit(50.0).alias("velocity"),
        F.lit(28.5).alias("latitude"),
        F.lit(77.1).alias("longitude"),
    )
    assert [r["cluster"] for r in cluster.approach_clusters(rows).collect()] == [0] * 10
    assert [r["cluster"] for r in cluster.approach_clusters(rows.limit(3)).collect()] == [-1] * 3
