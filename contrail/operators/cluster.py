"""Density clustering of positions on the sphere.

Grid method (Gunawan 2013; Gan and Tao, SIGMOD 2015). A cell is so small that any two
of its points are within reach of each other. So a cell with `min_pts` points is dense
and all its points are core without any distance test. Points of other cells, fewer
than `min_pts` a cell, are tested against the cells around them; the number of tests is
linear in the data. Whether two dense cells touch is settled by splitting both into
finer and finer boxes, not by comparing their points.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail import session
from contrail.functions.geo import distance_km
from contrail.functions.numeric import exact_mean
from contrail.plans.skew import hot_keys, salted_join
from contrail.schema import EARTH_KM

# Limits of the approach phase.
APPROACH_ALTITUDE = 1500
APPROACH_VELOCITY = 120

SPLIT = 4  # boxes per side and refinement step; a power of two keeps the split exact


def low_slow(df: DataFrame) -> DataFrame:
    """Reports of the approach phase."""
    return df.filter((F.col("baro_altitude") < APPROACH_ALTITUDE) & (F.col("velocity") < APPROACH_VELOCITY))


class Grid:
    """Cells whose diagonal is below eps at every latitude; columns wrap at the date line."""

    def __init__(self, eps_km: float):
        if not 0 < eps_km <= 50:
            raise ValueError("eps_km must be above 0 and at most 50")
        self.eps = eps_km
        self.angle = eps_km / EARTH_KM
        # The factor covers the curvature of the cell for eps up to 50 km.
        self.height = math.degrees(self.angle) / math.sqrt(2) * (1 - 1e-5)
        self.columns = math.ceil(360 / self.height)
        self.width = 360 / self.columns

    def row_at(self, lat: Column, scale: int = 1) -> Column:
        return F.floor(lat / F.lit(self.height) * F.lit(float(scale)))

    def column_at(self, lon: Column, scale: int = 1) -> Column:
        index = F.floor((lon + 180.0) / F.lit(self.width) * F.lit(float(scale)))
        return F.least(index, F.lit(self.columns * scale - 1))

    def cell(self, row: Column, column: Column) -> Column:
        return row * self.columns + column

    def reach(self, lat: Column) -> Column:
        """Columns to each side that a point at |lat| up to `lat` can reach."""
        half = self.columns // 2
        ratio = F.lit(math.sin(self.angle)) / F.cos(F.radians(lat))
        near_pole = (lat + math.degrees(self.angle) >= 90) | (ratio >= 1)
        widest = F.degrees(F.asin(F.least(ratio, F.lit(1.0)))) * (1 + 1e-9)
        span = F.ceil(widest / F.lit(self.width))
        return F.when(near_pole, F.lit(half)).otherwise(F.least(span, F.lit(half))).cast("int")

    def around(self, df: DataFrame, target: str = "near_cell") -> DataFrame:
        """One row per cell within reach of the row's cell, itself included."""
        top = F.least(
            F.greatest(F.abs(F.col("row")), F.abs(F.col("row") + 1)) * F.lit(self.height), F.lit(90.0)
        )
        rows = df.withColumn("_reach", self.reach(top)).withColumn(
            "_row", F.explode(F.transform(F.sequence(F.lit(-2), F.lit(2)), lambda d: F.col("row") + d))
        )
        shifts = F.transform(
            F.sequence(-F.col("_reach"), F.col("_reach")),
            lambda d: F.pmod(F.col("column") + d, F.lit(self.columns)),
        )
        columns = rows.withColumn("_column", F.explode(F.array_distinct(shifts)))
        return columns.withColumn(target, self.cell(F.col("_row"), F.col("_column"))).drop(
            "_reach", "_row", "_column"
        )


def _within(grid: Grid, left: str, right: str) -> Column:
    return (
        distance_km(
            F.col(f"{left}lat"), F.col(f"{left}lon"), F.col(f"{right}lat"), F.col(f"{right}lon")
        )
        <= grid.eps
    )


# --- dense cells that touch ------------------------------------------------


def _boxes(sites: DataFrame, dense: DataFrame, grid: Grid, scale: int) -> DataFrame:
    """Bounding box, two real points and size of every box of a dense cell at this scale.

    Dense cells are picked after the aggregation, so no busy cell is joined by its points.
    """
    boxes = sites.groupBy(
        "cell",
        grid.row_at(F.col("lat"), scale).alias("r"),
        grid.column_at(F.col("lon"), scale).alias("c"),
    ).agg(
        F.min("lat").alias("south"),
        F.max("lat").alias("north"),
        F.min("lon").alias("west"),
        F.max("lon").alias("east"),
        F.min_by("lon", "lat").alias("south_lon"),
        F.max_by("lon", "lat").alias("north_lon"),
        F.count(F.lit(1)).alias("sites"),
    )
    return boxes.join(dense, "cell", "left_semi")


def _side(boxes: DataFrame, name: str) -> DataFrame:
    return boxes.select(*[F.col(column).alias(f"{name}_{column}") for column in boxes.columns])


def _judge(pairs: DataFrame, grid: Grid) -> DataFrame:
    """Add `touch` (two real points are within reach) and `open` (still undecided)."""

    def point(side: str, edge: str) -> tuple[Column, Column]:
        return F.col(f"{side}_{edge}"), F.col(f"{side}_{edge}_lon")

    touch = F.lit(False)
    for edge_a in ("south", "north"):
        for edge_b in ("south", "north"):
            touch = touch | (distance_km(*point("a", edge_a), *point("b", edge_b)) <= grid.eps)

    zero = F.lit(0.0)
    lat_gap = F.greatest(
        F.col("a_south") - F.col("b_north"), F.col("b_south") - F.col("a_north"), zero
    )
    ahead = F.col("b_west") - F.col("a_east")
    behind = F.col("a_west") - F.col("b_east")
    lon_gap = F.greatest(
        F.when(ahead >= 0, F.least(ahead, F.col("a_west") + 360 - F.col("b_east")))
        .when(behind >= 0, F.least(behind, F.col("b_west") + 360 - F.col("a_east")))
        .otherwise(zero),
        zero,
    )

    def flat(side: str) -> Column:
        farthest = F.greatest(F.abs(F.col(f"{side}_south")), F.abs(F.col(f"{side}_north")))
        return F.cos(F.radians(farthest))

    half_lat, half_lon = F.sin(F.radians(lat_gap) / 2), F.sin(F.radians(lon_gap) / 2)
    bound = half_lat * half_lat + flat("a") * flat("b") * half_lon * half_lon
    limit = math.sin(grid.angle / 2) ** 2 * (1 + 1e-9)
    single = (F.col("a_sites") == 1) & (F.col("b_sites") == 1)
    return pairs.withColumn("touch", touch).withColumn(
        "open", ~F.col("touch") & ~single & (bound <= F.lit(limit))
    )


def _dense_edges(sites: DataFrame, dense: DataFrame, grid: Grid) -> DataFrame:
    """Pairs of dense cells with two points within reach.

    Pairs of boxes are accepted when two real points are close enough, dropped when the
    boxes are too far apart, and split otherwise. A pair of single points is always
    decided, so the loop ends; it does not depend on how many points a cell holds.
    """
    boxes = _boxes(sites, dense, grid, 1)
    cells = boxes.select("cell", F.col("r").alias("row"), F.col("c").alias("column"))
    forward = grid.around(cells).filter(F.col("near_cell") > F.col("cell"))
    first = (
        forward.select(F.col("cell").alias("a_cell"), F.col("near_cell").alias("b_cell"))
        .join(_side(boxes, "a"), "a_cell")
        .join(_side(boxes, "b"), "b_cell")
    )
    judged = _judge(first, grid).filter("touch or open").checkpoint()
    edges = judged.filter("touch").select("a_cell", "b_cell")
    scale = 1
    keys = ["a_cell", "b_cell"]
    undecided = judged.filter("open").select(*keys, "a_r", "a_c", "b_r", "b_c")
    while not undecided.isEmpty():
        scale *= SPLIT
        boxes = _boxes(sites, dense, grid, scale).withColumns(
            {"up_r": F.floor(F.col("r") / SPLIT), "up_c": F.floor(F.col("c") / SPLIT)}
        )

        def children(side: str) -> DataFrame:
            named = _side(boxes, side)
            return named.withColumnsRenamed(
                {
                    f"{side}_r": f"{side}_new_r",
                    f"{side}_c": f"{side}_new_c",
                    f"{side}_up_r": f"{side}_r",
                    f"{side}_up_c": f"{side}_c",
                }
            )

        split = undecided.join(children("a"), ["a_cell", "a_r", "a_c"]).join(
            children("b"), ["b_cell", "b_r", "b_c"]
        )
        judged = _judge(split, grid).filter("touch or open").checkpoint()
        found = judged.filter("touch").select(*keys).distinct()
        edges = edges.union(found)
        undecided = (
            judged.filter("open")
            .select(
                *keys,
                F.col("a_new_r").alias("a_r"),
                F.col("a_new_c").alias("a_c"),
                F.col("b_new_r").alias("b_r"),
                F.col("b_new_c").alias("b_c"),
            )
            .join(found, keys, "left_anti")
        )
    return edges.select(F.col("a_cell").alias("a"), F.col("b_cell").alias("b"))


# --- connected components --------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge; root is the smallest node it can reach.

    Alternating large-star and small-star (Kiveris et al., SoCC 2014). Nodes are grid
    cells, whose number is bounded by the globe and not by the data.
    """
    current = edges.filter("a <> b").select("a", "b").distinct().checkpoint()
    mark = None
    while True:
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        ).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = small.filter("a <> b").union(low.select("a", F.col("m").alias("b"))).distinct().checkpoint()
        state = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
        ).first()
        if state == mark:
            break
        mark = state
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


# --- clustering ------------------------------------------------------------


def dbscan(df: DataFrame, eps_km: float = 15, min_pts: int = 5) -> DataFrame:
    """Add `cluster`: 0, 1, .. in the order of each cluster's first core report, -1 for noise.

    A point counts among its own neighbours. A point on the edge of several clusters
    goes to the lowest number, as in the sequential method over rows in time order.
    `eps_km` may be 50 at most: the grid is exact up to that reach. Longitudes may be written
    either way at the date line. The input is read at the start, for its places, and again when
    the numbers are joined to it; of it nothing but the places is written out.
    """
    session.shared_dir(df.sparkSession)
    grid = Grid(eps_km)
    rows = df.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    # One way of writing a place comes first, or its sites would be told apart.
    lon = F.pmod(F.col("longitude") + 180.0, F.lit(360.0)) - 180.0
    lon = F.when(F.col("longitude").between(-180, 179.9999999), F.col("longitude")).otherwise(lon) + 0.0
    place = [(F.col("latitude") + 0.0).alias("lat"), lon.alias("lon")]
    sites = (
        rows.groupBy(*place)
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("time_position", "icao24")).alias("first"))
        .withColumns({"row": grid.row_at(F.col("lat")), "column": grid.column_at(F.col("lon"))})
        .withColumn("cell", grid.cell(F.col("row"), F.col("column")))
        .checkpoint()
    )
    site_total, row_total = sites.agg(
        F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))
    ).first()
    cells = sites.groupBy("cell").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("sites"), F.min("first").alias("first")
    )
    dense = cells.filter(F.col("n") >= min_pts).select("cell")

    # Sites of sparse cells. At most min_pts sites per cell get past the row number, so
    # no task holds a busy cell; a cell that fills up to min_pts points is dense.
    order = Window.partitionBy("cell").orderBy("lat", "lon")
    sparse = (
        sites.withColumn("_nth", F.row_number().over(order))
        .filter(F.col("_nth") <= min_pts)
        .withColumn("_points", F.sum("n").over(Window.partitionBy("cell")))
        .filter(F.col("_points") < min_pts)
        .drop("_nth", "_points")
        .checkpoint()
    )

    # Points within reach of each sparse site, per cell around it.
    hot_cells = hot_keys(cells, ["cell"], "sites", site_total)
    probes = grid.around(sparse, "cell_around").select(
        F.col("lat").alias("p_lat"),
        F.col("lon").alias("p_lon"),
        F.col("cell").alias("p_cell"),
        F.col("cell_around").alias("cell"),
    )
    targets = sites.select("cell", F.col("lat").alias("t_lat"), F.col("lon").alias("t_lon"), "n")
    around = (
        salted_join(targets, probes, ["cell"], hot_cells)
        .filter(_within(grid, "p_", "t_"))
        .groupBy("p_lat", "p_lon", "p_cell", "cell")
        .agg(F.sum("n").alias("n"))
        .checkpoint()
    )
    site = ["p_lat", "p_lon", "p_cell"]
    sparse_core = (
        around.groupBy(*site).agg(F.sum("n").alias("n")).filter(F.col("n") >= min_pts).select(*site).checkpoint()
    )
    # Reach into dense cells, where every point is core, and to sparse core sites. Both
    # sides of the second join hold fewer than min_pts sites a cell.
    dense_reach = around.join(dense, "cell", "left_semi").select(*site, "cell")
    core_targets = sparse_core.select(
        F.col("p_lat").alias("t_lat"), F.col("p_lon").alias("t_lon"), F.col("p_cell").alias("cell")
    )
    sparse_reach = (
        probes.join(core_targets, "cell").filter(_within(grid, "p_", "t_")).select(*site, "cell").distinct()
    )
    core_reach = dense_reach.union(sparse_reach).checkpoint()

    edges = (
        core_reach.join(sparse_core, site, "left_semi")
        .select(F.col("p_cell").alias("a"), F.col("cell").alias("b"))
        .union(_dense_edges(sites, dense, grid))
    )
    linked = components(edges)

    # Number the clusters by their first core report.
    core_cells = (
        cells.filter(F.col("n") >= min_pts)
        .select("cell", "first")
        .union(
            sparse_core.join(
                sparse.select(
                    F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"), F.col("cell").alias("p_cell"), "first"
                ),
                site,
            )
            .groupBy(F.col("p_cell").alias("cell"))
            .agg(F.min("first").alias("first"))
        )
        .join(linked.withColumnRenamed("node", "cell"), "cell", "left")
        .select("cell", "first", F.coalesce("root", "cell").alias("root"))
    )
    # One row per cluster, and clusters are more than eps apart: the globe bounds them.
    numbers = (
        core_cells.groupBy("root")
        .agg(F.min("first").alias("first"))
        .select(
            "root",
            (F.row_number().over(Window.partitionBy().orderBy("first")) - 1).cast("int").alias("cluster"),
        )
    )
    cell_cluster = core_cells.join(numbers, "root").select("cell", "cluster").checkpoint()

    # Sites of dense cells take their cell's number; sparse sites the lowest in reach,
    # which for a core site is its own.
    sparse_label = (
        core_reach.join(cell_cluster, "cell")
        .groupBy("p_lat", "p_lon")
        .agg(F.min("cluster").alias("site_cluster"))
    )
    dense_label = cell_cluster.join(dense, "cell", "left_semi")
    labels = (
        salted_join(
            sites.select("lat", "lon", "n", "cell"),
            cells.select("cell").join(dense_label, "cell", "left"),
            ["cell"],
            hot_cells,
        )
        .join(
            sparse_label.withColumnsRenamed({"p_lat": "lat", "p_lon": "lon"}), ["lat", "lon"], "left"
        )
        .select(
            "lat",
            "lon",
            "n",
            F.coalesce("cluster", "site_cluster", F.lit(-1)).cast("int").alias("cluster"),
        )
    )
    hot_sites = hot_keys(labels, ["lat", "lon"], "n", row_total)
    placed = rows.select("*", *place)
    return salted_join(placed, labels.select("lat", "lon", "cluster"), ["lat", "lon"], hot_sites).select(
        *rows.columns, "cluster"
    )


def approach_clusters(df: DataFrame, eps_km: float = 15, min_pts: int = 5) -> DataFrame:
    """Clusters of approach-phase reports: likely airports."""
    return dbscan(low_slow(df), eps_km, min_pts)


def cluster_summary(clustered: DataFrame) -> DataFrame:
    """Centre, averages, points and aircraft of each cluster, noise left out."""
    return (
        clustered.filter(F.col("cluster") != -1)
        .groupBy("cluster")
        .agg(
            exact_mean("latitude").alias("latitude"),
            exact_mean("longitude").alias("longitude"),
            F.avg("baro_altitude").alias("avg_altitude"),
            F.avg("velocity").alias("avg_velocity"),
            F.count(F.lit(1)).alias("data_points"),
            F.count_distinct("icao24").alias("unique_aircraft"),
        )
        .orderBy(F.desc("data_points"), "cluster")
    )


def cluster_count(clustered: DataFrame) -> DataFrame:
    return clustered.agg(
        F.count_distinct(F.when(F.col("cluster") != -1, F.col("cluster"))).alias("clusters"),
        F.count_if(F.col("cluster") == -1).alias("noise"),
    )
