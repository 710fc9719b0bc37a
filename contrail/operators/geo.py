"""Distance, radar, density and place operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.functions.geo import box_filter, distance_km, feet, hex_axial, knots
from contrail.functions.numeric import row_count
from contrail.operators.clean import filter_valid_coords
from contrail.operators.marts import airline_prefix
from contrail.schema import EMERGENCY_SQUAWK, PLACES, RADAR_CENTRE

# The heat map shows cells from a tenth of the peak; columns of the
# hexagon map are up to 3000 high in 6 colours.
HEAT_THRESHOLD = 0.1
HEX_HEIGHT = 3000.0
HEX_COLOURS = 6


def _distance_to(centre: tuple[float, float]) -> Column:
    return distance_km(F.col("latitude"), F.col("longitude"), F.lit(centre[0]), F.lit(centre[1]))


def with_distance(df: DataFrame, centre: tuple[float, float] = RADAR_CENTRE) -> DataFrame:
    return df.withColumn("distance_km", _distance_to(centre))


def within_radius(
    df: DataFrame, centre: tuple[float, float] = RADAR_CENTRE, km: float = 100
) -> DataFrame:
    """Rows within `km` of the centre, nearest first. A box filter goes to the scan."""
    near = df.filter(box_filter(F.col("latitude"), F.col("longitude"), centre, km))
    return with_distance(near, centre).filter(F.col("distance_km") <= km).orderBy("distance_km", "icao24")


def radius_split(
    df: DataFrame, centre: tuple[float, float] = RADAR_CENTRE, km: float = 100
) -> DataFrame:
    """Rows and aircraft inside and outside the radius."""
    side = F.when(F.col("distance_km") <= km, F.lit("local")).otherwise(F.lit("other"))
    return (
        with_distance(filter_valid_coords(df), centre)
        .groupBy(side.alias("side"))
        .agg(row_count().alias("rows"), F.count_distinct("icao24").alias("aircraft"))
    )


def radar_rows(
    latest: DataFrame, centre: tuple[float, float] = RADAR_CENTRE, km: float = 100
) -> DataFrame:
    """Both radar tables, nearest first: `side` is `local` or `other`."""
    side = F.when(F.col("distance_km") <= km, F.lit("local")).otherwise(F.lit("other"))
    rows = unit_columns(with_distance(latest, centre))
    return rows.withColumn("side", side).orderBy("distance_km", "icao24")


def interleaved(lat: str = "latitude", lon: str = "longitude", bits: int = 16) -> Column:
    """Row and column of a position on a grid of 2^bits a side, bit by bit in turn: near numbers are near places."""
    side = F.lit(float(1 << bits))
    row = F.floor((F.col(lat) + 90.0) / 180.0 * side).cast("long")
    column = F.floor((F.col(lon) + 180.0) / 360.0 * side).cast("long")
    key = F.lit(0).cast("long")
    for i in range(bits):
        for value, shift in ((row, 2 * i + 1), (column, 2 * i)):
            key = key.bitwiseOR(F.shiftleft(F.shiftright(value, i).bitwiseAND(F.lit(1)), shift))
    return key


def unit_columns(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"altitude_ft": feet(F.col("baro_altitude")), "speed_kt": knots(F.col("velocity"))}
    )


def radar_kpis(
    latest: DataFrame, centre: tuple[float, float] = RADAR_CENTRE, km: float = 100
) -> DataFrame:
    """Insight cards over the latest position of each aircraft, one row.

    Ties go to the nearer aircraft. Rows are first reduced per carrier, so the whole
    answer takes one pass.
    """
    rows = unit_columns(with_distance(latest, centre))
    nearer = (-F.col("distance_km")).alias("nearer")

    def best(value: str) -> Column:
        entry = F.struct(F.col(value).alias("value"), nearer, F.col("callsign"))
        return F.max(F.when(F.col(value) > 0, entry))

    carriers = rows.groupBy(airline_prefix().alias("code")).agg(
        row_count().alias("n"),
        F.count_if(F.col("distance_km") <= km).alias("local"),
        best("speed_kt").alias("fastest"),
        best("baro_altitude").alias("highest"),
        F.count_if(F.col("squawk") == EMERGENCY_SQUAWK).alias("emergencies"),
    )
    busiest = F.min(F.when(F.col("code").isNotNull(), F.struct((-F.col("n")).alias("n"), F.col("code"))))
    return carriers.agg(
        F.sum("n").alias("total"),
        F.sum("local").alias("local"),
        F.max("fastest").alias("fastest"),
        F.max("highest").alias("highest"),
        busiest.alias("busiest"),
        F.sum("emergencies").alias("emergencies"),
    ).select(
        "total",
        "local",
        (F.col("total") - F.col("local")).alias("national"),
        F.col("fastest.value").alias("fastest_kt"),
        F.col("fastest.callsign").alias("fastest_callsign"),
        feet(F.col("highest.value")).alias("highest_ft"),
        F.col("highest.callsign").alias("highest_callsign"),
        F.col("busiest.code").alias("top_airline"),
        (-F.col("busiest.n")).alias("top_airline_count"),
        "emergencies",
    )


def emergencies(df: DataFrame) -> DataFrame:
    """Every row with the emergency squawk."""
    return df.filter(F.col("squawk") == EMERGENCY_SQUAWK)


# --- density ---------------------------------------------------------------


def density_grid(
    df: DataFrame,
    cell_deg: float = 0.5,
    weight: str = "velocity",
) -> DataFrame:
    """Weight per grid cell and its share of the heaviest cell. A heat map shows cells whose
    share is HEAT_THRESHOLD or more."""
    rows = filter_valid_coords(df)
    cells = rows.groupBy(
        F.floor(F.col("latitude") / F.lit(cell_deg)).alias("cell_lat"),
        F.floor(F.col("longitude") / F.lit(cell_deg)).alias("cell_lon"),
    ).agg(F.sum(weight).alias("weight"), row_count().alias("points"))
    # Both columns are asked for, so that the cells are computed once for both uses.
    peak = cells.agg(F.struct(F.max("weight").alias("weight"), F.max("points"))).scalar()["weight"]
    return cells.withColumn("share", F.col("weight") / peak)


def hex_counts(df: DataFrame, radius_m: float = 20000) -> DataFrame:
    """Reports per hexagon, with column height and colour class over the range of counts."""
    q, r = hex_axial(F.col("latitude"), F.col("longitude"), radius_m)
    cells = filter_valid_coords(df).groupBy(q.alias("q"), r.alias("r")).agg(row_count().alias("points"))
    low, high = cells.agg(F.min("points")).scalar(), cells.agg(F.max("points")).scalar()
    above = F.col("points") - F.col("low")
    span = F.greatest(F.col("high") - F.col("low"), F.lit(1))
    return (
        cells.withColumns({"low": low, "high": high})
        .withColumns(
            {
                "height": above * F.lit(HEX_HEIGHT) / span,
                "colour": F.least(F.floor(above * HEX_COLOURS / span), F.lit(HEX_COLOURS - 1)).cast("int"),
            }
        )
        .drop("low", "high")
    )


# --- places ----------------------------------------------------------------


def match_places(
    centres: DataFrame,
    places: list[tuple[str, float, float]] = PLACES,
    tolerance: float = 0.5,
) -> DataFrame:
    """Add `place`: the first listed place within `tolerance` degrees, else "Unknown".

    The list is a short literal, so this is one expression and not a join; for a table of places there is
    `match_place_table`.
    """
    match = F.lit(None).cast("string")
    for name, lat, lon in reversed(places):
        north, east = F.col("latitude") - F.lit(lat), F.col("longitude") - F.lit(lon)
        near = F.sqrt(north * north + east * east) < tolerance
        match = F.when(near, F.lit(name)).otherwise(match)
    return centres.withColumn("place", F.coalesce(match, F.lit("Unknown")))


def match_place_table(centres: DataFrame, places: DataFrame, tolerance: float = 0.5) -> DataFrame:
    """`match_places` against a table of places (pos, name, latitude, longitude): the lowest `pos` in reach.

    A grid of `tolerance` degrees makes it an equi-join: a place is copied to the nine cells that it can reach, a
    centre stands in one. Candidates are reduced to one row a centre in the task that joins them, before they are
    shuffled; a busy cell is left to Spark's skew join, which may split its centres. Centres without a position match nothing.
    """
    step = F.lit(float(tolerance))
    row, column = (lambda c: F.floor(c / step)), (lambda c: F.floor(c / step))
    around = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    reached = places.select(
        F.col("pos").alias("_pos"),
        F.col("name").alias("_name"),
        F.col("latitude").alias("_lat"),
        F.col("longitude").alias("_lon"),
        F.explode(around).alias("_d"),
    ).select(
        "_pos", "_name", "_lat", "_lon",
        (row(F.col("_lat")) + F.col("_d.i")).alias("_row"), (column(F.col("_lon")) + F.col("_d.j")).alias("_column"),
    )
    held = centres.select(
        F.struct("*").alias("_centre"),
        F.monotonically_increasing_id().alias("_id"),
        row(F.col("latitude")).alias("_row"),
        column(F.col("longitude")).alias("_column"),
    )
    north, east = F.col("_centre.latitude") - F.col("_lat"), F.col("_centre.longitude") - F.col("_lon")
    near = F.sqrt(north * north + east * east) < tolerance
    found = held.join(reached, ["_row", "_column"], "left").groupBy("_id").agg(
        F.first("_centre").alias("_centre"), F.min(F.when(near, F.struct("_pos", "_name"))).alias("_found")
    )
    return found.select("_centre.*", F.coalesce("_found._name", F.lit("Unknown")).alias("place"))
