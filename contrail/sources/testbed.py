"""Position reports derived from the driver's `events` and `nation` tables.

Every event becomes one report and every twentieth arrives twice, so the whole
table is used. Values are integer arithmetic with one final division.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.operators import clean
from contrail.schema import PLACES

AS_OF = "2024-01-31 00:00:00"
AS_OF_EPOCH = 1706659200

# Airline prefixes, three letters each.
PREFIXES = "AICIGOVTIUAEQTRSIA"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def positions_from_events(events: DataFrame, nation: DataFrame) -> DataFrame:
    """Raw reports, repeats included; works on a batch or a streaming frame."""
    event_id, user_id = F.col("event_id"), F.col("user_id")
    near = (event_id % 4 == 0) & (event_id % 52 != 0)
    approach = event_id % 4 == 0
    k = F.col("k")
    place_lat = F.array(*[F.lit(round(lat * 1000)) for _, lat, _ in PLACES])
    place_lon = F.array(*[F.lit(round(lon * 1000)) for _, _, lon in PLACES])
    place = (user_id % 8).cast("int")
    code = F.substring(F.lit(PREFIXES), (user_id % 6).cast("int") * 3 + 1, F.lit(3))
    measured = events.select(
        "event_id",
        "user_id",
        F.col("ts").cast("timestamp").alias("seen"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"),
    )

    base = measured.select(
        "event_id",
        (user_id % 25).cast("int").alias("n_nationkey"),
        F.when(event_id % 499 == 0, F.lit("INVALID"))
        .otherwise(F.lpad(F.lower(F.hex(user_id)), 6, "0"))
        .alias("icao24"),
        F.when(user_id % 13 == 0, F.lit(None).cast("string"))
        .when(user_id % 11 == 0, F.concat(F.lit("7"), user_id.cast("string")))
        .when(event_id % 10 == 0, F.concat(F.lit("  "), code, user_id.cast("string"), F.lit(" ")))
        .otherwise(F.concat(code, user_id.cast("string")))
        .alias("callsign"),
        F.expr("unix_micros(seen) div 1000000").alias("time_position"),
        F.when(event_id % 97 == 0, F.lit(None).cast("double"))
        .when(near, (F.get(place_lon, place) + ((event_id % 11) - 5) * 10) / F.lit(1000.0))
        .otherwise((F.lit(6400) + event_id * 53 % 3600) / F.lit(100.0))
        .alias("longitude"),
        F.when(near, (F.get(place_lat, place) + ((k % 11) - 5) * 10) / F.lit(1000.0))
        .otherwise((F.lit(400) + event_id * 37 % 3700) / F.lit(100.0))
        .alias("latitude"),
        F.when(event_id % 41 == 0, F.lit(None).cast("double"))
        .when(approach, F.lit(100.0) + k * 12)
        .otherwise(F.lit(3000.0) + k * 90)
        .alias("baro_altitude"),
        F.when(event_id % 503 == 0, F.lit(600.0))
        .when(approach & (event_id % 40 == 0), F.lit(180.0))
        .when(approach, F.lit(55.0) + k % 60)
        .otherwise(F.lit(120.0) + event_id * 7 % 160)
        .alias("velocity"),
        (event_id * 17 % 360).cast("double").alias("true_track"),
        F.when(event_id % 211 == 0, F.lit("7700"))
        .otherwise(F.lpad((user_id % 8).cast("string"), 4, "0"))
        .alias("squawk"),
        F.explode(
            F.when(event_id % 20 == 0, F.array(F.lit(30), F.lit(90))).otherwise(F.array(F.lit(30)))
        ).alias("delay"),
        "seen",
    )
    countries = nation.select("n_nationkey", F.col("n_name").alias("origin_country"))
    return base.join(countries, "n_nationkey").select(
        "event_id",
        "icao24",
        "callsign",
        "origin_country",
        "time_position",
        "longitude",
        "latitude",
        "baro_altitude",
        "velocity",
        "true_track",
        "squawk",
        (F.col("seen") + F.make_dt_interval(secs=F.col("delay"))).alias("processed_at"),
    )


def raw_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    return positions_from_events(read_events(spark, sf_dir), nation)


def silver_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validated, dated, de-duplicated reports: the input of every mart."""
    return clean.to_silver(raw_positions(spark, sf_dir), AS_OF, tie_break=["event_id"])
