"""Latest positions, motion changes, anomalies and paths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.operators.clean import filter_plausible_time, filter_since, filter_valid_coords
from contrail.plans.pieces import with_previous

# Anomaly limits in metres and metres per second.
ALTITUDE_JUMP = 2000
SPEED_JUMP = 100
LOW_ALTITUDE = 500
LOW_ALTITUDE_SPEED = 150

# Fixed value: stands for a null part of a surrogate key.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"

TREND_METRES = 10
TRAIL_POINTS = 10


def _newest(df: DataFrame, n: int = 1) -> DataFrame:
    """The last `n` reports per aircraft; cut per input split before the shuffle."""
    order = Window.partitionBy("icao24").orderBy(F.desc("time_position"))
    return df.withColumn("_age", F.row_number().over(order)).filter(F.col("_age") <= n)


def latest_positions(df: DataFrame, as_of: str, minutes: int = 15) -> DataFrame:
    """Last report per aircraft in the time range; dropped if that report has no place."""
    return filter_valid_coords(_newest(filter_since(df, as_of, minutes)).drop("_age"))


def latest_positions_on(df: DataFrame, date: str) -> DataFrame:
    day = df.filter(F.col("partition_date") == F.lit(date).cast("date"))
    return filter_valid_coords(_newest(day).drop("_age"))


def dim_aircraft(df: DataFrame) -> DataFrame:
    """Last date and country of each aircraft; on a tie the country first in the alphabet."""
    seen = df.groupBy("icao24", "origin_country").agg(F.max("partition_date").alias("last_seen_date"))
    order = Window.partitionBy("icao24").orderBy(F.desc("last_seen_date"), "origin_country")
    return (
        seen.withColumn("rn", F.row_number().over(order))
        .filter("rn = 1")
        .select(F.col("icao24").alias("aircraft_id"), "origin_country", "last_seen_date")
    )


def surrogate_key(*parts: Column) -> Column:
    """md5 over the parts as text, joined by a dash."""
    return F.md5(F.concat_ws("-", *[F.coalesce(part.cast("string"), F.lit(NULL_KEY_PART)) for part in parts]))


def fact_positions(df: DataFrame) -> DataFrame:
    return df.filter(F.col("event_time").isNotNull()).select(
        surrogate_key(F.col("icao24"), F.date_format("event_time", "yyyy-MM-dd HH:mm:ss")).alias(
            "position_id"
        ),
        F.col("icao24").alias("aircraft_id"),
        F.regexp_substr("callsign", F.lit("^[A-Z]{3}")).alias("airline_id"),
        "callsign",
        "event_time",
        "latitude",
        "longitude",
        "baro_altitude",
        "velocity",
        "processed_at",
        "partition_date",
    )


# --- motion ----------------------------------------------------------------


def _needed(df: DataFrame, needed: Sequence[str], keep: Sequence[str] | None) -> DataFrame:
    """The aircraft, its day and time, `needed` and `keep`, in the order of `df`; all columns if `keep` is None."""
    if keep is None:
        return df
    names = {"icao24", "partition_date", "time_position", *needed, *keep}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c in names])


def motion_deltas(df: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """Absolute altitude and speed change and seconds since the aircraft's previous report.

    Of other columns, `keep` goes along (all, if None). Who names those that are used has `df` read once.
    """
    rows = _needed(filter_plausible_time(filter_valid_coords(df)), ["baro_altitude", "velocity"], keep)
    linked = with_previous(
        rows, ["baro_altitude", "velocity", "time_position"], totals={"reports": F.count(F.lit(1))}
    )
    return linked.withColumns(
        {
            "alt_change": F.abs(F.col("baro_altitude") - F.col("prev_baro_altitude")),
            "speed_change": F.abs(F.col("velocity") - F.col("prev_velocity")),
            "time_diff": F.col("time_position") - F.col("prev_time_position"),
        }
    ).drop("prev_baro_altitude", "prev_velocity", "prev_time_position")


def detect_anomalies(df: DataFrame) -> DataFrame:
    """One row per rule a report breaks; aircraft with a single report are skipped."""
    return _anomalies(df, ["callsign", "latitude", "longitude", "event_time"]).select(
        "icao24",
        "callsign",
        "anomaly_type",
        "detail",
        "baro_altitude",
        "velocity",
        "latitude",
        "longitude",
        "event_time",
    )


def _anomalies(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The findings with the columns that they rest on and `keep`."""

    def finding(kind: str, detail: Column) -> Column:
        return F.struct(F.lit(kind).alias("anomaly_type"), detail.alias("detail"))

    def whole(column: str) -> Column:
        return F.bround(column).cast("long").cast("string")

    rules = [
        F.when(
            F.col("alt_change") > ALTITUDE_JUMP,
            finding("Sudden Altitude Change", F.concat(whole("alt_change"), F.lit(" m"))),
        ),
        F.when(
            F.col("speed_change") > SPEED_JUMP,
            finding("Speed Anomaly", F.concat(whole("speed_change"), F.lit(" m/s"))),
        ),
        F.when(
            (F.col("baro_altitude") < LOW_ALTITUDE) & (F.col("velocity") > LOW_ALTITUDE_SPEED),
            finding(
                "Low-Alt High-Speed",
                F.concat(whole("baro_altitude"), F.lit(" m @ "), whole("velocity"), F.lit(" m/s")),
            ),
        ),
    ]
    return (
        motion_deltas(df, keep)
        .filter(F.col("reports") >= 2)
        .select("icao24", "baro_altitude", "velocity", *keep, F.inline(F.array_compact(F.array(*rules))))
    )


def anomaly_counts(df: DataFrame) -> DataFrame:
    """One row: all anomalies, each type, and the two figures the page shows. The page's
    speed figure also counts the low and fast type, whose name holds the word."""
    kinds = {
        "altitude_changes": "Sudden Altitude Change",
        "speed_changes": "Speed Anomaly",
        "low_fast": "Low-Alt High-Speed",
    }
    counted = _anomalies(df, []).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("anomaly_type") == kind).alias(name) for name, kind in kinds.items()],
    )
    return counted.select(
        "*",
        F.col("altitude_changes").alias("shown_altitude"),
        (F.col("speed_changes") + F.col("low_fast")).alias("shown_speed"),
    )


def altitude_trend(
    df: DataFrame, threshold: float = TREND_METRES, keep: Sequence[str] | None = None
) -> DataFrame:
    """`up`, `down` or `=` against the aircraft's previous report; `=` if either is unknown.

    `keep` as in `motion_deltas`.
    """
    linked = with_previous(_needed(df, ["baro_altitude"], keep), ["baro_altitude"])
    now, before = F.col("baro_altitude"), F.col("prev_baro_altitude")
    trend = (
        F.when(now > before + threshold, F.lit("up"))
        .when(now < before - threshold, F.lit("down"))
        .otherwise(F.lit("="))
    )
    return linked.withColumn("trend", trend).drop("prev_baro_altitude", "has_prev")


def recent_trail(df: DataFrame, n: int = TRAIL_POINTS) -> DataFrame:
    """The last `n` points of each aircraft, oldest first."""
    point = F.struct("time_position", "latitude", "longitude")
    return (
        _newest(filter_valid_coords(df), n)
        .groupBy("icao24")
        .agg(F.sort_array(F.collect_list(point)).alias("trail"))
    )


# --- paths -----------------------------------------------------------------


def flight_path(df: DataFrame, icao24: str) -> DataFrame:
    """All placed reports of one aircraft in time order."""
    return all_positions(df.filter(F.col("icao24") == icao24))


def all_positions(df: DataFrame) -> DataFrame:
    return filter_valid_coords(df).orderBy("time_position", "icao24")


def paths_of(df: DataFrame, aircraft: DataFrame) -> DataFrame:
    """Placed reports of the aircraft listed in `aircraft` (a short list)."""
    return filter_valid_coords(df).join(aircraft.select("icao24"), "icao24", "left_semi")


def _segments(df: DataFrame, tops: dict[str, str] | None = None) -> DataFrame:
    placed = filter_valid_coords(df).select(
        "icao24",
        "time_position",
        "partition_date",
        "longitude",
        "latitude",
        F.coalesce("baro_altitude", F.lit(0.0)).alias("altitude"),
    )
    return with_previous(placed, ["longitude", "latitude"], tops=tops).filter("has_prev").select(
        "icao24",
        "time_position",
        "partition_date",
        F.col("prev_longitude").alias("source_lng"),
        F.col("prev_latitude").alias("source_lat"),
        F.col("longitude").alias("target_lng"),
        F.col("latitude").alias("target_lat"),
        "altitude",
        *(tops or {}),
    )


def path_segments(df: DataFrame) -> DataFrame:
    """Lines between consecutive placed reports; altitude of the later one, 0 if unknown."""
    return _segments(df)


def segment_colours(df: DataFrame) -> DataFrame:
    """Segments coloured from green (low) to red (the aircraft's highest)."""
    segments = _segments(df, {"max_altitude": "altitude"})
    share = F.col("altitude") / F.greatest("max_altitude", F.lit(1.0))

    def channel(value: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.lit(255), value.cast("int")))

    return segments.withColumns(
        {"r": channel(share * 255), "g": channel(F.lit(255) - share * 200), "b": F.lit(80)}
    )


def path_arrays(df: DataFrame) -> DataFrame:
    """Ordered [longitude, latitude] lists, one per aircraft and day.

    A day bounds a list at 86,400 points; the lists of an aircraft in date order are its path.
    """
    keys = ["icao24", "partition_date"]
    point = F.struct("time_position", "longitude", "latitude")
    ordered = F.sort_array(F.collect_list(point))
    return (
        filter_valid_coords(df)
        .groupBy(*keys)
        .agg(ordered.alias("points"))
        .select(
            *keys,
            F.transform("points", lambda p: F.array(p["longitude"], p["latitude"])).alias("path"),
        )
    )


def path_endpoints(df: DataFrame) -> DataFrame:
    """START and END marker of each aircraft."""
    bounds = (
        filter_valid_coords(df)
        .groupBy("icao24")
        .agg(
            *[
                pick(column, "time_position").alias(f"{label}_{column}")
                for label, pick in (("start", F.min_by), ("end", F.max_by))
                for column in ("longitude", "latitude")
            ]
        )
    )
    return bounds.select(
        "icao24",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(label.upper()).alias("label"),
                        F.col(f"{label}_longitude").alias("longitude"),
                        F.col(f"{label}_latitude").alias("latitude"),
                    )
                    for label in ("start", "end")
                ]
            )
        ),
    )


def profile(df: DataFrame, measure: str) -> DataFrame:
    """A measure over time per aircraft, unknown values dropped; in no order, which a page
    gives the aircraft that it shows."""
    known = df.filter(F.col("event_time").isNotNull() & F.col(measure).isNotNull())
    return known.select("icao24", "event_time", measure)


def altitude_velocity_pairs(df: DataFrame) -> DataFrame:
    known = df.filter(F.col("velocity").isNotNull() & F.col("baro_altitude").isNotNull())
    return known.select("icao24", "callsign", "origin_country", "velocity", "baro_altitude")
