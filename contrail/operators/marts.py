"""Reporting aggregates over cleaned position reports.

Every group is built with partial aggregation before its shuffle. Windows without a
partition run only over finished per-country rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.functions.numeric import equal_width_bin, exact_mean, half_away, half_even, row_count
from contrail.operators import tracks
from contrail.operators.clean import filter_plausible_time, filter_since, filter_valid_coords


def _averages() -> list[Column]:
    return [F.avg("baro_altitude").alias("avg_altitude"), F.avg("velocity").alias("avg_velocity")]


def _timed(df: DataFrame) -> DataFrame:
    return df.filter(F.col("event_time").isNotNull())


def airline_prefix() -> Column:
    return F.substring("callsign", 1, 3)


def airline_code() -> Column:
    """Three leading capitals, else null."""
    return F.regexp_substr("callsign", F.lit("^[A-Z]{3}"))


# --- by date, hour and country ---------------------------------------------


def daily_country_counts(df: DataFrame) -> DataFrame:
    return (
        _timed(df).groupBy("partition_date", "origin_country").agg(row_count().alias("flight_count"), *_averages())
    )


def daily_summary(df: DataFrame, days: int = 7) -> DataFrame:
    """Newest days first; of a dated table no other dates are read. Rows are first reduced to
    (date, aircraft, country), so the two distinct counts expand that and not the raw reports."""
    recent = _timed(df).filter(F.col("partition_date").isin(newest_dates(_timed(df), days)))
    per_aircraft = recent.groupBy("partition_date", "icao24", "origin_country").agg(
        row_count().alias("n"),
        F.sum("baro_altitude").alias("alt_sum"),
        F.count("baro_altitude").alias("alt_n"),
        F.sum("velocity").alias("vel_sum"),
        F.count("velocity").alias("vel_n"),
    )
    return (
        per_aircraft.groupBy("partition_date")
        .agg(
            F.sum("n").alias("total_flights"),
            F.count_distinct("icao24").alias("unique_aircraft"),
            (F.sum("alt_sum") / F.nullif(F.sum("alt_n"), F.lit(0))).alias("avg_altitude"),
            (F.sum("vel_sum") / F.nullif(F.sum("vel_n"), F.lit(0))).alias("avg_velocity"),
            F.count_distinct("origin_country").alias("countries"),
        )
        .orderBy(F.desc("partition_date"))
        .limit(days)
    )


def country_share(df: DataFrame, top: int = 10) -> DataFrame:
    counts = _timed(df).groupBy("origin_country").agg(row_count().alias("flight_count"), *_averages())
    total = F.sum("flight_count").over(Window.partitionBy())
    return (
        counts.withColumn("percentage", half_away(F.col("flight_count") * 100.0 / total, 2))
        .orderBy(F.desc("flight_count"), "origin_country")
        .limit(top)
    )


def hourly_activity(df: DataFrame) -> DataFrame:
    return (
        _timed(df)
        .groupBy(F.hour("event_time").alias("hour_of_day"))
        .agg(row_count().alias("flight_count"), F.count_distinct("icao24").alias("unique_aircraft"))
    )


def hourly_activity_by_date(df: DataFrame) -> DataFrame:
    return (
        _timed(df)
        .groupBy("partition_date", F.hour("event_time").alias("hour_of_day"))
        .agg(row_count().alias("flight_count"), F.count_distinct("icao24").alias("unique_aircraft"))
    )


def country_stats(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("origin_country").isNotNull())
        .groupBy("origin_country")
        .agg(
            row_count().alias("total_flights"),
            F.count_distinct("icao24").alias("unique_aircraft"),
            *_averages(),
        )
    )


def country_table(df: DataFrame) -> DataFrame:
    """`country_stats` with whole-number averages, halves to even."""
    return country_stats(df).withColumns(
        {name: half_even(F.col(name)) for name in ("avg_altitude", "avg_velocity")}
    )


def top_countries(df: DataFrame, top: int = 15) -> DataFrame:
    return country_stats(df).orderBy(F.desc("total_flights"), "origin_country").limit(top)


def country_kpis(df: DataFrame) -> DataFrame:
    counts = df.filter(F.col("origin_country").isNotNull()).groupBy("origin_country").agg(row_count().alias("n"))
    first = F.min(F.struct((-F.col("n")).alias("n"), F.col("origin_country")))
    return counts.agg(F.count(F.lit(1)).alias("total_countries"), first.alias("first")).select(
        "total_countries",
        F.col("first.origin_country").alias("top_country"),
        (-F.col("first.n")).alias("top_country_flights"),
    )


def daily_trend(df: DataFrame, top: int = 5) -> DataFrame:
    """Per-day counts of the `top` countries, from one pass: a country's days (one entry
    per calendar day) travel with its total."""
    daily = (
        df.filter(F.col("origin_country").isNotNull())
        .groupBy("partition_date", "origin_country")
        .agg(row_count().alias("flights"))
    )
    return (
        daily.groupBy("origin_country")
        .agg(
            F.sum("flights").alias("total"),
            F.collect_list(F.struct("partition_date", "flights")).alias("days"),
        )
        .orderBy(F.desc("total"), "origin_country")
        .limit(top)
        .select("origin_country", F.inline("days"))
    )


def top_n_with_others(df: DataFrame, n: int = 10) -> DataFrame:
    """The `n` largest countries, and one row that adds up the rest if there are any."""
    rank = F.row_number().over(Window.partitionBy().orderBy(F.desc("total_flights"), "origin_country"))
    ranked = country_stats(df).withColumn("place", rank)
    kept = F.col("place") <= n
    label = F.when(kept, F.col("origin_country")).otherwise(F.lit("Others"))
    return (
        ranked.groupBy(F.least("place", F.lit(n + 1)).alias("place"), label.alias("origin_country"))
        .agg(
            F.sum("total_flights").alias("total_flights"),
            F.sum(F.when(kept, F.col("unique_aircraft")).otherwise(0)).alias("unique_aircraft"),
            F.sum(F.when(kept, F.col("avg_altitude")).otherwise(0.0)).alias("avg_altitude"),
            F.sum(F.when(kept, F.col("avg_velocity")).otherwise(0.0)).alias("avg_velocity"),
        )
        .drop("place")
    )


def newest_dates(df: DataFrame, days: int) -> list:
    """The last `days` dates that have reports: a short list, from the folders of a stored table."""
    dates = df.select("partition_date").filter(F.col("partition_date").isNotNull()).distinct()
    return [row[0] for row in dates.orderBy(F.desc("partition_date")).limit(days).collect()]


def country_totals_recent(df: DataFrame, days: int = 30, top: int = 10) -> DataFrame:
    """Reports of the newest `days` dates by country; of a dated table no other dates are read."""
    recent = _timed(df).filter(F.col("partition_date").isin(newest_dates(_timed(df), days)))
    return (
        recent.filter(F.col("origin_country").isNotNull())
        .groupBy("origin_country")
        .agg(row_count().alias("flight_count"))
        .orderBy(F.desc("flight_count"), "origin_country")
        .limit(top)
    )


# --- airlines --------------------------------------------------------------


def top_airlines(df: DataFrame, limit: int = 50, min_length: int = 3) -> DataFrame:
    """Carrier prefix by country with averages."""
    return (
        df.filter(F.col("callsign").isNotNull() & (F.length("callsign") >= min_length))
        .groupBy(airline_prefix().alias("airline_code"), "origin_country")
        .agg(row_count().alias("flight_count"), *_averages())
        .orderBy(F.desc("flight_count"), "airline_code", "origin_country")
        .limit(limit)
    )


def top_airline_counts(df: DataFrame, limit: int = 50) -> DataFrame:
    """The newer variant: any callsign, counts only."""
    return (
        df.filter(F.col("callsign").isNotNull())
        .groupBy(airline_prefix().alias("airline_code"), "origin_country")
        .agg(row_count().alias("flight_count"))
        .orderBy(F.desc("flight_count"), "airline_code", "origin_country")
        .limit(limit)
    )


def airline_report(df: DataFrame, limit: int = 15) -> DataFrame:
    """First rows of `top_airlines`, averages to two places."""
    return (
        top_airlines(df, limit)
        .withColumns({name: half_away(F.col(name), 2) for name in ("avg_altitude", "avg_velocity")})
    )


def dim_airlines(df: DataFrame) -> DataFrame:
    return (
        df.select(airline_code().alias("airline_id"))
        .filter(F.col("airline_id").isNotNull())
        .groupBy("airline_id")
        .agg(row_count().alias("total_historical_waypoints"))
    )


# --- whole-table figures ---------------------------------------------------


def altitude_velocity_stats(df: DataFrame) -> DataFrame:
    both = df.filter(F.col("baro_altitude").isNotNull() & F.col("velocity").isNotNull())
    return both.agg(
        *[
            half_away(fn(column), 2).alias(f"{name}_{label}")
            for column, label in (("baro_altitude", "altitude"), ("velocity", "velocity"))
            for name, fn in (("min", F.min), ("max", F.max), ("avg", F.avg))
        ]
    )


def live_aircraft_count(
    df: DataFrame, as_of: str, minutes: int = 15, approximate: bool = False
) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return filter_since(df, as_of, minutes).agg(count("icao24").alias("unique_count"))


def airspace_stats(df: DataFrame) -> DataFrame:
    return filter_valid_coords(df).agg(
        row_count().alias("total_positions"),
        F.min("latitude").alias("min_latitude"),
        F.max("latitude").alias("max_latitude"),
        F.min("longitude").alias("min_longitude"),
        F.max("longitude").alias("max_longitude"),
        F.avg("baro_altitude").alias("avg_altitude"),
    )


def _overview(df: DataFrame, latest: DataFrame, first: list[Column], kept: list[str]) -> DataFrame:
    """`first`, then the figures that both overviews share; one row."""
    callsigns = df.filter(F.length("callsign") >= 3)
    airlines = callsigns.agg(F.count_distinct(airline_prefix()))
    newest = _timed(df).filter(F.col("partition_date").isin(newest_dates(_timed(df), 1)))
    by_country = newest.groupBy("origin_country").agg(row_count().alias("n"))
    leader = by_country.orderBy(F.desc("n"), "origin_country").limit(1).select("origin_country")
    return latest.agg(*first, *_averages()).select(
        *kept,
        airlines.scalar().alias("active_airlines"),
        "avg_velocity",
        "avg_altitude",
        leader.scalar().alias("top_country"),
    )


def overview_kpis(df: DataFrame, as_of: str, minutes: int = 15) -> DataFrame:
    """Headline figures of the live overview, one row; airlines are those of all reports."""
    live = live_aircraft_count(df, as_of, minutes).scalar().alias("live_aircraft")
    return _overview(df, tracks.latest_positions(df, as_of, minutes), [], [live])


def overview_kpis_on(df: DataFrame, date: str) -> DataFrame:
    """The same figures for one day: its aircraft instead of the live ones."""
    aircraft = row_count().alias("unique_aircraft")
    return _overview(df, tracks.latest_positions_on(df, date), [aircraft], ["unique_aircraft"])


# --- histograms ------------------------------------------------------------


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Counts of equal-width, right-closed bins over the column's range; empty bins kept."""
    values = df.select(F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull())
    low, high = values.agg(F.min("v")).scalar(), values.agg(F.max("v")).scalar()
    ranged = values.select("v", low.alias("low"), high.alias("high"))
    counts = (
        ranged.withColumn("bin", equal_width_bin(F.col("v"), F.col("low"), F.col("high"), bins))
        .groupBy("bin", "low", "high")
        .agg(row_count().alias("n"))
    )
    # At most `bins` rows: spread them over every bin number, then add up.
    width = (F.col("high") - F.col("low")) / bins
    dense = counts.select(
        F.explode(F.sequence(F.lit(1), F.when(F.col("low") < F.col("high"), bins).otherwise(1))).alias(
            "slot"
        ),
        "bin",
        "n",
        "low",
        width.alias("width"),
    )
    return dense.groupBy(F.col("slot").alias("bin")).agg(
        F.max(F.col("low") + (F.col("slot") - 1) * F.col("width")).alias("bin_low"),
        F.max(F.col("low") + F.col("slot") * F.col("width")).alias("bin_high"),
        F.sum(F.when(F.col("bin") == F.col("slot"), F.col("n")).otherwise(0)).alias("count"),
    )


def altitude_histogram(df: DataFrame, as_of: str, minutes: int = 15, bins: int = 10) -> DataFrame:
    """Altitudes of the latest position of each aircraft."""
    return histogram(tracks.latest_positions(df, as_of, minutes), "baro_altitude", bins)


# --- per aircraft ----------------------------------------------------------


def aircraft_activity(df: DataFrame, min_points: int = 2, limit: int = 200) -> DataFrame:
    return (
        filter_valid_coords(df)
        .groupBy("icao24")
        .agg(
            F.max("callsign").alias("callsign"),
            F.max("origin_country").alias("origin_country"),
            row_count().alias("data_points"),
            F.min("event_time").alias("first_seen"),
            F.max("event_time").alias("last_seen"),
        )
        .filter(F.col("data_points") >= min_points)
        .orderBy(F.desc("data_points"), "icao24")
        .limit(limit)
    )


def flight_durations(df: DataFrame) -> DataFrame:
    """Time between the first and last report of each aircraft, if there is any."""

    def first_known(column: str) -> Column:
        known = F.when(F.col(column).isNotNull(), F.col("time_position"))
        return F.min_by(column, known).alias(column)

    return (
        filter_plausible_time(filter_valid_coords(df))
        .groupBy("icao24")
        .agg(
            first_known("callsign"),
            first_known("origin_country"),
            F.min("event_time").alias("first_seen"),
            F.max("event_time").alias("last_seen"),
            row_count().alias("data_points"),
            *_averages(),
            (F.max("time_position") - F.min("time_position")).alias("duration_seconds"),
        )
        .filter(F.col("duration_seconds") > 0)
        .withColumn("duration_minutes", F.col("duration_seconds") / 60)
    )


def duration_kpis(df: DataFrame) -> DataFrame:
    """Seconds are added up as whole numbers, so the mean does not depend on row order."""
    return flight_durations(df).agg(
        row_count().alias("total_aircraft"),
        (F.sum("duration_seconds") / (row_count() * 60)).alias("avg_minutes"),
        F.max("duration_minutes").alias("max_minutes"),
        F.min("duration_minutes").alias("min_minutes"),
    )


def duration_histogram(df: DataFrame, bins: int = 20) -> DataFrame:
    return histogram(flight_durations(df), "duration_minutes", bins)


def longest_flights(df: DataFrame, top: int = 10) -> DataFrame:
    return (
        flight_durations(df)
        .orderBy(F.desc("duration_seconds"), "icao24")
        .limit(top)
        .select(
            "icao24",
            "callsign",
            "origin_country",
            half_even(F.col("duration_minutes"), 1).alias("duration_minutes"),
            "data_points",
            half_even(F.col("avg_altitude")).alias("avg_altitude"),
            half_even(F.col("avg_velocity")).alias("avg_velocity"),
        )
    )


def path_summary(df: DataFrame, icao24: str | None = None) -> DataFrame:
    """Heading of the trail page, for one aircraft or for each."""
    rows = filter_valid_coords(df)
    if icao24 is not None:
        rows = rows.filter(F.col("icao24") == icao24)
    return rows.groupBy("icao24").agg(
        F.min_by("callsign", "time_position").alias("callsign"),
        F.max("baro_altitude").alias("max_altitude"),
        F.avg("velocity").alias("avg_speed"),
        row_count().alias("track_points"),
        exact_mean("latitude").alias("centre_latitude"),
        exact_mean("longitude").alias("centre_longitude"),
    )


def points_per_aircraft(df: DataFrame, min_points: int = 2) -> DataFrame:
    """Aircraft choices of the 3D page, labelled with their first known callsign."""
    known = F.when(F.col("callsign").isNotNull(), F.col("time_position"))
    return (
        df.groupBy("icao24")
        .agg(row_count().alias("points"), F.min_by("callsign", known).alias("callsign"))
        .filter(F.col("points") >= min_points)
        .withColumn(
            "label",
            F.concat(
                F.coalesce("callsign", F.lit("Unknown")),
                F.lit(" ("),
                F.col("icao24"),
                F.lit(") - "),
                F.col("points").cast("string"),
                F.lit(" pts"),
            ),
        )
    )
