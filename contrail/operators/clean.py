"""Projections, filters and cleaning of position reports."""

from __future__ import annotations

from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail import schema as S


# Fixed value: an aircraft address; \z, because $ also matches before a last line end.
ADDRESS = r"\A[0-9a-fA-F]{6}\z"


class SchemaDrift(ValueError):
    """A required column is missing or has the wrong type."""


class BatchRejected(ValueError):
    """A strict batch held no row, or a row that breaks a rule."""


# --- coordinates and boxes -------------------------------------------------


def filter_valid_coords(df: DataFrame) -> DataFrame:
    """Keep rows with both coordinates; zero counts as a coordinate."""
    return df.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())


def filter_bbox(df: DataFrame, box: tuple[float, float, float, float] = S.COUNTRY_BOX) -> DataFrame:
    """Inclusive box; a null or zero coordinate is outside."""
    lat, lon = F.col("latitude"), F.col("longitude")
    return df.filter(
        lat.between(box[0], box[1]) & lon.between(box[2], box[3]) & (lat != 0) & (lon != 0)
    )


def filter_min_fields(df: DataFrame, states: str = "state", n: int = S.MIN_STATE_FIELDS) -> DataFrame:
    """Drop state arrays too short to hold a report."""
    return df.filter(F.size(states) >= n)


# --- validation ------------------------------------------------------------


def epoch_seconds(as_of: str | Column) -> int | Column:
    """Epoch seconds of a time written in UTC, or of a row's own time."""
    if isinstance(as_of, Column):
        return F.unix_timestamp(as_of)
    return int(datetime.fromisoformat(as_of).replace(tzinfo=UTC).timestamp())


def failures(as_of: str | Column) -> dict[str, Column]:
    """One never-null condition per rule, true where the rule is broken.

    `as_of` is the time that reports are judged at. A feed that runs on gives a column, such as
    the time when each report came in, so that its clock goes on too.
    """
    now = epoch_seconds(as_of)
    time = F.col("time_position")

    def broken(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False))

    return {
        "icao24": ~F.coalesce(F.col("icao24").rlike(ADDRESS), F.lit(False)),
        "origin_country": F.col("origin_country").isNull(),
        "time_missing": time.isNull() | broken(time <= 0),
        "time_future": broken(time > now + S.FUTURE_SECONDS),
        "time_old": broken((time > 0) & (time < now - S.PAST_SECONDS)),
        "longitude": ~F.coalesce(F.col("longitude").between(-180, 180), F.lit(False)),
        "latitude": ~F.coalesce(F.col("latitude").between(-90, 90), F.lit(False)),
        "altitude_negative": broken(F.col("baro_altitude") < 0),
        "velocity_negative": broken(F.col("velocity") < 0),
        "velocity_excess": broken(F.col("velocity") > S.MAX_VELOCITY),
    }


def with_reasons(df: DataFrame, as_of: str | Column) -> DataFrame:
    """Add `reasons`, the names of all rules a row breaks."""
    flags = [F.when(bad, F.lit(name)) for name, bad in failures(as_of).items()]
    return df.withColumn("reasons", F.array_compact(F.array(*flags)))


def passes(as_of: str | Column) -> Column:
    """True where no rule is broken, as plain comparisons that reach the scan."""
    now = epoch_seconds(as_of)
    rules = [
        F.col("icao24").rlike(ADDRESS),
        F.col("origin_country").isNotNull(),
        F.col("time_position") > 0,
        F.col("time_position") >= now - S.PAST_SECONDS,
        F.col("time_position") <= now + S.FUTURE_SECONDS,
        F.col("longitude").between(-180, 180),
        F.col("latitude").between(-90, 90),
        F.col("baro_altitude").isNull() | (F.col("baro_altitude") >= 0),
        F.col("velocity").isNull() | F.col("velocity").between(0, S.MAX_VELOCITY),
    ]
    return reduce(lambda left, right: left & right, rules)


def validate(df: DataFrame, as_of: str | Column) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with `reasons`)."""
    return df.filter(passes(as_of)), with_reasons(df, as_of).filter(F.size("reasons") > 0)


def validate_strict(df: DataFrame, as_of: str) -> DataFrame:
    """The frame unchanged, or an error if it is empty or any row is bad."""
    rows, bad = (
        with_reasons(df, as_of)
        .agg(F.count(F.lit(1)), F.coalesce(F.sum((F.size("reasons") > 0).cast("long")), F.lit(0)))
        .first()
    )
    if rows == 0:
        raise BatchRejected("batch holds no rows")
    if bad:
        raise BatchRejected(f"{bad} of {rows} rows break a rule")
    return df


def reject_counts(df: DataFrame, as_of: str) -> DataFrame:
    """Rows rejected per reason; a row counts once for each rule it breaks."""
    return (
        with_reasons(df, as_of)
        .select(F.explode("reasons").alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


# --- shaping ---------------------------------------------------------------


def normalise(df: DataFrame) -> DataFrame:
    """Lower-case address, trimmed callsign, blank callsign to null."""
    return df.withColumns(
        {
            "icao24": F.lower("icao24"),
            "callsign": F.nullif(F.trim("callsign"), F.lit("")),
        }
    )


def coerce_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the named columns; text that is no number becomes null."""
    return df.withColumns(
        {name: F.col(name).try_cast(kind) for name, kind in types.items() if name in df.columns}
    )


def conform(df: DataFrame, schema: T.StructType = S.MESSAGE) -> DataFrame:
    """Exactly the schema's columns: absent ones null, unknown ones dropped."""
    have = {name.lower(): name for name in df.columns}
    return df.select(
        *[
            (F.col(have[field.name.lower()]) if field.name.lower() in have else F.lit(None))
            .cast(field.dataType)
            .alias(field.name)
            for field in schema
        ]
    )


def check_schema(df: DataFrame, required: T.StructType | None = None) -> DataFrame:
    """The frame unchanged, or an error that lists every difference."""
    if required is None:
        required = T.StructType([field for field in S.MESSAGE if field.name in S.REQUIRED])
    actual = {field.name: field.dataType for field in df.schema}
    problems = [
        f"{field.name}: missing"
        if field.name not in actual
        else f"{field.name}: {actual[field.name].simpleString()}, expected {field.dataType.simpleString()}"
        for field in required
        if actual.get(field.name) != field.dataType
    ]
    if problems:
        raise SchemaDrift("; ".join(problems))
    return df


def to_event_time(df: DataFrame, source: str = "time_position", target: str = "event_time") -> DataFrame:
    """Timestamp from epoch seconds, a timestamp or text; what cannot be read is null."""
    kind = df.schema[source].dataType
    column = F.col(source)
    if isinstance(kind, T.StringType):
        epoch = F.timestamp_seconds(column.try_cast("bigint"))
        stamp = F.coalesce(epoch, column.try_cast("timestamp"))
    elif isinstance(kind, T.NumericType):
        stamp = F.timestamp_seconds(column)
    else:
        stamp = column.cast("timestamp")
    return df.withColumn(target, stamp)


def with_partition_date(df: DataFrame, source: str = "event_time") -> DataFrame:
    return df.withColumn("partition_date", F.to_date(source))


def partition_date_text(df: DataFrame, source: str, target: str = "partition_date") -> DataFrame:
    """`YYYY-MM-DD` from a date, a timestamp, or epoch milliseconds."""
    column = F.col(source)
    if isinstance(df.schema[source].dataType, T.NumericType):
        column = F.timestamp_millis(column.cast("long"))
    return df.withColumn(target, F.date_format(column, "yyyy-MM-dd"))


def with_processed_at(df: DataFrame, as_of: str) -> DataFrame:
    return df.withColumn("processed_at", F.lit(as_of).cast("timestamp"))


def dedupe(
    df: DataFrame,
    keys: tuple[str, ...] = ("icao24", "time_position"),
    latest: str = "processed_at",
    tie_break: list[str] | None = None,
) -> DataFrame:
    """One row per key, the last processed.

    `row_number() = 1` is cut to one row per key before the shuffle as well as after
    it, so a key repeated very often moves one row per input split.
    """
    ties = [F.col(name).desc() for name in tie_break] if tie_break else [F.xxhash64(*df.columns)]
    order = Window.partitionBy(*keys).orderBy(F.col(latest).desc(), *ties)
    return df.withColumn("_copy", F.row_number().over(order)).filter("_copy = 1").drop("_copy")


def to_silver(raw: DataFrame, as_of: str | Column, tie_break: list[str] | None = None) -> DataFrame:
    """Normalise, validate, date and de-duplicate raw reports."""
    valid = normalise(raw).filter(passes(as_of))
    return with_partition_date(to_event_time(dedupe(valid, tie_break=tie_break)))


def route_dead_letters(
    df: DataFrame, as_of: str | Column, value: str = "value", schema: T.StructType = S.MESSAGE
) -> tuple[DataFrame, DataFrame]:
    """(parsed messages stamped with `processed_at`, unreadable messages with an error)."""
    corrupt = "_corrupt"
    parsed = F.from_json(
        F.col(value),
        T.StructType(schema.fields + [T.StructField(corrupt, T.StringType())]),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt},
    )
    stamp = (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("timestamp").alias("processed_at")
    split = df.select(F.col(value).alias("_text"), parsed.alias("_row"), stamp)
    bad = F.col("_row").isNull() | F.col(f"_row.{corrupt}").isNotNull()
    good = split.filter(~bad).select("_row.*", "processed_at").drop(corrupt)
    dead = split.filter(bad).select(
        F.lit("Invalid JSON").alias("error"), F.col("_text").alias("original_message"), "processed_at"
    )
    return good, dead


# --- selections ------------------------------------------------------------


def filter_plausible_time(df: DataFrame, column: str = "event_time") -> DataFrame:
    """Drop missing times and years up to 2000."""
    return df.filter(F.col(column) >= F.lit("2001-01-01 00:00:00").cast("timestamp"))


def stg_positions(df: DataFrame) -> DataFrame:
    """Staging projection: the reporting columns under lower-case names."""
    have = {name.lower(): name for name in df.columns}
    return df.select(*[F.col(have[name]).alias(name) for name in S.GOLD_COLUMNS])


def filter_since(df: DataFrame, as_of: str, minutes: int, column: str = "event_time") -> DataFrame:
    """Rows later than `minutes` before `as_of`; on a dated table older dates are not read."""
    start = F.lit(as_of).cast("timestamp") - F.make_dt_interval(mins=F.lit(minutes))
    if column == "event_time" and "partition_date" in df.columns:
        df = df.filter(F.col("partition_date") >= start.cast("date"))
    return df.filter(F.col(column) > start)


def filter_view(
    df: DataFrame, country: str = "All", min_altitude: float = 0.0, max_points: int | None = None
) -> DataFrame:
    """Airborne reports behind the 3D view, all that pass the filters.

    `max_points` limits what is displayed: the earliest reports of those.
    """
    airborne = filter_valid_coords(df).filter((F.col("baro_altitude") > 0) & (F.col("baro_altitude") >= min_altitude))
    if country != "All":
        airborne = airborne.filter(F.col("origin_country") == country)
    if max_points is None:
        return airborne
    return airborne.orderBy("time_position", "icao24").limit(max_points)


def search_callsign(df: DataFrame, term: str) -> DataFrame:
    """Callsigns that contain the upper-cased term; an empty term keeps every row."""
    if not term:
        return df
    return df.filter(F.contains(F.col("callsign"), F.upper(F.lit(term))))


def country_options(df: DataFrame) -> DataFrame:
    known = df.select("origin_country").filter(F.col("origin_country").isNotNull())
    return known.distinct().orderBy("origin_country")
