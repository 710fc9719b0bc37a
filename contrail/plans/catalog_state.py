"""Queries over kept state: versions, ledger, arrival index, rollup, clustered files, places, figures per batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail import schema as S
from contrail.operators import clean, geo, rollup
from contrail.plans.base_sql import BASE, distance, half_away, stamp
from contrail.plans.catalog_clean import SILVER
from contrail.plans.catalog_tables import ALL_SILVER, FIRST, PARTS, _arrival, _arriving, _shown, _to_parquet
from contrail.plans.catalog_tracks import PATH_SQL, PLACED
from contrail.plans.registry import SQL, Inputs, query
from contrail.schema import RADAR_CENTRE
from contrail.session import scratch
from contrail.sinks import tables
from contrail.streaming import arrivals, bronze, dedupe, live, metrics, silver

# --- live tracks that ended ---------------------------------------------------

# Silence that ends a track here, and how far the watermark stays behind, in seconds.
SILENCE, LATENESS = 6 * 3600, 5


@query("live_expired", BASE + f"""
  , dated as (
    select *, least((extract(day from event_time)::bigint - 1) // 10, 2) as part,
      coalesce(time_position - lag(time_position) over w > {SILENCE}, true) as broke,
      lag(baro_altitude) over w as before from kept where {PLACED} window w as (partition by icao24 order by time_position)),
  runs as (select *, sum(broke::int) over (partition by icao24 order by time_position) as run from dated),
  parts as (select unnest(range({PARTS - 1})) as p),
  marks as (select p, max(time_position) - {LATENESS} as mark from parts join dated on part <= p group by p),
  lasts as (select p, icao24, max(time_position) as last from parts join dated on part <= p group by p, icao24),
  ended as (select icao24, last from lasts join marks using (p) where last + {SILENCE} <= mark group by icao24, last),
  tracks as (
    select runs.*, row_number() over (partition by runs.icao24, last order by time_position desc) as age, last
    from ended join runs using (icao24) where time_position <= last
    qualify run = max(run) over (partition by runs.icao24, last))
  select icao24, last as time_position, arg_min_null(callsign, age) as callsign,
    arg_min_null(baro_altitude, age) as baro_altitude, arg_min_null(squawk, age) as squawk,
    arg_min_null(true_track, age) as true_track, arg_min_null(origin_country, age) as origin_country,
    arg_min_null(case when broke then '=' when baro_altitude > before + 10 then 'up'
                      when baro_altitude < before - 10 then 'down' else '=' end, age) as trend,
    {half_away(f"arg_min_null({distance('latitude', 'longitude', str(RADAR_CENTRE[0]), str(RADAR_CENTRE[1]))}, age)", 6)}
      as distance_km,
    ({PATH_SQL.replace(" order by time_position)", " order by time_position) filter (age <= 10)")}) as trail
  from tracks group by icao24, last""")
def _(p: Inputs):
    """Reports arrive in order, ten days at a time; after each part the tracks end that have been silent for six hours."""
    fed = clean.to_event_time(clean.dedupe(clean.validate(clean.normalise(p.raw), p.as_of)[0], tie_break=["event_id"]))
    # Judged by the report's time alone, so that none is late.
    fed = fed.withColumn("processed_at", F.timestamp_seconds("time_position"))
    rows = _to_parquet(p, fed, lambda stream: live.track_live(stream, f"{LATENESS} seconds", SILENCE), "ended")
    return _shown(live.expired(rows))


# --- side outputs ------------------------------------------------------------

_SIDES = f"event_id, icao24, time_position, {stamp('processed_at')}"


@query("silver_stream_restarted", FIRST + f"""
  select 'silver' as side, {_SIDES} from kept union all select 'reject', {_SIDES} from flagged where bad""")
def _(p: Inputs):
    """A batch fails between its two tables and runs again, another runs twice, and a new checkpoint takes all once more."""
    path, rejects, offsets = (scratch(p.spark, name) for name in ("ledger-silver", "ledger-rejects", "ledger-offsets"))
    clock, ties = F.col("processed_at"), ["event_id"]
    first = p.raw.filter(_arrival() == 0)
    silver.add_kept(first, path, clock, ties, "an attempt that failed")

    def advance(stream: DataFrame):
        return silver.silver_stream(stream, path, offsets, tie_break=ties, rejects=rejects)

    folder = _arriving(p, p.raw, advance)
    silver.add_batch(first, path, clock, ties, rejects, silver.writer_of(offsets), 0)
    again = p.spark.readStream.schema(p.raw.schema).option("recursiveFileLookup", "true").parquet(folder)
    silver.silver_stream(again, path, scratch(p.spark, "ledger-other"), tie_break=ties, rejects=rejects).awaitTermination()
    columns = ["event_id", "icao24", "time_position", "processed_at"]
    kept = silver.read_silver(p.spark, path).select(F.lit("silver").alias("side"), *columns)
    return kept.union(silver.read_rejects(p.spark, rejects, path).select(F.lit("reject"), *columns))


# --- replay by the arrival index ----------------------------------------------

DAYS = ["2024-01-10", "2024-01-11"]
_LATE = "epoch(processed_at)::bigint - time_position >= 60"


@query("replay_landed", BASE + f"""
  select {SILVER} from (
    select * replace (case when cast(partition_date as varchar) in ('{DAYS[0]}', '{DAYS[1]}') and {_LATE}
                           then processed_at + interval 10 day else processed_at end as processed_at) from kept)""")
def _(p: Inputs):
    """Two wrong days are put right from landed messages, of which repeats came ten days late."""
    folder, landed, path = (scratch(p.spark, name) for name in ("sent", "landed-late", "replayed-late"))
    late = F.unix_timestamp("processed_at") - F.col("time_position") >= 60
    whole = F.to_json(F.struct("event_id", *S.MESSAGE.fieldNames()), {"ignoreNullFields": "false"})
    sent = p.raw.select(
        whole.alias("value"),
        F.lit("test").alias("origin"),
        F.col("event_id").alias("position"),
        F.when(late, F.col("processed_at") + F.expr("interval 10 days")).otherwise(F.col("processed_at")).alias("landed_at"),
    )
    sent.write.parquet(folder)
    messages = p.spark.readStream.schema(sent.schema).parquet(folder)
    bronze.land(messages, landed, scratch(p.spark, "late-offsets"), interval=None).awaitTermination()
    wrong = F.when(F.col("partition_date").isin(*[F.lit(d).cast("date") for d in DAYS]), F.lit(-1.0))
    tables.write_silver(p.silver.withColumn("velocity", F.coalesce(wrong, F.col("velocity"))), path)
    numbered = T.StructType([T.StructField("event_id", T.LongType()), *S.MESSAGE.fields])
    arrivals.replay_landed(p.spark, landed, path, DAYS, p.as_of, ["event_id"], numbered)
    return p.spark.read.parquet(path).select(*ALL_SILVER)


# --- counts from stored bitmaps -------------------------------------------------


def _rollup(p: Inputs) -> DataFrame:
    path = scratch(p.spark, "rollup")
    rollup.write_rollup(p.silver, path)
    return p.spark.read.parquet(path)


@query("rollup_daily_summary", SQL["daily_summary"])
def _(p: Inputs):
    return rollup.summary_by_day(_rollup(p))


@query("rollup_country_stats", SQL["country_stats"])
def _(p: Inputs):
    return rollup.stats_by_country(_rollup(p))


@query("rollup_aircraft", BASE + """
  select count(distinct icao24) as unique_count from kept where partition_date between date '2024-01-05' and date '2024-01-19'""")
def _(p: Inputs):
    return rollup.unique_aircraft(rollup.between(_rollup(p), "2024-01-05", "2024-01-19"))


# --- de-duplication with a chosen winner ---------------------------------------------


# A second years after the data, late in a month, so that it comes with the last part.
TICK = 2_000_400_000


@query("dedupe_latest_stream", BASE + f"""
  select event_id, icao24, callsign, time_position, longitude, latitude, baro_altitude, velocity, squawk, {stamp('processed_at')}
  from norm where time_position is not null
  qualify row_number() over (partition by icao24, time_position order by processed_at desc, event_id desc) = 1""")
def _(p: Inputs):
    """Whole rows: repeats come ten days after the first copy. A last message years later moves the watermark past all."""
    rows = clean.normalise(p.raw)
    columns = ["event_id", "icao24", "callsign", "time_position", "longitude", "latitude", "baro_altitude", "velocity", "squawk", "processed_at"]
    last = rows.limit(1).withColumns(
        {"icao24": F.lit("tick"), "time_position": F.lit(TICK).cast("long"), "processed_at": F.timestamp_seconds(F.lit(TICK + 60))}
    )
    picked = _to_parquet(
        p,
        rows.union(last.select(*rows.columns)),
        lambda stream: dedupe.latest_stream(stream, "31 days", ("processed_at", "event_id")).select(*columns),
        "latest",
    )
    return picked.filter("icao24 <> 'tick' OR icao24 IS NULL")


# --- places from a table -----------------------------------------------------------


@query("match_place_table", BASE + """
  , spots as (
    select floor(latitude * 2) / 2 as la, floor(longitude * 2) / 2 as lo, min(origin_country) as country from kept group by 1, 2),
  listed as (
    select row_number() over (order by la, lo) as pos, country || ' ' || row_number() over (order by la, lo) as name, la, lo from spots)
  select event_id, coalesce((
    select arg_min(name, pos) from listed where sqrt(pow(latitude - la, 2) + pow(longitude - lo, 2)) < 0.5e0), 'Unknown') as place
  from kept""")
def _(p: Inputs):
    """Every report against a place for each half degree that has reports, thousands of them, numbered from the south-west."""
    half = lambda c: F.floor(F.col(c) * 2) / 2
    spots = p.silver.groupBy(half("latitude").alias("latitude"), half("longitude").alias("longitude")).agg(F.min("origin_country").alias("country"))
    numbered = spots.withColumn("pos", F.row_number().over(Window.orderBy("latitude", "longitude")))
    places = numbered.withColumn("name", F.concat_ws(" ", "country", F.col("pos").cast("string")))
    return geo.match_place_table(p.silver, places).select("event_id", "place")


# --- files that can be skipped ---------------------------------------------------------


@query("within_radius_clustered", SQL["within_radius"])
def _(p: Inputs):
    """From files laid out by place: most of them are skipped."""
    path = scratch(p.spark, "by-place")
    tables.write_clustered(p.silver, path, [geo.interleaved()], files=16)
    near = geo.within_radius(p.spark.read.parquet(path), km=500)
    return near.select("event_id", "icao24", F.round("distance_km", 6).alias("distance_km"))


# --- figures per batch -------------------------------------------------------------------


@query("quality_stream", SQL["quality_metrics"])
def _(p: Inputs):
    """What a listener has kept of four batches, added up."""
    path, offsets = scratch(p.spark, "quality"), scratch(p.spark, "quality-offsets")
    listener = metrics.QualityListener(p.spark, path)
    p.spark.streams.addListener(listener)
    try:

        def advance(stream: DataFrame):
            watched, _ = metrics.observe_quality(stream, p.as_of)
            return watched.writeStream.format("noop").option("checkpointLocation", offsets).trigger(availableNow=True).start()

        _arriving(p, p.raw, advance)
        p.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        p.spark.streams.removeListener(listener)
    return metrics.summed(metrics.batch_figures(p.spark, path))
