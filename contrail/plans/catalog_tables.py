"""Written tables and streams, read back. Everything is written to the shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from contrail import schema as S
from contrail.operators import clean, tracks
from contrail.plans.base_sql import BASE, day, distance, half_away, stamp
from contrail.plans.catalog_clean import MESSAGE, SILVER
from contrail.plans.catalog_tracks import PATH_SQL, PLACED, _path_text
from contrail.plans.registry import SQL, Inputs, query
from contrail.schema import RADAR_CENTRE
from contrail.session import scratch
from contrail.sinks import tables
from contrail.sources import files, streams
from contrail.streaming import bronze, dedupe, live, metrics, silver

ALL_SILVER = ["event_id", *S.MESSAGE.fieldNames(), "event_time", "processed_at", "partition_date"]


# --- tables ----------------------------------------------------------------


@query("silver_table", BASE + f"select {SILVER} from kept")
def _(p: Inputs):
    path = scratch(p.spark, "silver")
    tables.write_silver(p.silver, path)
    return files.read_table(p.spark, path).select(*ALL_SILVER)


@query("hourly_table", BASE + f"select {SILVER}, strftime(event_time, '%Y/%m/%d/%H') as hour_path from kept")
def _(p: Inputs):
    """Written twice, as after a failure: the hours are replaced."""
    path = scratch(p.spark, "hourly")
    for _ in range(2):
        tables.write_hourly(p.silver, path)
    back = p.spark.read.parquet(path)
    parts = [F.lpad(F.col(name).cast("string"), 2, "0") for name in ("month", "day", "hour")]
    return back.select(*ALL_SILVER, F.concat_ws("/", F.col("year").cast("string"), *parts).alias("hour_path"))


@query("refresh_table", BASE + f"select {MESSAGE}, {stamp('event_time')}, {stamp('processed_at')}, {day()} from kept")
def _(p: Inputs):
    path = scratch(p.spark, "gold")
    tables.refresh_table(p.silver, path)
    return files.read_table(p.spark, path).select(*S.SILVER.fieldNames())


FACTS = [
    "position_id", "aircraft_id", "airline_id", "callsign", "event_time", "latitude", "longitude",
    "baro_altitude", "velocity", "processed_at", "partition_date",
]


@query("upsert_incremental", BASE + f"""
  select md5(icao24 || '-' || strftime(kept.event_time, '%Y-%m-%d %H:%M:%S')) as position_id, icao24 as aircraft_id,
    nullif(regexp_extract(callsign, '^[A-Z]{{3}}'), '') as airline_id, callsign, {stamp()}, latitude, longitude,
    baro_altitude, velocity, {stamp('processed_at')}, {day()} from kept""")
def _(p: Inputs):
    """Three loads; the second and third are handed everything and take what is new. Facts of all
    raw copies go in, so a repeat that arrives in a later load replaces its first copy. Reports of
    a day share a stamp there, as those of a batch do, and the second load stops within a day."""
    path = scratch(p.spark, "facts")
    valid, _ = clean.validate(clean.normalise(p.raw), p.as_of)
    copies = tracks.fact_positions(
        clean.with_partition_date(
            clean.to_event_time(
                clean.dedupe(valid, ("icao24", "time_position", "processed_at"), tie_break=["event_id"])
            )
        )
    )
    batch = F.date_trunc("day", "processed_at")
    stamped = copies.withColumn("true_stamp", F.col("processed_at")).withColumn("processed_at", batch)
    # Of one stamp the later copy must win as well, so copies are reduced within a stamp first.
    order = Window.partitionBy("position_id", "processed_at").orderBy(F.desc("true_stamp"))
    stamped = stamped.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")
    middle = F.lit("2024-01-16 12:00:00").cast("timestamp")
    tables.upsert_incremental(stamped.filter(F.col("true_stamp") < middle - F.expr("interval 3 days")), path)
    tables.upsert_incremental(stamped.filter(F.col("true_stamp") < middle), path)
    tables.upsert_incremental(stamped, path)
    return files.read_table(p.spark, path).select(
        *[F.col("true_stamp").alias(c) if c == "processed_at" else c for c in FACTS]
    )


@query("replay", BASE + f"select {SILVER} from kept")
def _(p: Inputs):
    """A silver table with two wrong days is put right from the raw history."""
    path = scratch(p.spark, "replayed")
    days = ["2024-01-10", "2024-01-11"]
    wrong = F.when(F.to_date("event_time").isin(*[F.lit(d).cast("date") for d in days]), F.lit(-1.0))
    tables.write_silver(p.silver.withColumn("velocity", F.coalesce(wrong, F.col("velocity"))), path)
    tables.replay(lambda: p.raw, path, days, p.as_of, tie_break=["event_id"])
    return files.read_table(p.spark, path).select(*ALL_SILVER)


@query("read_ndjson", BASE + f"select {MESSAGE} from raw")
def _(p: Inputs):
    path = scratch(p.spark, "bronze")
    p.raw.select(*S.MESSAGE.fieldNames()).write.option("ignoreNullFields", "false").json(path)
    return files.read_ndjson(p.spark, path)


@query("read_tolerant", BASE + """
  select 'good' as side, count(*) as rows from raw where event_id % 100 <> 0
  union all select 'bad', count(*) from raw where event_id % 100 = 0""")
def _(p: Inputs):
    # Every hundredth message was cut in half before it was stored.
    path = scratch(p.spark, "damaged")
    sent = tables.publish_json(p.raw.select("event_id", *S.MESSAGE.fieldNames())).select("value")
    number = F.get_json_object("value", "$.event_id").cast("long")
    half = F.substring(F.col("value"), F.lit(1), (F.length("value") / 2).cast("int"))
    damaged = sent.select(F.when(number % 100 == 0, half).otherwise(F.col("value")).alias("value"))
    damaged.write.text(path, lineSep="\n")
    good, errors = files.read_tolerant(p.spark, path, glob="*.txt")
    return good.agg(F.lit("good").alias("side"), F.count(F.lit(1)).alias("rows")).unionByName(
        errors.agg(F.lit("bad").alias("side"), F.sum("errors").alias("rows"))
    )


# --- streams ---------------------------------------------------------------


PARTS = 4


def _arrival() -> Column:
    """In which of the parts a report arrives: by ten days, a repeat with the next."""
    days = F.expr("least((dayofmonth(timestamp_seconds(time_position)) - 1) div 10, 2)")
    return (days + (F.unix_timestamp("processed_at") - F.col("time_position") >= 60).cast("int")).cast("int")


def _arriving(p: Inputs, rows: DataFrame, advance: Callable[[DataFrame], StreamingQuery]) -> str:
    """Lets `rows` arrive in parts; after each a stream over all files so far takes what is new and stops.

    `rows` are computed once, and dealt out evenly: every later step reads those files.
    """
    folder = scratch(p.spark, "arriving")
    parted = rows.withColumn("_part", _arrival()).filter(F.col("_part").isin(*range(PARTS)))
    tables.balanced(parted).write.partitionBy("_part").parquet(folder)
    for part in range(PARTS):
        stream = p.spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true")
        advance(stream.parquet(f"{folder}/_part=[0-{part}]")).awaitTermination()
    return folder


def _to_parquet(p: Inputs, rows: DataFrame, build: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    path, offsets = scratch(p.spark, name), scratch(p.spark, f"{name}-offsets")
    _arriving(
        p,
        rows,
        lambda stream: build(stream)
        .writeStream.format("parquet")
        .option("checkpointLocation", offsets)
        .trigger(availableNow=True)
        .start(path),
    )
    return p.spark.read.parquet(path)


@query("bronze_stream", BASE + f"select event_id, {MESSAGE} from raw")
def _(p: Inputs):
    """Messages are landed as text and parsed afterwards."""
    folder, path, offsets = (scratch(p.spark, name) for name in ("messages", "landed", "landed-offsets"))
    whole = F.to_json(F.struct("event_id", *S.MESSAGE.fieldNames()), {"ignoreNullFields": "false"})
    for part in range(PARTS):
        p.raw.filter(_arrival() == part).select(whole.alias("value")).write.text(f"{folder}/{part}")
        messages = streams.read_messages(p.spark, "text", f"{folder}/*")
        bronze.land(messages, path, offsets, interval=None).awaitTermination()
    numbered = T.StructType([T.StructField("event_id", T.LongType()), *S.MESSAGE.fields])
    reports, _ = files.read_landed(p.spark, path, first="2024-01-01", schema=numbered)
    return reports.drop("processed_at")


@query("dedupe_stream", BASE + """
  select icao24, time_position, count(*) as copies from (select distinct icao24, time_position from raw)
  group by icao24, time_position""")
def _(p: Inputs):
    """Which of several copies comes first depends on arrival, so only the keys are compared."""
    once = _to_parquet(p, p.raw, lambda raw: dedupe.dedupe_stream(raw).select("icao24", "time_position"), "once")
    return once.groupBy("icao24", "time_position").agg(F.count(F.lit(1)).alias("copies"))


# What a stream keeps: of copies that arrive in different parts the first.
FIRST = BASE.replace(
    "order by processed_at desc, event_id desc",
    "order by epoch(processed_at)::bigint - time_position >= 60, processed_at desc, event_id desc",
)


def _streamed_silver(p: Inputs) -> tuple[str, str]:
    """(table, rejects) after all parts, and once more from the start for a new checkpoint."""
    path, rejects, offsets = (scratch(p.spark, name) for name in ("silver-stream", "rejects", "silver-offsets"))

    def advance(stream: DataFrame) -> StreamingQuery:
        return silver.silver_stream(stream, path, offsets, tie_break=["event_id"], rejects=rejects)

    folder = _arriving(p, p.raw, advance)
    again = p.spark.readStream.schema(p.raw.schema).option("recursiveFileLookup", "true").parquet(folder)
    other = scratch(p.spark, "new-offsets")
    silver.silver_stream(again, path, other, tie_break=["event_id"], rejects=rejects).awaitTermination()
    return path, rejects


@query("silver_stream", FIRST + f"select {SILVER} from kept")
def _(p: Inputs):
    """Each report is judged when it comes in. A new checkpoint takes everything again and adds nothing."""
    path, _ = _streamed_silver(p)
    silver.compact(p.spark, path, ["2024-01-05", "2024-01-06"])
    return silver.read_silver(p.spark, path).select(*ALL_SILVER)


@query("silver_stream_rejects", BASE + f"select event_id, icao24, time_position, {stamp('processed_at')} from flagged where bad")
def _(p: Inputs):
    path, rejects = _streamed_silver(p)
    return silver.read_rejects(p.spark, rejects, path).select("event_id", "icao24", "time_position", "processed_at")


@query("silver_stream_replayed", f"""
  select * from ({BASE} select {SILVER} from kept where partition_date in (date '2024-01-10', date '2024-01-11'))
  union all
  select * from ({FIRST} select {SILVER} from kept where partition_date not in (date '2024-01-10', date '2024-01-11'))""")
def _(p: Inputs):
    """Two days of a streamed table are rebuilt; a replay keeps the last copy of a report."""
    path, _ = _streamed_silver(p)
    clock = F.col("processed_at")
    silver.replay(lambda: p.raw, path, ["2024-01-10", "2024-01-11"], clock, tie_break=["event_id"])
    return silver.read_silver(p.spark, path).select(*ALL_SILVER)


@query("reject_rate_stream", SQL["reject_rate"])
def _(p: Inputs):
    path, offsets = scratch(p.spark, "rates"), scratch(p.spark, "rates-offsets")
    # Repeats come up to ten days late.
    _arriving(
        p,
        p.raw,
        lambda raw: metrics.reject_rate(raw, F.col("processed_at"), lateness="31 days")
        .writeStream.outputMode("update")
        .foreachBatch(
            lambda batch, number: batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(path)
        )
        .option("checkpointLocation", offsets)
        .trigger(availableNow=True)
        .start(),
    )
    # A window is written again with every batch that adds to it; the last one counts.
    written = p.spark.read.parquet(path)
    return written.groupBy("window_start", "reason").agg(
        F.max_by("rejects", "batch").alias("rejects"), F.max_by("per_second", "batch").alias("per_second")
    )


QUIET = 86400


def _shown(rows: DataFrame) -> DataFrame:
    pairs = F.transform("trail", lambda t: F.array(t["longitude"], t["latitude"]))
    return rows.select(
        "icao24", "time_position", "callsign", "baro_altitude", "squawk", "true_track", "origin_country", "trend",
        F.round("distance_km", 6).alias("distance_km"), _path_text(pairs).alias("trail"),
    )



@query("live_state", BASE + f"""
  , gaps as (
    select *, coalesce(time_position - lag(time_position) over w > {QUIET}, true) as broke,
      lag(baro_altitude) over w as before from kept where {PLACED}
    window w as (partition by icao24 order by time_position)),
  runs as (select *, sum(broke::int) over (partition by icao24 order by time_position) as run,
             row_number() over (partition by icao24 order by time_position desc) as age from gaps),
  last_run as (select * from runs qualify run = max(run) over (partition by icao24))
  select icao24, max(time_position) as time_position, arg_min_null(callsign, age) as callsign,
    arg_min_null(baro_altitude, age) as baro_altitude, arg_min_null(squawk, age) as squawk,
    arg_min_null(true_track, age) as true_track, arg_min_null(origin_country, age) as origin_country,
    arg_min_null(case when broke then '=' when baro_altitude > before + 10 then 'up'
                      when baro_altitude < before - 10 then 'down' else '=' end, age) as trend,
    {half_away(f"arg_min_null({distance('latitude', 'longitude', str(RADAR_CENTRE[0]), str(RADAR_CENTRE[1]))}, age)", 6)}
      as distance_km,
    ({PATH_SQL.replace(" order by time_position)", " order by time_position) filter (age <= 10)")}) as trail
  from last_run group by icao24""")
def _(p: Inputs):
    """The tracker's last row per aircraft. Reports are days apart here, so a track ends
    after a day without one."""
    fed = clean.to_event_time(clean.dedupe(clean.validate(clean.normalise(p.raw), p.as_of)[0], tie_break=["event_id"]))
    live_rows = _to_parquet(p, fed, lambda stream: live.track_live(stream, "31 days", QUIET), "live")
    return _shown(live.current(live_rows))
