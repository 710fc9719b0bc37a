"""Sources, cleaning, messages and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from contrail import schema as S
from contrail.operators import clean
from contrail.plans.base_sql import BASE, day, stamp
from contrail.plans.registry import Inputs, query
from contrail.sinks import tables
from contrail.sources import files, snapshots
from contrail.streaming import metrics

MESSAGE = ", ".join(S.MESSAGE.fieldNames())
SILVER = f"event_id, {MESSAGE}, {stamp('event_time')}, {stamp('processed_at')}, {day()}"


def _message(df):
    return df.select("event_id", *S.MESSAGE.fieldNames())


@query("raw_positions", BASE + f"select event_id, {MESSAGE}, {stamp('processed_at')} from raw")
def _(p: Inputs):
    return p.raw


@query("explode_states", BASE + f"""select * replace (nullif(trim(callsign), '') as callsign)
  from (select {MESSAGE} from raw)""")
def _(p: Inputs):
    return snapshots.explode_states(snapshots.pack_snapshots(p.raw))


@query("filter_min_fields", BASE + "select count(*) as states, count(*) filter (event_id % 2 = 0) as kept from raw")
def _(p: Inputs):
    # Even events send a whole array, odd ones one that is a field too short.
    full = snapshots.state_array({name: F.col(name) for name in S.MESSAGE.fieldNames()})
    short = F.slice(full, 1, S.MIN_STATE_FIELDS - 1)
    states = p.raw.select(F.when(F.col("event_id") % 2 == 0, full).otherwise(short).alias("state"))
    return states.agg(F.count(F.lit(1)).alias("states")).select(
        "states", clean.filter_min_fields(states).agg(F.count(F.lit(1))).scalar().alias("kept")
    )


@query("path_timestamp", BASE + """
  select event_id, case when event_id % 3 = 0 then '2024-01-31 00:00:00.000000'
    else strftime(time_bucket(interval '1' second, processed_at), '%Y-%m-%d %H:%M:%S.%f') end as landed_at
  from raw""")
def _(p: Inputs):
    dated = F.concat(F.lit("bronze/"), F.date_format("processed_at", "yyyy/MM/dd/HHmmss"), F.lit("_batch.json"))
    path = F.when(F.col("event_id") % 3 == 0, F.lit("bronze/latest.json")).otherwise(dated)
    return p.raw.select("event_id", files.path_timestamp(path, p.as_of).alias("landed_at"))


@query("publish_json", BASE + f"select {MESSAGE} from raw")
def _(p: Inputs):
    sent = tables.publish_json(p.raw.select(*S.MESSAGE.fieldNames()))
    return sent.select(F.from_json("value", S.MESSAGE).alias("m")).select("m.*")


@query("dead_letters", BASE + """
  select case when event_id % 100 = 0 then 'Invalid JSON' end as error, count(*) as messages,
    '2024-01-31 00:00:00.000000' as processed_at from raw group by 1""")
def _(p: Inputs):
    # Every hundredth message is cut in half on its way.
    sent = tables.publish_json(p.raw.select("event_id", *S.MESSAGE.fieldNames()))
    number = F.get_json_object("value", "$.event_id").cast("long")
    half = F.substring(F.col("value"), F.lit(1), (F.length("value") / 2).cast("int"))
    damaged = sent.select(F.when(number % 100 == 0, half).otherwise(F.col("value")).alias("value"))
    good, dead = clean.route_dead_letters(damaged, p.as_of)
    both = good.select(F.lit(None).cast("string").alias("error"), "processed_at").union(
        dead.select("error", "processed_at")
    )
    return both.groupBy("error", "processed_at").agg(F.count(F.lit(1)).alias("messages"))


@query("filter_valid_coords", BASE + f"""select event_id, {MESSAGE} from raw
  where latitude is not null and longitude is not null""")
def _(p: Inputs):
    return _message(clean.filter_valid_coords(p.raw))


def _box_sql(box) -> str:
    return BASE + f"""select event_id, {MESSAGE} from raw
      where latitude between {box[0]} and {box[1]} and longitude between {box[2]} and {box[3]}
        and latitude <> 0 and longitude <> 0"""


@query("filter_bbox", _box_sql(S.COUNTRY_BOX))
def _(p: Inputs):
    return _message(clean.filter_bbox(p.raw))


@query("filter_bbox_local", _box_sql(S.LOCAL_BOX))
def _(p: Inputs):
    return _message(clean.filter_bbox(p.raw, S.LOCAL_BOX))


@query("validate_valid", BASE + f"select event_id, {MESSAGE} from valid")
def _(p: Inputs):
    return _message(clean.validate(clean.normalise(p.raw), p.as_of)[0])


@query("validate_rejected", BASE + f"""
  select event_id, {MESSAGE}, concat_ws(',', case when bad_icao24 then 'icao24' end,
    case when bad_country then 'origin_country' end,
    case when bad_time_missing then 'time_missing' end,
    case when bad_time_future then 'time_future' end, case when bad_time_old then 'time_old' end,
    case when bad_longitude then 'longitude' end, case when bad_latitude then 'latitude' end,
    case when bad_altitude then 'altitude_negative' end,
    case when bad_velocity_negative then 'velocity_negative' end,
    case when bad_velocity_excess then 'velocity_excess' end) as reasons
  from flagged where bad""")
def _(p: Inputs):
    rejected = clean.validate(clean.normalise(p.raw), p.as_of)[1]
    return rejected.select("event_id", *S.MESSAGE.fieldNames(), F.array_join("reasons", ",").alias("reasons"))


@query("reject_counts", BASE + """
  , reasons as (
  select 'icao24' as reason, count_if(bad_icao24) as rows from flagged
  union all select 'origin_country', count_if(bad_country) from flagged
  union all select 'time_missing', count_if(bad_time_missing) from flagged
  union all select 'time_future', count_if(bad_time_future) from flagged
  union all select 'time_old', count_if(bad_time_old) from flagged
  union all select 'longitude', count_if(bad_longitude) from flagged
  union all select 'latitude', count_if(bad_latitude) from flagged
  union all select 'altitude_negative', count_if(bad_altitude) from flagged
  union all select 'velocity_negative', count_if(bad_velocity_negative) from flagged
  union all select 'velocity_excess', count_if(bad_velocity_excess) from flagged)
  select reason, cast(rows as bigint) as rows from reasons where rows > 0""")
def _(p: Inputs):
    return clean.reject_counts(clean.normalise(p.raw), p.as_of)


@query("normalise", BASE + f"select event_id, {MESSAGE} from norm")
def _(p: Inputs):
    return _message(clean.normalise(p.raw))


@query("coerce_types", BASE + """
  select event_id, try_cast(text_altitude as double) as altitude, try_cast(text_velocity as double) as velocity
  from (select event_id, case when event_id % 7 = 0 then 'n/a' else cast(baro_altitude as varchar) end as text_altitude,
               case when event_id % 9 = 0 then '' else cast(velocity as varchar) end as text_velocity from raw)""")
def _(p: Inputs):
    text = p.raw.select(
        "event_id",
        F.when(F.col("event_id") % 7 == 0, F.lit("n/a")).otherwise(F.col("baro_altitude").cast("string")).alias("altitude"),
        F.when(F.col("event_id") % 9 == 0, F.lit("")).otherwise(F.col("velocity").cast("string")).alias("velocity"),
    )
    return clean.coerce_types(text, {"altitude": "double", "velocity": "double"})


@query("conform", BASE + """
  select icao24, cast(null as varchar) as callsign, origin_country, time_position, longitude, latitude,
    cast(null as double) as baro_altitude, cast(null as double) as velocity, true_track, squawk from raw""")
def _(p: Inputs):
    return clean.conform(p.raw.drop("callsign", "baro_altitude", "velocity"))


@query("to_event_time", BASE + f"""
  select event_id, {stamp('epoch_ms(time_position * 1000)', 'from_seconds')},
    case when event_id % 5 = 0 then null else strftime(epoch_ms(time_position * 1000), '%Y-%m-%d %H:%M:%S.%f') end as from_text
  from raw""")
def _(p: Inputs):
    written = F.date_format(F.timestamp_seconds("time_position"), "yyyy-MM-dd HH:mm:ss")
    text = F.when(F.col("event_id") % 5 == 0, F.lit("unknown")).otherwise(written)
    rows = p.raw.select("event_id", "time_position", text.alias("text"))
    both = clean.to_event_time(clean.to_event_time(rows, target="from_seconds"), "text", "from_text")
    return both.select("event_id", "from_seconds", "from_text")


@query("partition_dates", BASE + f"""
  select event_id, {day('cast(epoch_ms(time_position * 1000) as date)', 'partition_date')},
    {day('cast(epoch_ms(time_position * 1000) as date)', 'date_text')} from raw""")
def _(p: Inputs):
    dated = clean.with_partition_date(clean.to_event_time(p.raw))
    millis = dated.withColumn("millis", F.col("time_position") * 1000)
    return clean.partition_date_text(millis, "millis", "date_text").select(
        "event_id", "partition_date", "date_text"
    )


@query("with_processed_at", BASE + "select event_id, '2024-01-31 00:00:00.000000' as processed_at from raw")
def _(p: Inputs):
    return clean.with_processed_at(p.raw.drop("processed_at"), p.as_of).select("event_id", "processed_at")


@query("dedupe", BASE + f"""
  select event_id, {MESSAGE}, {stamp('processed_at')} from raw
  qualify row_number() over (partition by icao24, time_position order by processed_at desc, event_id desc) = 1""")
def _(p: Inputs):
    return clean.dedupe(p.raw, tie_break=["event_id"])


@query("silver", BASE + f"select {SILVER} from kept")
def _(p: Inputs):
    return p.silver


@query("filter_plausible_time", BASE + f"select event_id, {stamp()} from kept where year(event_time) > 2000")
def _(p: Inputs):
    return clean.filter_plausible_time(p.silver).select("event_id", "event_time")


@query("stg_positions", BASE + f"""
  select icao24, callsign, origin_country, {stamp()}, longitude, latitude, baro_altitude, velocity,
    {stamp('processed_at')}, {day()} from kept""")
def _(p: Inputs):
    return clean.stg_positions(p.silver.toDF(*[name.upper() for name in p.silver.columns]))


@query("filter_since", BASE + f"""select event_id, icao24, {stamp()} from kept
  where event_time > timestamp '2024-01-31 00:00:00' - interval '1440' minute""")
def _(p: Inputs):
    return clean.filter_since(p.silver, p.as_of, p.minutes).select("event_id", "icao24", "event_time")


VIEW_SQL = BASE + """
  select event_id, icao24, origin_country, longitude, latitude, baro_altitude from kept
  where latitude is not null and longitude is not null and baro_altitude > 0"""


VIEW = ["event_id", "icao24", "origin_country", "longitude", "latitude", "baro_altitude"]


@query("filter_view", VIEW_SQL)
def _(p: Inputs):
    return clean.filter_view(p.silver).select(*VIEW)


@query("filter_view_country", VIEW_SQL + " and baro_altitude >= 5000 and origin_country = 'NATION_3'")
def _(p: Inputs):
    return clean.filter_view(p.silver, "NATION_3", 5000).select(*VIEW)


@query("search_callsign", BASE + "select event_id, icao24, callsign from kept where contains(callsign, upper('aic1'))")
def _(p: Inputs):
    return clean.search_callsign(p.silver, "aic1").select("event_id", "icao24", "callsign")


@query("country_options", BASE + "select distinct origin_country from kept where origin_country is not null")
def _(p: Inputs):
    return clean.country_options(p.silver)


@query("run_metrics", BASE + """
  select count(*) as rows_read, count_if(not bad)::bigint as rows_valid,
    (select count(*) from (select distinct icao24, time_position from valid)) as rows_written from flagged""")
def _(p: Inputs):
    return tables.run_metrics(p.raw, p.as_of)


@query("quality_metrics", BASE + """
  select count(*) as fetched, count_if(not bad)::bigint as sent,
    count_if(bad_icao24)::bigint as error_icao24, count_if(bad_country)::bigint as error_origin_country,
    count_if(bad_time_missing)::bigint as error_time_missing, count_if(bad_time_future)::bigint as error_time_future,
    count_if(bad_time_old)::bigint as error_time_old, count_if(bad_longitude)::bigint as error_longitude,
    count_if(bad_latitude)::bigint as error_latitude, count_if(bad_altitude)::bigint as error_altitude_negative,
    count_if(bad_velocity_negative)::bigint as error_velocity_negative,
    count_if(bad_velocity_excess)::bigint as error_velocity_excess,
    max(epoch_us(processed_at) // 1000000 - time_position) as lag_seconds,
    case when max(epoch_us(processed_at) // 1000000 - time_position) >= 30 then 'red'
         when max(epoch_us(processed_at) // 1000000 - time_position) >= 10 then 'yellow'
         else 'green' end as lag_band from flagged""")
def _(p: Inputs):
    return metrics.quality_metrics(p.raw, p.as_of)


@query("reject_rate", BASE + """
  , bad_rows as (
    select time_position // 300 * 300 as w, unnest(list_filter([
      case when bad_icao24 then 'icao24' end, case when bad_country then 'origin_country' end,
      case when bad_time_missing then 'time_missing' end, case when bad_time_future then 'time_future' end,
      case when bad_time_old then 'time_old' end, case when bad_longitude then 'longitude' end,
      case when bad_latitude then 'latitude' end, case when bad_altitude then 'altitude_negative' end,
      case when bad_velocity_negative then 'velocity_negative' end,
      case when bad_velocity_excess then 'velocity_excess' end], lambda x: x is not null)) as reason
    from flagged where bad)
  select strftime(epoch_ms(w * 1000), '%Y-%m-%d %H:%M:%S.%f') as window_start, reason,
    count(*) as rejects, count(*) / 300e0 as per_second from bad_rows group by w, reason""")
def _(p: Inputs):
    return metrics.reject_rate(p.raw, p.as_of)
