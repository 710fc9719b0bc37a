"""Reporting aggregates and profiles."""

from __future__ import annotations

from contrail.operators import clean, marts, profiles
from contrail.plans.base_sql import BASE, day, exact_mean, half_away, stamp
from contrail.plans.registry import Inputs, query
from contrail.sinks import tables

AVERAGES = "avg(baro_altitude) as avg_altitude, avg(velocity) as avg_velocity"
DAILY = f"""
  , daily as (select partition_date, origin_country, count(*) as flight_count, {AVERAGES}
    from kept where event_time is not null group by all)
"""
STATS = f"""
  , stats as (select origin_country, count(*) as total_flights, count(distinct icao24) as unique_aircraft, {AVERAGES}
    from kept where origin_country is not null group by all)
"""
AIRLINES = f"""
  , airlines as (select substring(callsign, 1, 3) as airline_code, origin_country, count(*) as flight_count, {AVERAGES}
    from kept where callsign is not null and length(callsign) >= 3 group by all
    order by flight_count desc, airline_code, origin_country limit 50)
"""
DURATIONS = f"""
  , durations as (
    select icao24, arg_min(callsign, time_position) filter (callsign is not null) as callsign,
      arg_min(origin_country, time_position) filter (origin_country is not null) as origin_country,
      min(event_time) as first_seen, max(event_time) as last_seen, count(*) as data_points, {AVERAGES},
      max(time_position) - min(time_position) as duration_seconds,
      (max(time_position) - min(time_position)) / 60e0 as duration_minutes
    from kept where latitude is not null and longitude is not null and year(event_time) > 2000
    group by icao24 having max(time_position) > min(time_position))
"""


@query("daily_country_counts", BASE + DAILY + f"select * replace (cast(partition_date as varchar) as partition_date) from daily")
def _(p: Inputs):
    return marts.daily_country_counts(p.silver)


@query("daily_summary", BASE + f"""
  select {day()}, count(*) as total_flights, count(distinct icao24) as unique_aircraft, {AVERAGES},
    count(distinct origin_country) as countries
  from kept where event_time is not null group by kept.partition_date order by kept.partition_date desc limit 7""")
def _(p: Inputs):
    return marts.daily_summary(p.silver)


@query("country_share", BASE + f"""
  select origin_country, count(*) as flight_count,
    {half_away('count(*) * 100e0 / sum(count(*)) over ()', 2)} as percentage, {AVERAGES}
  from kept where event_time is not null group by origin_country
  order by flight_count desc, origin_country limit 10""")
def _(p: Inputs):
    return marts.country_share(p.silver)


@query("hourly_activity", BASE + """
  select cast(hour(event_time) as integer) as hour_of_day, count(*) as flight_count,
    count(distinct icao24) as unique_aircraft from kept where event_time is not null group by 1""")
def _(p: Inputs):
    return marts.hourly_activity(p.silver)


@query("hourly_activity_by_date", BASE + f"""
  select {day()}, cast(hour(event_time) as integer) as hour_of_day, count(*) as flight_count,
    count(distinct icao24) as unique_aircraft from kept where event_time is not null group by 1, 2""")
def _(p: Inputs):
    return marts.hourly_activity_by_date(p.silver)


@query("top_airlines", BASE + AIRLINES + "select * from airlines")
def _(p: Inputs):
    return marts.top_airlines(p.silver)


@query("top_airline_counts", BASE + """
  select substring(callsign, 1, 3) as airline_code, origin_country, count(*) as flight_count
  from kept where callsign is not null group by 1, 2
  order by flight_count desc, airline_code, origin_country limit 50""")
def _(p: Inputs):
    return marts.top_airline_counts(p.silver)


@query("airline_report", BASE + AIRLINES + f"""
  select airline_code, origin_country, flight_count, {half_away('avg_altitude', 2)} as avg_altitude,
    {half_away('avg_velocity', 2)} as avg_velocity
  from airlines order by flight_count desc, airline_code, origin_country limit 15""")
def _(p: Inputs):
    return marts.airline_report(p.silver)


@query("dim_airlines", BASE + """
  select regexp_extract(callsign, '^[A-Z]{3}') as airline_id, count(*) as total_historical_waypoints
  from kept where nullif(regexp_extract(callsign, '^[A-Z]{3}'), '') is not null group by 1""")
def _(p: Inputs):
    return marts.dim_airlines(p.silver)


@query("altitude_velocity_stats", BASE + "select " + ", ".join(
    f"{half_away(f'{fn}({column})', 2)} as {fn}_{label}"
    for column, label in (("baro_altitude", "altitude"), ("velocity", "velocity"))
    for fn in ("min", "max", "avg")
) + " from kept where baro_altitude is not null and velocity is not null")
def _(p: Inputs):
    return marts.altitude_velocity_stats(p.silver)


@query("live_aircraft_count", BASE + """select count(distinct icao24) as unique_count from kept
  where event_time > timestamp '2024-01-31 00:00:00' - interval '1440' minute""")
def _(p: Inputs):
    return marts.live_aircraft_count(p.silver, p.as_of, p.minutes)


@query("aircraft_activity", BASE + f"""
  select icao24, max(callsign) as callsign, max(origin_country) as origin_country, count(*) as data_points,
    {stamp('min(event_time)', 'first_seen')}, {stamp('max(event_time)', 'last_seen')}
  from kept where latitude is not null and longitude is not null
  group by icao24 having count(*) >= 2 order by data_points desc, icao24 limit 200""")
def _(p: Inputs):
    return marts.aircraft_activity(p.silver)


@query("country_stats", BASE + STATS + "select * from stats")
def _(p: Inputs):
    return marts.country_stats(p.silver)


@query("country_table", BASE + STATS + """select * replace (round_even(avg_altitude, 0) as avg_altitude,
  round_even(avg_velocity, 0) as avg_velocity) from stats""")
def _(p: Inputs):
    return marts.country_table(p.silver)


@query("top_countries", BASE + STATS + "select * from stats order by total_flights desc, origin_country limit 15")
def _(p: Inputs):
    return marts.top_countries(p.silver)


@query("country_kpis", BASE + STATS + """
  select (select count(*) from stats) as total_countries, origin_country as top_country,
    total_flights as top_country_flights from stats order by total_flights desc, origin_country limit 1""")
def _(p: Inputs):
    return marts.country_kpis(p.silver)


@query("daily_trend", BASE + STATS + f"""
  select {day()}, origin_country, count(*) as flights from kept
  where origin_country in (select origin_country from stats order by total_flights desc, origin_country limit 5)
  group by kept.partition_date, origin_country""")
def _(p: Inputs):
    return marts.daily_trend(p.silver)


@query("top_n_with_others", BASE + STATS + """
  , placed as (select *, row_number() over (order by total_flights desc, origin_country) as place from stats)
  select origin_country, total_flights, unique_aircraft, avg_altitude, avg_velocity from placed where place <= 10
  union all
  select 'Others', cast(sum(total_flights) as bigint), 0, 0e0, 0e0 from placed where place > 10
  having sum(total_flights) > 0""")
def _(p: Inputs):
    return marts.top_n_with_others(p.silver)


def _overview(first: str) -> str:
    return BASE + DAILY + f"""
      select {first}, (select count(distinct left(callsign, 3)) from kept where length(callsign) >= 3) as active_airlines,
        avg(velocity) as avg_velocity, avg(baro_altitude) as avg_altitude,
        (select origin_country from daily order by partition_date desc, flight_count desc, origin_country limit 1)
          as top_country"""


@query("overview_kpis", _overview("""(select count(distinct icao24) from kept
    where event_time > timestamp '2024-01-31 00:00:00' - interval '1440' minute) as live_aircraft""") + " from live")
def _(p: Inputs):
    return marts.overview_kpis(p.silver, p.as_of, p.minutes)


@query("overview_kpis_on", _overview("count(*) as unique_aircraft") + """
  from (select * from kept where partition_date = date '2024-01-15'
        qualify row_number() over (partition by icao24 order by time_position desc) = 1)
  where latitude is not null and longitude is not null""")
def _(p: Inputs):
    return marts.overview_kpis_on(p.silver, "2024-01-15")


@query("country_totals_recent", BASE + DAILY + """
  select origin_country, cast(sum(flight_count) as bigint) as flight_count from daily
  where partition_date in (select distinct partition_date from daily order by 1 desc limit 30)
  group by 1 order by 2 desc, 1 limit 10""")
def _(p: Inputs):
    return marts.country_totals_recent(p.silver)


def _histogram(source: str, column: str, bins: int) -> str:
    return f"""
      , vals as (select cast({column} as double) as v from {source} where {column} is not null),
      ends as (select min(v) as lo, max(v) as hi from vals),
      slots as (select unnest(generate_series(1, (select case when lo < hi then {bins} else 1 end from ends))) as slot),
      placed as (select coalesce(greatest(least(ceil((v - lo) * {bins} / nullif(hi - lo, 0)), {bins}), 1), 1) as b
                 from vals cross join ends)
      select cast(slot as integer) as bin, lo + (slot - 1) * ((hi - lo) / {bins}) as bin_low,
        lo + slot * ((hi - lo) / {bins}) as bin_high, (select count(*) from placed where b = slot) as count
      from slots cross join ends"""


@query("altitude_histogram", BASE + _histogram("live", "baro_altitude", 10))
def _(p: Inputs):
    return marts.altitude_histogram(p.silver, p.as_of, p.minutes)


@query("flight_durations", BASE + DURATIONS + f"""
  select * replace (strftime(first_seen, '%Y-%m-%d %H:%M:%S.%f') as first_seen,
    strftime(last_seen, '%Y-%m-%d %H:%M:%S.%f') as last_seen) from durations""")
def _(p: Inputs):
    return marts.flight_durations(p.silver)


@query("duration_kpis", BASE + DURATIONS + """
  select count(*) as total_aircraft, sum(duration_seconds) / (count(*) * 60e0) as avg_minutes,
    max(duration_minutes) as max_minutes, min(duration_minutes) as min_minutes from durations""")
def _(p: Inputs):
    return marts.duration_kpis(p.silver)


@query("duration_histogram", BASE + DURATIONS + _histogram("durations", "duration_minutes", 20))
def _(p: Inputs):
    return marts.duration_histogram(p.silver)


@query("longest_flights", BASE + DURATIONS + """
  select icao24, callsign, origin_country, round_even(duration_minutes, 1) as duration_minutes, data_points,
    round_even(avg_altitude, 0) as avg_altitude, round_even(avg_velocity, 0) as avg_velocity
  from durations order by duration_seconds desc, icao24 limit 10""")
def _(p: Inputs):
    return marts.longest_flights(p.silver)


@query("airspace_stats", BASE + """
  select count(*) as total_positions, min(latitude) as min_latitude, max(latitude) as max_latitude,
    min(longitude) as min_longitude, max(longitude) as max_longitude, avg(baro_altitude) as avg_altitude
  from kept where latitude is not null and longitude is not null""")
def _(p: Inputs):
    return marts.airspace_stats(p.silver)


@query("path_summary", BASE + f"""
  select icao24, arg_min_null(callsign, time_position) as callsign, max(baro_altitude) as max_altitude,
    avg(velocity) as avg_speed, count(*) as track_points, {exact_mean('latitude')} as centre_latitude,
    {exact_mean('longitude')} as centre_longitude
  from kept where latitude is not null and longitude is not null group by icao24""")
def _(p: Inputs):
    return marts.path_summary(p.silver)


@query("points_per_aircraft", BASE + """
  select icao24, count(*) as points, arg_min(callsign, time_position) filter (callsign is not null) as callsign,
    coalesce(arg_min(callsign, time_position) filter (callsign is not null), 'Unknown')
      || ' (' || icao24 || ') - ' || count(*) || ' pts' as label
  from kept where latitude is not null and longitude is not null and baro_altitude > 0
  group by icao24 having count(*) >= 2""")
def _(p: Inputs):
    return marts.points_per_aircraft(clean.filter_view(p.silver))


# --- profiles --------------------------------------------------------------

PROFILED = ["callsign", "longitude", "baro_altitude", "time_position", "processed_at"]


@query("null_profile", BASE + " union all ".join(
    f"""select '{name}' as column_name, count(*) as total, count(*) - count({name}) as nulls,
      (count(*) - count({name})) * 100 // greatest(count(*), 1) as percent from raw"""
    for name in PROFILED
))
def _(p: Inputs):
    return profiles.null_profile(p.raw, PROFILED)


@query("range_profile", BASE + """
  select count(*) as rows, 'event_time' as column_name,
    strftime(min(event_time), '%Y-%m-%d %H:%M:%S.%f') as min_value,
    strftime(max(event_time), '%Y-%m-%d %H:%M:%S.%f') as max_value from kept
  union all select count(*), 'processed_at', strftime(min(processed_at), '%Y-%m-%d %H:%M:%S.%f'),
    strftime(max(processed_at), '%Y-%m-%d %H:%M:%S.%f') from kept
  union all select count(*), 'partition_date', cast(min(partition_date) as varchar),
    cast(max(partition_date) as varchar) from kept""")
def _(p: Inputs):
    return profiles.range_profile(p.silver, ["event_time", "processed_at", "partition_date"])


_EVENT_COLUMNS = [
    ("event_id", "bigint"),
    ("ts", "timestamp_ntz"),
    ("user_id", "bigint"),
    ("event_type", "string"),
    ("value", "double"),
    ("props", "string"),
]


@query("schema_profile", " union all ".join(
    f"""select {i} as ordinal, '{name}' as column_name, '{kind}' as data_type, count({name}) as filled from events"""
    for i, (name, kind) in enumerate(_EVENT_COLUMNS, start=1)
))
def _(p: Inputs):
    return profiles.schema_profile(p.events)


@query("sample_text", BASE + """
  select icao24, callsign, cast(time_position as varchar) as time_position, origin_country
  from kept order by kept.time_position, icao24 limit 5""")
def _(p: Inputs):
    columns = ["icao24", "callsign", "time_position", "origin_country"]
    return profiles.sample_text(p.silver, columns, ["time_position", "icao24"])


# --- views -----------------------------------------------------------------


def _view(p: Inputs, name: str):
    tables.create_views(p.spark, p.silver)
    return p.spark.table(name)


@query("view_daily_flight_counts", BASE + DAILY + "select * replace (cast(partition_date as varchar) as partition_date) from daily")
def _(p: Inputs):
    return _view(p, "daily_flight_counts")


@query("view_top_airlines", BASE + AIRLINES + "select * from airlines")
def _(p: Inputs):
    return _view(p, "top_airlines")
