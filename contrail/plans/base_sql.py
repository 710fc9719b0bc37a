"""The same derivation as `sources.testbed` and `clean.to_silver`, as shared SQL."""

from contrail.schema import PLACES
from contrail.sources.testbed import AS_OF, AS_OF_EPOCH, PREFIXES

_PLACES = ", ".join(
    f"({i}, {round(lat * 1000)}, {round(lon * 1000)})" for i, (_, lat, lon) in enumerate(PLACES)
)

BASE = f"""
with place(i, alat, alon) as (values {_PLACES}),
event as (
  select event_id, user_id, ts, epoch_us(ts) // 1000000 as time_position,
         cast(regexp_extract(props, '([0-9]+)', 1) as integer) as k,
         event_id % 4 = 0 as app, event_id % 4 = 0 and event_id % 52 <> 0 as near,
         substring('{PREFIXES}', cast(user_id % 6 as integer) * 3 + 1, 3) as code
  from events),
once as (
  select e.event_id,
    case when e.event_id % 499 = 0 then 'INVALID'
         else lpad(lower(hex(user_id)), 6, '0') end as icao24,
    case when user_id % 13 = 0 then null
         when user_id % 11 = 0 then '7' || user_id
         when e.event_id % 10 = 0 then '  ' || code || user_id || ' '
         else code || user_id end as callsign,
    n_name as origin_country, time_position,
    case when e.event_id % 97 = 0 then null
         when near then (alon + ((e.event_id % 11) - 5) * 10) / 1000e0
         else (6400 + e.event_id * 53 % 3600) / 100e0 end as longitude,
    case when near then (alat + ((k % 11) - 5) * 10) / 1000e0
         else (400 + e.event_id * 37 % 3700) / 100e0 end as latitude,
    case when e.event_id % 41 = 0 then null when app then 100e0 + k * 12
         else 3000e0 + k * 90 end as baro_altitude,
    case when e.event_id % 503 = 0 then 600e0
         when app and e.event_id % 40 = 0 then 180e0
         when app then 55e0 + k % 60 else 120e0 + e.event_id * 7 % 160 end as velocity,
    cast(e.event_id * 17 % 360 as double) as true_track,
    case when e.event_id % 211 = 0 then '7700'
         else lpad(cast(user_id % 8 as varchar), 4, '0') end as squawk,
    ts
  from event e join nation on n_nationkey = user_id % 25 join place on i = user_id % 8),
raw as (
  select * exclude (ts), ts + interval '30' second as processed_at from once
  union all
  select * exclude (ts), ts + interval '90' second from once where event_id % 20 = 0),
norm as (
  select * replace (lower(icao24) as icao24, nullif(trim(callsign), '') as callsign) from raw),
judged as (
  select *,
    not coalesce(regexp_full_match(icao24, '[0-9a-fA-F]{{6}}'), false) as bad_icao24,
    origin_country is null as bad_country,
    coalesce(time_position <= 0, true) as bad_time_missing,
    coalesce(time_position > {AS_OF_EPOCH} + 3600, false) as bad_time_future,
    coalesce(time_position > 0 and time_position < {AS_OF_EPOCH} - 31536000, false) as bad_time_old,
    not coalesce(longitude between -180 and 180, false) as bad_longitude,
    not coalesce(latitude between -90 and 90, false) as bad_latitude,
    coalesce(baro_altitude < 0, false) as bad_altitude,
    coalesce(velocity < 0, false) as bad_velocity_negative,
    coalesce(velocity > 500, false) as bad_velocity_excess
  from norm),
flagged as (
  select *, bad_icao24 or bad_country or bad_time_missing or bad_time_future or bad_time_old
    or bad_longitude or bad_latitude or bad_altitude or bad_velocity_negative
    or bad_velocity_excess as bad from judged),
valid as (select * from flagged where not bad),
kept as (
  select event_id, icao24, callsign, origin_country, time_position,
    epoch_ms(time_position * 1000) as event_time, longitude, latitude, baro_altitude,
    velocity, true_track, squawk, processed_at,
    cast(epoch_ms(time_position * 1000) as date) as partition_date
  from valid
  qualify row_number() over (partition by icao24, time_position
                             order by processed_at desc, event_id desc) = 1),
live as (
  select * from (
    select * from kept where event_time > timestamp '{AS_OF}' - interval '1440' minute
    qualify row_number() over (partition by icao24 order by time_position desc) = 1)
  where latitude is not null and longitude is not null)
"""


def day(column: str = "partition_date", name: str | None = None) -> str:
    """A date as text."""
    return f"cast({column} as varchar) as {name or column.split('.')[-1]}"


def stamp(column: str = "event_time", name: str | None = None) -> str:
    """A timestamp as text, microseconds included."""
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f') as {name or column.split('.')[-1]}"


def half_away(expression: str, places: int) -> str:
    return f"cast(round(cast({expression} as decimal(38,12)), {places}) as double)"


def exact_mean(column: str, places: int = 6) -> str:
    return half_away(f"avg(cast({column} as decimal(18,12)))", places)


def distance(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"(12742e0 * asin(least(1e0, sqrt(pow(sin(radians({lat2} - {lat1}) / 2), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin(radians({lon2} - {lon1}) / 2), 2)))))"
    )
