"""Positions, motion, paths, geography, clusters."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from contrail.functions.geo import MERCATOR_RADIUS
from contrail.operators import clean, cluster, geo, marts, tracks
from contrail.plans.base_sql import BASE, day, distance, exact_mean, half_away, stamp
from contrail.plans.registry import Inputs, query
from contrail.schema import PLACES, RADAR_CENTRE

POSITION = ["icao24", "callsign", "origin_country", "time_position", "longitude", "latitude", "baro_altitude", "velocity"]
POSITION_SQL = ", ".join(POSITION)
PLACED = "latitude is not null and longitude is not null"
MOTION = f"""
  , steps as (
    select *, abs(baro_altitude - lag(baro_altitude) over w) as alt_change,
      abs(velocity - lag(velocity) over w) as speed_change,
      time_position - lag(time_position) over w as time_diff,
      count(*) over (partition by icao24) as reports
    from kept where {PLACED} and year(event_time) > 2000
    window w as (partition by icao24 order by time_position))
"""
ANOMALIES = MOTION + """
  , anomalies as (
    select *, 'Sudden Altitude Change' as anomaly_type,
      cast(cast(round_even(alt_change, 0) as bigint) as varchar) || ' m' as detail
    from steps where reports >= 2 and alt_change > 2000
    union all
    select *, 'Speed Anomaly', cast(cast(round_even(speed_change, 0) as bigint) as varchar) || ' m/s'
    from steps where reports >= 2 and speed_change > 100
    union all
    select *, 'Low-Alt High-Speed', cast(cast(round_even(baro_altitude, 0) as bigint) as varchar) || ' m @ '
      || cast(cast(round_even(velocity, 0) as bigint) as varchar) || ' m/s'
    from steps where reports >= 2 and baro_altitude < 500 and velocity > 150)
"""
SEGMENTS = f"""
  , linked as (
    select *, lag(longitude) over w as source_lng, lag(latitude) over w as source_lat,
      row_number() over w as nth
    from kept where {PLACED} window w as (partition by icao24 order by time_position)),
  segments as (
    select icao24, time_position, source_lng, source_lat, longitude as target_lng, latitude as target_lat,
      coalesce(baro_altitude, 0e0) as altitude from linked where nth > 1)
"""
FROM_CENTRE = distance("latitude", "longitude", str(RADAR_CENTRE[0]), str(RADAR_CENTRE[1]))


@query("latest_positions", BASE + f"select {POSITION_SQL}, {day()} from live")
def _(p: Inputs):
    return tracks.latest_positions(p.silver, p.as_of, p.minutes).select(*POSITION, "partition_date")


@query("latest_positions_on", BASE + f"""
  select {POSITION_SQL}, {day()} from (
    select * from kept where partition_date = date '2024-01-15'
    qualify row_number() over (partition by icao24 order by time_position desc) = 1) where {PLACED}""")
def _(p: Inputs):
    return tracks.latest_positions_on(p.silver, "2024-01-15").select(*POSITION, "partition_date")


@query("dim_aircraft", BASE + f"""
  select icao24 as aircraft_id, origin_country, {day('max(partition_date)', 'last_seen_date')} from kept
  group by icao24, origin_country
  qualify row_number() over (partition by icao24 order by max(partition_date) desc, origin_country) = 1""")
def _(p: Inputs):
    return tracks.dim_aircraft(p.silver)


@query("fact_positions", BASE + f"""
  select md5(coalesce(icao24, '{tracks.NULL_KEY_PART}') || '-' ||
      coalesce(strftime(kept.event_time, '%Y-%m-%d %H:%M:%S'), '{tracks.NULL_KEY_PART}')) as position_id,
    icao24 as aircraft_id, nullif(regexp_extract(callsign, '^[A-Z]{{3}}'), '') as airline_id, callsign,
    {stamp()}, latitude, longitude, baro_altitude, velocity, {stamp('processed_at')}, {day()}
  from kept where kept.event_time is not null""")
def _(p: Inputs):
    return tracks.fact_positions(p.silver)


@query("motion_deltas", BASE + MOTION + "select event_id, icao24, alt_change, speed_change, time_diff, reports from steps")
def _(p: Inputs):
    return tracks.motion_deltas(p.silver, ["event_id"]).select(
        "event_id", "icao24", "alt_change", "speed_change", "time_diff", "reports"
    )


@query("detect_anomalies", BASE + ANOMALIES + f"""
  select icao24, callsign, anomaly_type, detail, baro_altitude, velocity, latitude, longitude, {stamp()} from anomalies""")
def _(p: Inputs):
    return tracks.detect_anomalies(p.silver)


@query("anomaly_counts", BASE + ANOMALIES + """
  select count(*) as total, count(*) filter (anomaly_type = 'Sudden Altitude Change') as altitude_changes,
    count(*) filter (anomaly_type = 'Speed Anomaly') as speed_changes,
    count(*) filter (anomaly_type = 'Low-Alt High-Speed') as low_fast,
    count(*) filter (contains(anomaly_type, 'Altitude')) as shown_altitude,
    count(*) filter (contains(anomaly_type, 'Speed')) as shown_speed from anomalies""")
def _(p: Inputs):
    return tracks.anomaly_counts(p.silver)


@query("altitude_trend", BASE + """
  select event_id, icao24, baro_altitude, case when baro_altitude > before + 10 then 'up'
    when baro_altitude < before - 10 then 'down' else '=' end as trend
  from (select *, lag(baro_altitude) over (partition by icao24 order by time_position) as before from kept)""")
def _(p: Inputs):
    return tracks.altitude_trend(p.silver, keep=["event_id"]).select("event_id", "icao24", "baro_altitude", "trend")


# Coordinates have three decimals, so thousandths write them out exactly.
def _thousandths(column):
    return F.round(column * 1000).cast("long").cast("string")


def _path_text(path):
    return F.array_join(
        F.transform(path, lambda xy: F.concat(_thousandths(xy[0]), F.lit(" "), _thousandths(xy[1]))), ","
    )


PATH_SQL = """string_agg(cast(cast(round(longitude * 1000) as bigint) as varchar) || ' ' ||
  cast(cast(round(latitude * 1000) as bigint) as varchar), ',' order by time_position)"""


@query("recent_trail", BASE + f"""
  select icao24, count(*) as points, {PATH_SQL} as trail from (
    select * from kept where {PLACED}
    qualify row_number() over (partition by icao24 order by time_position desc) <= 10) group by icao24""")
def _(p: Inputs):
    pairs = F.transform("trail", lambda t: F.array(t["longitude"], t["latitude"]))
    return tracks.recent_trail(p.silver).select(
        "icao24", F.size("trail").cast("long").alias("points"), _path_text(pairs).alias("trail")
    )


@query("path_segments", BASE + SEGMENTS + "select * from segments")
def _(p: Inputs):
    return tracks.path_segments(p.silver).drop("partition_date")


@query("segment_colours", BASE + SEGMENTS + """
  , shares as (select *, altitude / greatest(max(altitude) over (partition by icao24), 1e0) as share from segments)
  select icao24, time_position, altitude, cast(greatest(0, least(255, trunc(share * 255))) as integer) as r,
    cast(greatest(0, least(255, trunc(255 - share * 200))) as integer) as g, 80 as b from shares""")
def _(p: Inputs):
    return tracks.segment_colours(p.silver).select("icao24", "time_position", "altitude", "r", "g", "b")


@query("path_arrays", BASE + f"""
  select icao24, {day()}, {PATH_SQL} as path from kept where {PLACED} group by icao24, kept.partition_date""")
def _(p: Inputs):
    paths = tracks.path_arrays(p.silver)
    return paths.withColumn("path", _path_text(F.col("path")))


@query("path_arrays_view", BASE + f"""
  select icao24, {day()}, {PATH_SQL} as path from kept where {PLACED} and baro_altitude > 0
  group by icao24, kept.partition_date""")
def _(p: Inputs):
    paths = tracks.path_arrays(clean.filter_view(p.silver))
    return paths.withColumn("path", _path_text(F.col("path")))


@query("path_endpoints", BASE + f"""
  select icao24, 'START' as label, arg_min(longitude, time_position) as longitude,
    arg_min(latitude, time_position) as latitude from kept where {PLACED} group by icao24
  union all
  select icao24, 'END', arg_max(longitude, time_position), arg_max(latitude, time_position)
  from kept where {PLACED} group by icao24""")
def _(p: Inputs):
    return tracks.path_endpoints(p.silver)


@query("altitude_profile", BASE + f"select icao24, {stamp()}, baro_altitude from kept where baro_altitude is not null")
def _(p: Inputs):
    return tracks.profile(p.silver, "baro_altitude")


@query("velocity_profile", BASE + f"select icao24, {stamp()}, velocity from kept where velocity is not null")
def _(p: Inputs):
    return tracks.profile(p.silver, "velocity")


@query("altitude_velocity_pairs", BASE + """select icao24, callsign, origin_country, velocity, baro_altitude from kept
  where velocity is not null and baro_altitude is not null""")
def _(p: Inputs):
    return tracks.altitude_velocity_pairs(p.silver)


@query("flight_path", BASE + f"""
  select {POSITION_SQL} from kept where {PLACED} and icao24 = (
    select icao24 from kept where {PLACED} group by icao24 having count(*) >= 2
    order by count(*) desc, icao24 limit 1)""")
def _(p: Inputs):
    # The page opens on the aircraft with the most points.
    busiest = marts.aircraft_activity(p.silver, limit=1)
    return tracks.all_positions(tracks.paths_of(p.silver, busiest)).select(*POSITION)


@query("all_positions", BASE + f"select {POSITION_SQL}, {stamp('processed_at')}, {day()} from kept where {PLACED}")
def _(p: Inputs):
    return tracks.all_positions(p.silver).select(*POSITION, "processed_at", "partition_date")


# --- geography -------------------------------------------------------------


@query("distance_km", BASE + f"select event_id, {half_away(FROM_CENTRE, 6)} as distance_km from kept")
def _(p: Inputs):
    return geo.with_distance(p.silver).select("event_id", F.round("distance_km", 6).alias("distance_km"))


@query("within_radius", BASE + f"""
  select event_id, icao24, {half_away(FROM_CENTRE, 6)} as distance_km from kept where {FROM_CENTRE} <= 500""")
def _(p: Inputs):
    near = geo.within_radius(p.silver, km=500)
    return near.select("event_id", "icao24", F.round("distance_km", 6).alias("distance_km"))


@query("radius_split", BASE + f"""
  select case when {FROM_CENTRE} <= 500 then 'local' else 'other' end as side, count(*) as rows,
    count(distinct icao24) as aircraft from kept where {PLACED} group by 1""")
def _(p: Inputs):
    return geo.radius_split(p.silver, km=500)


@query("radar_rows", BASE + f"""
  , linked as (select *, lag(baro_altitude) over (partition by icao24 order by time_position) as before from kept)
  select icao24, callsign, squawk, case when {FROM_CENTRE} <= 500 then 'local' else 'other' end as side,
    {half_away(FROM_CENTRE, 1)} as distance_km,
    case when baro_altitude <> 0 then cast(floor(baro_altitude * 3.28084e0 + 0.5e0) as bigint) end as altitude_ft,
    coalesce(cast(floor(velocity * 1.94384e0 + 0.5e0) as bigint), 0) as speed_kt,
    case when baro_altitude > before + 10 then 'up' when baro_altitude < before - 10 then 'down' else '=' end as trend
  from (select * from linked where event_time > timestamp '2024-01-31 00:00:00' - interval '1440' minute
        qualify row_number() over (partition by icao24 order by time_position desc) = 1) where {PLACED}""")
def _(p: Inputs):
    latest = tracks.latest_positions(tracks.altitude_trend(p.silver), p.as_of, p.minutes)
    return geo.radar_rows(latest, km=500).select(
        "icao24", "callsign", "squawk", "side", F.round("distance_km", 1).alias("distance_km"),
        "altitude_ft", "speed_kt", "trend",
    )


def _radar_sql(chosen: str) -> str:
    return BASE + f"""
  , seen as (select *, {FROM_CENTRE} as km, cast(floor(velocity * 1.94384e0 + 0.5e0) as bigint) as kt
             from live where {chosen}),
  fast as (select * from seen where kt > 0 order by kt desc, km, callsign desc limit 1),
  high as (select * from seen where baro_altitude > 0 order by baro_altitude desc, km, callsign desc limit 1),
  busy as (select substring(callsign, 1, 3) as code, count(*) as n from seen where callsign is not null
           group by 1 order by n desc, code limit 1)
  select (select count(*) from seen) as total, (select count(*) from seen where km <= 500) as local,
    (select count(*) from seen where km > 500) as national,
    (select kt from fast) as fastest_kt, (select callsign from fast) as fastest_callsign,
    (select cast(floor(baro_altitude * 3.28084e0 + 0.5e0) as bigint) from high) as highest_ft,
    (select callsign from high) as highest_callsign,
    (select code from busy) as top_airline, (select n from busy) as top_airline_count,
    (select count(*) from seen where squawk = '7700') as emergencies"""


@query("radar_kpis", _radar_sql("true"))
def _(p: Inputs):
    return geo.radar_kpis(tracks.latest_positions(p.silver, p.as_of, p.minutes), km=500)


@query("radar_kpis_search", _radar_sql("contains(callsign, 'IGO')"))
def _(p: Inputs):
    found = clean.search_callsign(tracks.latest_positions(p.silver, p.as_of, p.minutes), "igo")
    return geo.radar_kpis(found, km=500)


@query("emergencies", BASE + f"select event_id, icao24, callsign, {stamp()} from kept where squawk = '7700'")
def _(p: Inputs):
    return geo.emergencies(p.silver).select("event_id", "icao24", "callsign", "event_time")


@query("unit_columns", BASE + """
  select event_id, case when baro_altitude <> 0 then cast(floor(baro_altitude * 3.28084e0 + 0.5e0) as bigint) end as altitude_ft,
    coalesce(cast(floor(velocity * 1.94384e0 + 0.5e0) as bigint), 0) as speed_kt from kept""")
def _(p: Inputs):
    return geo.unit_columns(p.silver).select("event_id", "altitude_ft", "speed_kt")


@query("density_grid", BASE + f"""
  , cells as (select cast(floor(latitude / 0.5e0) as bigint) as cell_lat, cast(floor(longitude / 0.5e0) as bigint) as cell_lon,
      sum(velocity) as weight, count(*) as points from kept where {PLACED} group by 1, 2)
  select *, weight / (select max(weight) from cells) as share from cells""")
def _(p: Inputs):
    return geo.density_grid(p.silver)


@query("hex_counts", BASE + f"""
  , axial as (
    select (x * {math.sqrt(3) / 3!r}e0 - y / 3) / 20000e0 as q, (y * 2 / 3) / 20000e0 as r from (
      select radians(longitude) * {MERCATOR_RADIUS!r}e0 as x,
        ln(tan({math.pi / 4!r}e0 + radians(latitude) / 2)) * {MERCATOR_RADIUS!r}e0 as y from kept where {PLACED})),
  near as (select q, r, floor(q + 0.5e0) as nq, floor(r + 0.5e0) as nr, floor(-q - r + 0.5e0) as ns from axial),
  moved as (select *, abs(nq - q) as dq, abs(nr - r) as dr, abs(ns - (-q - r)) as ds from near),
  cells as (
    select cast(case when dq > dr and dq > ds then -nr - ns else nq end as bigint) as q,
      cast(case when dr >= dq and dr > ds then -nq - ns else nr end as bigint) as r, count(*) as points
    from moved group by 1, 2),
  ends as (select min(points) as lo, max(points) as hi from cells)
  select q, r, points, (points - lo) * 3000e0 / greatest(hi - lo, 1) as height,
    cast(least((points - lo) * 6 // greatest(hi - lo, 1), 5) as integer) as colour from cells cross join ends""")
def _(p: Inputs):
    return geo.hex_counts(p.silver)


@query("low_slow", BASE + "select event_id, icao24, latitude, longitude from kept where baro_altitude < 1500 and velocity < 120")
def _(p: Inputs):
    return cluster.low_slow(p.silver).select("event_id", "icao24", "latitude", "longitude")


# Clustering over distinct places with their weights. `reach` holds, per place, the
# lowest place it can be reached from by core places.
CLUSTERS = f"""
  , low as (select *, row_number() over (order by time_position, icao24) as nth
            from kept where baro_altitude < 1500 and velocity < 120),
  spots as (select latitude, longitude, count(*) as n, min(nth) as first from low group by 1, 2),
  spot as (select *, row_number() over (order by latitude, longitude) as id from spots),
  pair as (select a.id as a, b.id as b, b.n as n from spot a join spot b
           on abs(a.latitude - b.latitude) < 0.2 and {distance('a.latitude', 'a.longitude', 'b.latitude', 'b.longitude')} <= 15e0),
  core as (select a as id from pair group by a having sum(n) >= 5),
  link as (select a, b from pair where a in (select id from core) and b in (select id from core)),
  reach as (
    with recursive walk(start, id) as (
      select id, id from core
      union
      select walk.start, link.b from walk join link on link.a = walk.id)
    select id, min(start) as root from walk group by id),
  numbered as (
    select root, row_number() over (order by min(first)) - 1 as cluster
    from reach join spot using (id) group by root),
  spot_cluster as (
    select pair.a as id, min(cluster) as cluster from pair join reach on reach.id = pair.b
    join numbered using (root) group by pair.a),
  clustered as (
    select low.*, cast(coalesce(cluster, -1) as integer) as cluster
    from low join spot using (latitude, longitude) left join spot_cluster on spot_cluster.id = spot.id)
"""


def _clustered(p: Inputs):
    return cluster.approach_clusters(p.silver)


@query("dbscan", BASE + CLUSTERS + "select event_id, icao24, cluster from clustered")
def _(p: Inputs):
    return _clustered(p).select("event_id", "icao24", "cluster")


SUMMARY = f"""
  , summary as (
    select cluster, {exact_mean('latitude')} as latitude, {exact_mean('longitude')} as longitude,
      avg(baro_altitude) as avg_altitude, avg(velocity) as avg_velocity, count(*) as data_points,
      count(distinct icao24) as unique_aircraft from clustered where cluster <> -1 group by cluster)
"""


@query("cluster_summary", BASE + CLUSTERS + SUMMARY + "select * from summary")
def _(p: Inputs):
    return cluster.cluster_summary(_clustered(p))


@query("cluster_count", BASE + CLUSTERS + """
  select count(distinct case when cluster <> -1 then cluster end) as clusters,
    count(*) filter (cluster = -1) as noise from clustered""")
def _(p: Inputs):
    return cluster.cluster_count(_clustered(p))


_LISTED = ", ".join(f"({i}, '{name}', {lat}e0, {lon}e0)" for i, (name, lat, lon) in enumerate(PLACES))


@query("match_places", BASE + CLUSTERS + SUMMARY + f"""
  , listed(pos, name, la, lo) as (values {_LISTED})
  select cluster, data_points, coalesce((
    select arg_min(name, pos) from listed
    where sqrt(pow(latitude - la, 2) + pow(longitude - lo, 2)) < 0.5e0), 'Unknown') as place from summary""")
def _(p: Inputs):
    matched = geo.match_places(cluster.cluster_summary(_clustered(p)))
    return matched.select("cluster", "data_points", "place")
