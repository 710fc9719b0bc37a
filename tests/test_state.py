"""Kept state: versions of live rows, the ledger, the arrival index, the rollup, clustered files, places."""

import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from test_streaming import AS_OF, START, message, put, reader, run

from contrail import schema as S
from contrail.operators import clean, geo, marts, rollup
from contrail.sinks import tables
from contrail.sources import files, streams
from contrail.streaming import arrivals, bronze, dedupe, ledger, live, metrics, silver


# --- versions ---------------------------------------------------------------


def test_a_late_report_into_a_full_trail(spark, tmp_path):
    src = tmp_path / "src"
    put(src, "1.json", [message(10 * i, baro_altitude=100.0 * i) for i in range(12) if i != 8])
    put(src, "2.json", [message(80, latitude=29.5)])
    run(live.track_live(reader(spark, src), "10 minutes"), tmp_path / "out", tmp_path / "offsets")
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.version, r.time_position - START, len(r.trail)) for r in rows.collect()) == [(1, 110, 10), (2, 110, 10)]
    newest = live.current(rows).first()
    assert newest.version == 2
    assert [t.latitude for t in newest.trail if t.time_position == START + 80] == [29.5]


def test_versions_outlive_a_track(spark, tmp_path):
    src = tmp_path / "src"
    put(src, "1.json", [message(0)])
    put(src, "2.json", [message(500, icao24="801643")])
    run(live.track_live(reader(spark, src), "5 seconds"), tmp_path / "out", tmp_path / "offsets")
    put(src, "3.json", [message(600)])
    run(live.track_live(reader(spark, src), "5 seconds"), tmp_path / "out", tmp_path / "offsets")
    rows = spark.read.parquet(str(tmp_path / "out"))
    own = sorted((r.version, r.status, r.time_position - START) for r in rows.filter("icao24 = '801642'").collect())
    assert own[:3] == [(1, "live", 0), (2, "expired", 0), (3, "live", 600)]
    assert live.expired(rows).count() >= 1


# --- ledger ------------------------------------------------------------------


def batch_of(spark, *seconds):
    rows = [message(s) for s in seconds] + [message(s, latitude=None) for s in seconds]
    return clean.with_processed_at(spark.createDataFrame(rows, S.MESSAGE), AS_OF)


def figures(spark, path, rejects):
    kept = [r.time_position - START for r in silver.read_silver(spark, path).collect()]
    return sorted(kept), sorted(r.time_position - START for r in silver.read_rejects(spark, rejects, path).collect())


def test_a_batch_that_fails_between_its_tables(spark, tmp_path, monkeypatch):
    path, rejects = str(tmp_path / "silver"), str(tmp_path / "rejects")
    silver.add_batch(batch_of(spark, 0), path, AS_OF, rejects=rejects, writer="w", number=0)
    second = batch_of(spark, 0, 1, 2)

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(silver, "add_rejected", fail)
        silver.add_batch(second, path, AS_OF, rejects=rejects, writer="w", number=1)
    assert figures(spark, path, rejects) == ([0], [0])
    for _ in range(2):
        silver.add_batch(second, path, AS_OF, rejects=rejects, writer="w", number=1)
    assert figures(spark, path, rejects) == ([0, 1, 2], [0, 1, 2])
    assert spark.read.parquet(path).count() == 5  # what the failed attempt left
    silver.compact(spark, path, ["2024-01-01"])
    assert spark.read.parquet(path).count() == 3
    silver.add_batch(second, path, AS_OF, rejects=rejects, writer="other", number=0)
    assert figures(spark, path, rejects) == ([0, 1, 2], [0, 1, 2])
    silver.replay(lambda: batch_of(spark, 1, 7), path, ["2024-01-01"], AS_OF)
    assert figures(spark, path, rejects)[0] == [1, 7]
    assert ledger.entries(spark, path).count() == 3


# --- arrival index --------------------------------------------------------------


def test_a_replay_reads_only_the_folders_that_hold_its_days(spark, tmp_path):
    landed = str(tmp_path / "landed")
    rows = [(f'{{"time_position": {START + 86400 * day}, "icao24": "80164{day}"}}', f"2024-01-{1 + day + late:02d} 12:00:00") for day in range(9) for late in (0, 1, 12)]
    rows += [("no json", "2024-01-05 00:00:00"), ('{"time_position": 99999999999999999}', "2024-01-05 00:00:00")]

    def land(part):
        folder = str(tmp_path / "sent")
        frame = spark.createDataFrame(part, "value string, landed_at string")
        sent = frame.select("value", F.lit("x").alias("origin"), F.lit(1).cast("long").alias("position"), F.col("landed_at").cast("timestamp"))
        sent.write.mode("append").parquet(folder)
        stream = spark.readStream.schema(sent.schema).parquet(folder)
        bronze.land(stream, landed, str(tmp_path / "offsets"), interval=None).awaitTermination()

    land(rows[:10])
    assert [str(d) for d in arrivals.arrival_dates(spark, landed, ["2024-01-03"])] == ["2024-01-03", "2024-01-04", "2024-01-15"]
    land(rows[10:])
    want = {"2024-01-03", "2024-01-04", "2024-01-05", "2024-01-15", "2024-01-16"}
    days = ["2024-01-03", "2024-01-04"]
    assert {str(d) for d in arrivals.arrival_dates(spark, landed, days)} == want
    index = arrivals.index_arrivals(spark, landed)
    assert index.agg(F.sum("rows")).first()[0] == len(rows)
    good, _ = arrivals.read_days(spark, landed, days)
    assert {r.icao24 for r in good.collect()} >= {"801642", "801643"}
    read = {f.split("ingest_date=")[1].split("/")[0] for f in files.read_landed(spark, landed, arrivals=arrivals.arrival_dates(spark, landed, days))[0].select(F.col("processed_at").cast("date").cast("string")).distinct().toPandas().iloc[:, 0].map(lambda d: f"ingest_date={d}/")}
    assert read <= want
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [ingest_date" in plan or "PartitionFilters: [isnotnull(ingest_date" in plan
    assert arrivals.arrival_dates(spark, landed, ["2030-01-01"]) == []
    assert arrivals.read_days(spark, landed, ["2030-01-01"])[0].count() == 0


# --- rollup ------------------------------------------------------------------------


def test_rollup_counts_are_exact(spark, tmp_path):
    rng = random.Random(6)
    edges = ["000000", "000001", "007fff", "008000", "008001", "ffffff", "FFFFFF", "abcdeg"]
    rows = [
        (rng.choice([*edges, f"{rng.randrange(1 << 24):06x}"]), rng.choice(["A", "B", None]), rng.choice([None, 100.0, 250.0]), 10.0, f"2024-01-{rng.randint(1, 9):02d}")
        for _ in range(3000)
    ]
    frame = spark.createDataFrame(rows, "icao24 string, origin_country string, baro_altitude double, velocity double, d string")
    frame = frame.withColumn("partition_date", F.to_date("d")).drop("d")
    for _ in range(2):
        rollup.write_rollup(frame, str(tmp_path / "rollup"))
    stored = spark.read.parquet(str(tmp_path / "rollup"))
    valid = frame.filter(F.lower("icao24") != "abcdeg").withColumn("icao24", F.lower("icao24"))
    days = lambda df: df.filter(F.col("partition_date").between("2024-01-03", "2024-01-05"))
    assert rollup.unique_aircraft(rollup.between(stored, "2024-01-03", "2024-01-05")).first()[0] == days(valid).select("icao24").distinct().count()
    got = {r.origin_country: (r.total_flights, r.unique_aircraft) for r in rollup.stats_by_country(stored).collect()}
    counted = valid.filter("origin_country IS NOT NULL").groupBy("origin_country").agg(F.count_distinct("icao24").alias("n"))
    every = {r.origin_country: r["count"] for r in frame.groupBy("origin_country").count().collect()}
    assert got == {r.origin_country: (every[r.origin_country], r.n) for r in counted.collect()}
    assert rollup.summary_by_day(stored, 3).count() == 3
    assert rollup.unique_aircraft(stored.limit(0)).first()[0] == 0
    plan = rollup.unique_aircraft(rollup.between(stored, "2024-01-03", "2024-01-05"))._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "PartitionFilters: [isnotnull(partition_date" in plan


# --- chosen winner --------------------------------------------------------------


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_the_highest_copy_wins_in_any_order(spark, tmp_path, order):
    src = tmp_path / "src"
    copies = [message(0, velocity=v, callsign=c) for v, c in ((100.0, "A"), (300.0, None), (300.0, "B"))]
    for n, i in enumerate(order):
        put(src, f"{n}.json", [copies[i], copies[i]])
    put(src, "9.json", [message(5000)])
    put(src, "99.json", [copies[1]])
    stream = dedupe.latest_stream(reader(spark, src).drop("processed_at"), "60 seconds", ("velocity",))
    run(stream, tmp_path / "out", tmp_path / "offsets")
    assert [(r.velocity, r.callsign) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [(300.0, "B")]


# --- places, layout, figures, flushes ------------------------------------------------


def test_place_table_agrees_with_the_list(spark):
    rng = random.Random(7)
    places = [(i, f"p{i}", round(rng.uniform(-60, 60), 1), round(rng.uniform(-170, 170), 1)) for i in range(2000)]
    centres = [(i, rng.uniform(-60, 60), rng.uniform(-170, 170)) for i in range(400)]
    centres += [(i, places[0][2], places[0][3]) for i in range(1000, 1500)] + [(9999, None, 3.0)]
    frame = spark.createDataFrame(centres, "id long, latitude double, longitude double")
    table = spark.createDataFrame(places, "pos long, name string, latitude double, longitude double")

    def plain(lat, lon):
        if lat is None:
            return "Unknown"
        return next((n for _, n, la, lo in places if ((lat - la) ** 2 + (lon - lo) ** 2) ** 0.5 < 2.0), "Unknown")

    got = geo.match_place_table(frame, table, 2.0)
    assert got.columns == [*frame.columns, "place"]
    assert {r.id: r.place for r in got.collect()} == {i: plain(lat, lon) for i, lat, lon in centres}
    assert got.count() == len(centres)
    listed = geo.match_places(frame, [(n, la, lo) for _, n, la, lo in places[:30]], 2.0)
    few = geo.match_place_table(frame, table.filter("pos < 30"), 2.0)
    assert sorted(map(str, few.collect())) == sorted(map(str, listed.collect()))


def skipped(path, column, low, high):
    """Files whose least and greatest values exclude the range, and all files."""
    out, found = 0, glob.glob(f"{path}/**/*.parquet", recursive=True)
    for file in found:
        meta = pq.read_metadata(file)
        at = [meta.row_group(0).column(i).path_in_schema for i in range(meta.num_columns)].index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        out += max(s.max for s in stats) < low or min(s.min for s in stats) > high
    return out, len(found)


def test_clustered_files_are_skipped(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, rng.uniform(6, 38), rng.uniform(68, 97), rng.choice(["India", "Nepal", "Oman", "Qatar", "Japan"])) for i in range(20_000)]
    frame = spark.createDataFrame(rows, "id long, latitude double, longitude double, origin_country string").repartition(16)
    frame.write.parquet(str(tmp_path / "plain"))
    tables.write_clustered(frame, str(tmp_path / "place"), [geo.interleaved()], files=64)
    tables.write_clustered(frame, str(tmp_path / "country"), ["origin_country"], files=16)
    assert skipped(tmp_path / "plain", "latitude", 22, 23)[0] == 0
    by_lat, n = skipped(tmp_path / "place", "latitude", 22, 23)
    by_lon, _ = skipped(tmp_path / "place", "longitude", 86, 87)
    assert by_lat >= n / 3 and by_lon >= n / 3
    gone, n = skipped(tmp_path / "country", "origin_country", "Nepal", "Nepal")
    assert n >= 12 and gone >= n / 2
    back = spark.read.parquet(str(tmp_path / "place"))
    assert back.columns == frame.columns and back.count() == 20_000


def test_figures_of_every_batch(spark, tmp_path):
    src, path = tmp_path / "src", str(tmp_path / "figures")
    put(src, "1.json", [message(0), message(1, velocity=-1.0)])
    put(src, "2.json", [message(2), message(3, latitude=None), message(4)])
    listener = metrics.QualityListener(spark, path)
    spark.streams.addListener(listener)
    try:
        watched, _ = metrics.observe_quality(clean.with_processed_at(reader(spark, src).drop("processed_at"), AS_OF), AS_OF)
        run(watched, tmp_path / "out", tmp_path / "offsets")
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    found = metrics.batch_figures(spark, path)
    assert sorted((r.batch, r.fetched, r.sent) for r in found.collect()) == [(0, 2, 1), (1, 3, 2)]
    total = metrics.summed(found).first()
    assert (total.fetched, total.sent, total.error_velocity_negative, total.error_latitude) == (5, 3, 1, 1)


def test_a_flush_by_rows_or_time(monkeypatch):
    seen = {}
    monkeypatch.setattr(bronze, "read_messages", lambda spark, kind, topic, rows, options: seen.update(options))
    monkeypatch.setattr(bronze, "land", lambda messages, path, checkpoint, interval: seen.update(interval=interval))
    bronze.land_topic(None, "host:1", "topic", "path", "offsets", flush_rows=500)
    assert seen["minOffsetsPerTrigger"] == "500" and seen["maxTriggerDelay"] == bronze.FLUSH_INTERVAL
    assert seen["interval"] == bronze.POLL_INTERVAL
    assert streams.flush_options(5, "1 minute") == {"minOffsetsPerTrigger": "5", "maxTriggerDelay": "1 minute"}
