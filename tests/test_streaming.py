"""Streams over files: repeats, restarts, silence, dead letters."""

import json
import os
import subprocess
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from contrail import schema as S
from contrail.operators import clean
from contrail.sources import files, streams
from contrail.streaming import bronze, dedupe, live, metrics, silver

AS_OF = "2024-02-01 00:00:00"
START = 1704067200
NAMES = S.MESSAGE.fieldNames()


def message(second=0, icao24="801642", **over):
    base = dict(
        icao24=icao24, callsign="AXB1124", origin_country="India", time_position=START + second,
        longitude=75.8, latitude=28.2, baro_altitude=1000.0, velocity=161.0, true_track=None, squawk=None,
    )
    return base | over


def put(folder, name, messages):
    """Files are taken in the order of their times, so each gets its own second."""
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_text("".join(json.dumps(m) + "\n" for m in messages))
    when = 1700000000 + len(list(folder.iterdir()))
    os.utime(path, (when, when))


def run(stream, path, checkpoint):
    (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", str(checkpoint))
        .trigger(availableNow=True)
        .start(str(path))
        .awaitTermination()
    )


def reader(spark, folder):
    return streams.read_stream(spark, "json", str(folder), max_per_trigger=1)


def test_bronze_restart(spark, tmp_path):
    src = tmp_path / "src"
    put(src, "1.json", [message(0), message(1)])

    def land():
        bronze.write_bronze_stream(
            reader(spark, src), str(tmp_path / "bronze"), str(tmp_path / "offsets"), interval=None
        ).awaitTermination()
        return files.read_ndjson(spark, str(tmp_path / "bronze")).count()

    assert land() == 2
    put(src, "2.json", [message(2)])
    assert land() == 3
    assert land() == 3
    assert [p.name.split("=")[0] for p in (tmp_path / "bronze").iterdir() if p.is_dir() and "=" in p.name]


def test_dedupe_across_batches(spark, tmp_path):
    src = tmp_path / "src"
    put(src, "1.json", [message(0), message(0), message(1)])
    put(src, "2.json", [message(1), message(2)])
    once = dedupe.dedupe_stream(reader(spark, src), "60 seconds").select("icao24", "time_position")
    run(once, tmp_path / "out", tmp_path / "offsets")
    assert sorted(r["time_position"] - START for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [0, 1, 2]


def stamped(spark, folder):
    return clean.with_processed_at(reader(spark, folder), AS_OF)


def test_silver_restart_and_repeats(spark, tmp_path):
    src, path = tmp_path / "src", str(tmp_path / "silver")
    put(src, "1.json", [message(0), message(0), message(5, latitude=None)])

    def advance():
        silver.silver_stream(reader(spark, src), path, str(tmp_path / "offsets"), AS_OF).awaitTermination()
        return sorted(r["time_position"] - START for r in silver.read_silver(spark, path).collect())

    assert advance() == [0]
    put(src, "2.json", [message(0), message(7), message(86400)])
    assert advance() == [0, 7, 86400]
    assert advance() == [0, 7, 86400]


def test_silver_batch_run_twice(spark, tmp_path):
    path = str(tmp_path / "silver")
    batch = clean.with_processed_at(spark.createDataFrame([message(0), message(1)], S.MESSAGE), AS_OF)
    for _ in range(2):
        silver.add_batch(batch, path, AS_OF)
    assert silver.read_silver(spark, path).count() == 2
    silver.add_batch(batch.withColumn("time_position", F.col("time_position") + 1), path, AS_OF)
    assert silver.read_silver(spark, path).count() == 3
    silver.compact(spark, path, ["2024-01-01"])
    assert silver.read_silver(spark, path).count() == 3


def test_silver_goes_on_for_hours_and_with_a_new_checkpoint(spark, tmp_path):
    """Reports run hours past the start; two checkpoints lose nothing; rejects are kept."""
    src, path, bad = tmp_path / "src", str(tmp_path / "silver"), str(tmp_path / "bad")
    hours = [START + 3600 * h for h in range(6)]
    for h, second in enumerate(hours):
        rows = [message(0, time_position=second + i) for i in range(3)] + [message(0, time_position=second + 99_999)]
        frame = spark.createDataFrame(rows, S.MESSAGE).withColumn("processed_at", F.timestamp_seconds(F.lit(second)))
        frame.coalesce(1).write.parquet(str(src / str(h)))
        stream = spark.readStream.schema(frame.schema).option("recursiveFileLookup", "true").parquet(str(src))
        silver.silver_stream(stream, path, str(tmp_path / f"offsets{h % 2}"), rejects=bad).awaitTermination()
    assert silver.read_silver(spark, path).count() == 18
    rejected = spark.read.parquet(bad)
    assert rejected.select("time_position").distinct().count() == 6
    assert {tuple(r.reasons) for r in rejected.collect()} == {("time_future",)}


def test_landing_takes_a_backlog_at_once(spark, tmp_path):
    src, path = tmp_path / "src", str(tmp_path / "landed")
    for i in range(5):
        put(src, f"{i}.json", [message(1000 * i + k) for k in range(1000)])
    with open(src / "4.json", "a") as f:
        f.write('{broken\n{"icao24": "801642", "unknown": 1}\n')
    query = bronze.land(streams.read_messages(spark, "text", str(src)), path, str(tmp_path / "offsets"), "1 second")
    try:
        query.processAllAvailable()
        batches = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    finally:
        query.stop()
    assert batches == [5002]
    reports, dead = files.read_landed(spark, path)
    assert reports.count() == 5001 and [r.original_message for r in dead.collect()] == ["{broken"]
    assert spark.read.json(path).filter("value like '%unknown%'").count() == 1
    assert files.read_landed(spark, path, last="2000-01-01")[0].count() == 0


def test_dead_letters(spark, tmp_path):
    src = tmp_path / "src"
    put(src, "1.json", [message(0)])
    with open(src / "1.json", "a") as f:
        f.write("{broken\n")
    lines = streams.read_messages(spark, "text", str(src))
    good, dead = clean.route_dead_letters(lines, AS_OF)
    run(good, tmp_path / "good", tmp_path / "good-offsets")
    run(dead, tmp_path / "dead", tmp_path / "dead-offsets")
    assert spark.read.parquet(str(tmp_path / "good")).count() == 1
    assert [r["original_message"] for r in spark.read.parquet(str(tmp_path / "dead")).collect()] == ["{broken"]


def test_quality_of_each_batch(spark, tmp_path):
    src = tmp_path / "src"
    put(src, "1.json", [message(0), message(1, latitude=95.0), message(2, velocity=900.0)])
    watched, name = metrics.observe_quality(stamped(spark, src), AS_OF)
    query = (
        watched.writeStream.format("noop")
        .option("checkpointLocation", str(tmp_path / "offsets"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    figures = [p["observedMetrics"][name] for p in query.recentProgress if name in p["observedMetrics"]]
    first = next(f for f in figures if f["fetched"])
    assert (first["fetched"], first["sent"], first["error_latitude"], first["error_velocity_excess"]) == (3, 1, 1, 1)


def test_lag_bands(spark):
    lags = spark.createDataFrame([(0,), (9,), (10,), (29,), (30,)], "lag int")
    assert [r[0] for r in lags.select(metrics.lag_band(F.col("lag"))).collect()] == [
        "green", "green", "yellow", "yellow", "red",
    ]


def track(spark, tmp_path, *batches, **options):
    src = tmp_path / "src"
    for number, messages in enumerate(batches):
        put(src, f"{number}.json", messages)
    options.setdefault("lateness", "0 seconds")
    run(live.track_live(reader(spark, src), **options), tmp_path / "out", tmp_path / "offsets")
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    return sorted(rows, key=lambda r: (r["icao24"], r["time_position"], r["status"] == "expired"))


def test_trend_and_trail(spark, tmp_path):
    climb = [message(i, baro_altitude=1000.0 + 20 * i, latitude=20.0 + i) for i in range(12)]
    rows = track(spark, tmp_path, list(reversed(climb)))
    last = [r for r in rows if r["status"] == "live"][-1]
    assert last["trend"] == "up" and last["time_position"] == START + 11
    assert [p["latitude"] for p in last["trail"]] == [22.0 + i for i in range(10)]
    assert last["distance_km"] > 0


@pytest.mark.parametrize("altitudes, expected", [
    ((1000.0, 1010.0), "="), ((1000.0, 1011.0), "up"), ((1000.0, 989.0), "down"), ((None, 500.0), "="), ((500.0, None), "="),
])
def test_trend(altitudes, expected):
    rows = [(i, 0.0, 0.0, altitude, None, None, None, None, None) for i, altitude in enumerate(altitudes)]
    assert live.trend(rows) == expected


def test_handler_needs_no_package_on_the_executors(tmp_path):
    (tmp_path / "handler").write_bytes(cloudpickle.dumps(live.LiveTracker(45)))
    load = "import pickle, sys; print(pickle.load(open(sys.argv[1], 'rb')).silence, 'contrail' in sys.modules)"
    done = subprocess.run(
        [sys.executable, "-c", load, str(tmp_path / "handler")], cwd=tmp_path, capture_output=True, text=True
    )
    assert done.stdout.strip() == "45 False", done.stderr


def test_busy_aircraft_is_cut_as_it_comes():
    import pandas as pd

    times = list(range(5000)) * 2
    chunk = pd.DataFrame({name: times if name == "time_position" else 0.0 for name in live.REPORT})
    held = live.newest({}, chunk, 11)
    assert list(held) == list(range(4989, 5000))
    assert list(live.newest(held, chunk[:100], 11)) == list(held)


def test_reports_of_one_second_in_any_order():
    import itertools

    import pandas as pd

    base = dict.fromkeys(live.REPORT) | {"time_position": 5, "latitude": 1.0, "longitude": 1.0}
    rows = [base, base | {"velocity": 3.0}, base | {"velocity": 2.0, "callsign": "B"}, base | {"velocity": 3.0, "callsign": "A"}]
    kept = set()
    for order in itertools.permutations(rows):
        one = live.newest({}, pd.DataFrame(list(order)), 11)
        held = {}
        for row in order:
            held = live.newest(held, pd.DataFrame([row]), 11)
        kept |= {tuple(one[5]), tuple(held[5])}
    assert len(kept) == 1


def test_state_is_called_once_a_group_and_batch():
    """However many aircraft a group has."""
    import pandas as pd

    class State:
        calls, value, timers = 0, None, set()

        def getValueState(self, name, schema):
            return self

        def get(self):
            self.calls += 1
            return self.value

        def update(self, value):
            self.calls += 1
            self.value = value

        def registerTimer(self, expiry):
            self.calls += 1
            self.timers.add(expiry)

        def deleteTimer(self, expiry):
            self.calls += 1
            self.timers.remove(expiry)

    class Watermark:
        def __init__(self, second):
            self.second = second

        def getCurrentWatermarkInMs(self):
            return self.second * 1000

    state, tracker = State(), live.LiveTracker(45)
    tracker.init(state)
    rows = [message(i, icao24=f"8016{i:02d}") | {"squawk": None} for i in range(50)] + [message(0, icao24=None)]
    frame = pd.DataFrame(rows)[["icao24", *live.REPORT]]
    shown = pd.concat(tracker.handleInputRows((7,), iter([frame[:30], frame[30:]]), Watermark(0)))
    assert state.calls == 3 and state.timers == {(START + 45) * 1000}
    assert len(shown) == 51 and set(shown.version) == {1} and shown.icao24.isna().sum() == 1
    state.timers.clear()  # as Spark does with a timer that has run
    ended = pd.concat(tracker.handleExpiredTimer((7,), Watermark(START + 45 + 9), None))
    assert sorted(ended.time_position - START) == [0, *range(10)] and set(ended.version) == {2}
    assert state.timers == {(START + 55) * 1000}
    list(tracker.handleInputRows((7,), iter([frame[:1]]), Watermark(START + 54)))
    assert state.timers == {(START + 54) * 1000 + 1}


def test_input_of_a_stream_is_computed_once(spark):
    from types import SimpleNamespace

    from contrail.plans.catalog_tables import _arriving

    computed = spark.sparkContext.accumulator(0)

    def count(second):
        computed.add(1)
        return second

    times = [START + 10 * 86400 * i for i in range(3)] + [None]
    rows = spark.createDataFrame([(t,) for t in times], "second long")
    rows = rows.select(F.udf(count, "long").asNondeterministic()("second").alias("time_position"))
    late = F.when(F.col("time_position") == START + 20 * 86400, 90).otherwise(30)
    rows = rows.withColumn("processed_at", F.timestamp_seconds(F.col("time_position") + late))
    seen = []

    def advance(stream):
        frame = stream.writeStream.format("memory").queryName(f"arrived{len(seen)}").trigger(availableNow=True).start()
        frame.awaitTermination()
        seen.append(spark.table(f"arrived{len(seen)}").count())
        return frame

    folder = _arriving(SimpleNamespace(spark=spark), rows, advance)
    assert seen == [1, 2, 2, 3]
    assert spark.read.option("recursiveFileLookup", "true").parquet(folder).count() == 3
    assert computed.value == 4


def test_dates_of_a_batch_need_no_shuffle_of_its_rows(spark, tmp_path, monkeypatch):
    path, bad, plans = str(tmp_path / "silver"), str(tmp_path / "bad"), []
    append = silver._append

    def spy(rows, dates, *others):
        plans.append(dates._jdf.queryExecution().optimizedPlan().toString())
        days = lambda df: {r[0] for r in df.select("partition_date").collect()}
        assert days(rows) == days(dates)
        append(rows, dates, *others)

    monkeypatch.setattr(silver, "_append", spy)
    rows = [message(s, **more) for s in (0, 0, 86400) for more in ({}, {"latitude": None})]
    batch = clean.with_processed_at(spark.createDataFrame(rows, S.MESSAGE), AS_OF)
    for _ in range(2):
        silver.add_batch(batch, path, AS_OF, rejects=bad)
    assert len(plans) == 4 and not any("Window" in plan or "Aggregate" in plan for plan in plans)
    assert silver.read_silver(spark, path).count() == 2 and silver.read_rejects(spark, bad, path).count() == 2


def test_silence_ends_a_track(spark, tmp_path):
    rows = track(
        spark, tmp_path,
        [message(0), message(0, icao24="801643")],
        [message(30), message(40)],
        [message(70)],
        [message(200, icao24="80164a")],
        [message(210, icao24="80164a")],
    )
    by_status = {(r["icao24"], r["status"], r["time_position"] - START) for r in rows}
    assert ("801643", "expired", 0) in by_status
    assert ("801642", "expired", 70) in by_status
    assert ("801642", "expired", 0) not in by_status
    assert ("80164a", "live", 210) in by_status


def test_report_after_silence_starts_anew(spark, tmp_path):
    rows = track(spark, tmp_path, [message(0), message(100, baro_altitude=5000.0)], lateness="1 hour")
    last = [r for r in rows if r["status"] == "live"][-1]
    assert last["trend"] == "=" and len(last["trail"]) == 1


def test_state_survives_a_restart(spark, tmp_path):
    src = tmp_path / "src"
    put(src, "0.json", [message(0)])
    for name, second in ((None, None), ("1.json", 20)):
        if name:
            put(src, name, [message(second, baro_altitude=2000.0)])
        run(live.track_live(reader(spark, src)), tmp_path / "out", tmp_path / "offsets")
    rows = spark.read.parquet(str(tmp_path / "out")).filter("status = 'live'").orderBy("time_position").collect()
    assert rows[-1]["trend"] == "up" and len(rows[-1]["trail"]) == 2


def test_reject_rate(spark, tmp_path):
    raw = spark.createDataFrame([message(i, velocity=900.0) for i in range(6)], S.MESSAGE)
    row = metrics.reject_rate(clean.with_processed_at(raw, AS_OF), AS_OF).first()
    assert (row["reason"], row["rejects"], row["per_second"]) == ("velocity_excess", 6, 0.02)
