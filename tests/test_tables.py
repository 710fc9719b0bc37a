"""Table writes, upserts, replay and metrics, read back from a temporary folder."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from contrail import schema as S
from contrail.operators import clean
from contrail.sinks import tables
from contrail.sources import files

AS_OF = "2024-02-01 00:00:00"
FACT = "position_id string, processed_at timestamp, partition_date date, velocity double"


def facts(spark, *rows):
    made = [
        (key, datetime.fromisoformat(seen), datetime.fromisoformat(day).date(), float(speed))
        for key, seen, day, speed in rows
    ]
    return spark.createDataFrame(made, FACT)


def content(spark, path):
    return {r["position_id"]: r["velocity"] for r in spark.read.parquet(path).collect()}


def test_upsert(spark, tmp_path):
    path = str(tmp_path / "facts")
    first = facts(spark, ("a", "2024-01-01 10:00", "2024-01-01", 1), ("b", "2024-01-01 10:00", "2024-01-02", 2))
    assert tables.upsert_incremental(first, path) == 2
    second = facts(
        spark,
        ("a", "2024-01-01 09:00", "2024-01-01", 9),  # older than the target: not taken
        ("b", "2024-01-01 11:00", "2024-01-02", 3),
        ("b", "2024-01-01 12:00", "2024-01-02", 4),  # the last change of a key wins
        ("c", "2024-01-01 11:00", "2024-01-03", 5),
    )
    assert tables.upsert_incremental(second, path) == 3
    assert content(spark, path) == {"a": 1.0, "b": 4.0, "c": 5.0}
    assert tables.upsert_incremental(second, path) == 1  # the row at the watermark, to no effect
    assert content(spark, path) == {"a": 1.0, "b": 4.0, "c": 5.0}


def test_upsert_of_equal_stamps(spark, tmp_path):
    path = str(tmp_path / "facts")
    batch = [(f"k{i}", "2024-01-01 10:00", f"2024-01-0{1 + i % 3}", i) for i in range(9)]
    tables.upsert_incremental(facts(spark, *batch[:4]), path)
    tables.upsert_incremental(facts(spark, *batch), path)
    assert content(spark, path) == {key: float(speed) for key, _, _, speed in batch}


def test_upsert_of_nothing(spark, tmp_path):
    path = str(tmp_path / "facts")
    row = facts(spark, ("a", "2024-01-01 10:00", "2024-01-01", 1))
    assert tables.upsert_incremental(row.limit(0), path) == 0
    assert tables.upsert_incremental(row, path) == 1
    assert content(spark, path) == {"a": 1.0}


def test_upsert_leaves_other_dates_alone(spark, tmp_path):
    path = tmp_path / "facts"
    tables.upsert_incremental(
        facts(spark, ("a", "2024-01-01 10:00", "2024-01-01", 1), ("b", "2024-01-01 10:00", "2024-01-02", 2)),
        str(path),
    )
    before = sorted(p.name for p in (path / "partition_date=2024-01-01").iterdir())
    tables.upsert_incremental(facts(spark, ("c", "2024-01-01 11:00", "2024-01-02", 3)), str(path))
    assert sorted(p.name for p in (path / "partition_date=2024-01-01").iterdir()) == before
    assert content(spark, str(path)) == {"a": 1.0, "b": 2.0, "c": 3.0}


def test_upsert_finishes_an_interrupted_move(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "facts")
    tables.upsert_incremental(facts(spark, ("a", "2024-01-01 10:00", "2024-01-01", 1)), path)
    whole = tables.write_silver

    def lost(*_args, **_kwargs):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(tables, "write_silver", lost)
    with pytest.raises(RuntimeError):
        tables.upsert_incremental(facts(spark, ("b", "2024-01-01 11:00", "2024-01-01", 2)), path)
    monkeypatch.setattr(tables, "write_silver", whole)
    tables.upsert_incremental(facts(spark, ("c", "2024-01-01 12:00", "2024-01-01", 3)), path)
    assert content(spark, path) == {"a": 1.0, "b": 2.0, "c": 3.0}


def reports(spark, *changes):
    base = dict(
        icao24="801642", callsign="AXB1124", origin_country="India", time_position=1704067200,
        longitude=75.8, latitude=28.2, baro_altitude=4892.0, velocity=161.0, true_track=None, squawk=None,
    )
    raw = spark.createDataFrame([{**base, **change} for change in changes], S.MESSAGE)
    return clean.with_processed_at(raw, "2024-01-05 00:00:00")


def test_hourly(spark, tmp_path):
    path = tmp_path / "hourly"
    df = clean.to_event_time(reports(spark, {}, {"time_position": 1704067200 + 3600 * 13}))
    tables.write_hourly(df, str(path))
    assert (path / "year=2024/month=01/day=01/hour=00").is_dir()
    assert (path / "year=2024/month=01/day=01/hour=13").is_dir()
    tables.write_hourly(df, str(path))
    assert spark.read.parquet(str(path)).count() == 2
    with pytest.raises(tables.EmptyInput):
        tables.write_hourly(df.limit(0), str(path))
    assert tables.silver_key("silver/", datetime(2024, 1, 15, 10, 30)) == (
        "silver/2024/01/15/10/flights_20240115103000.parquet"
    )


def test_write_silver_replaces_only_its_dates(spark, tmp_path):
    path = str(tmp_path / "silver")
    two = clean.to_silver(reports(spark, {}, {"time_position": 1704153600}), AS_OF)
    tables.write_silver(two, path)
    tables.write_silver(clean.to_silver(reports(spark, {"velocity": 5.0}), AS_OF), path)
    assert sorted(r["velocity"] for r in spark.read.parquet(path).collect()) == [5.0, 161.0]
    tables.write_silver(clean.to_silver(reports(spark, {"velocity": 6.0}), AS_OF), path, whole=True)
    assert [r["velocity"] for r in spark.read.parquet(path).collect()] == [6.0]


def test_refresh_table(spark, tmp_path):
    path = str(tmp_path / "gold")
    silver = clean.to_silver(reports(spark, {}, {"icao24": "801643"}), AS_OF)
    tables.refresh_table(silver.withColumn("unknown", F.lit(1)), path)
    tables.refresh_table(silver.filter("icao24 = '801643'").drop("callsign"), path)
    back = files.read_table(spark, path)
    assert sorted(back.columns) == sorted(S.SILVER.fieldNames())
    assert [(r["icao24"], r["callsign"]) for r in back.collect()] == [("801643", None)]


def test_replay(spark, tmp_path):
    path = str(tmp_path / "silver")
    raw = reports(spark, {}, {}, {"time_position": 1704153600}, {"latitude": 100.0})
    wrong = clean.to_silver(raw, AS_OF).withColumn("velocity", F.lit(-1.0))
    tables.write_silver(wrong, path)
    tables.replay(lambda: raw, path, ["2024-01-01"], AS_OF)
    rows = {str(r["partition_date"]): r["velocity"] for r in spark.read.parquet(path).collect()}
    assert rows == {"2024-01-01": 161.0, "2024-01-02": -1.0}


def test_messages(spark):
    sent = tables.publish_json(reports(spark, {"callsign": None}).select(*S.MESSAGE.fieldNames()))
    row = sent.first()
    assert row["key"] == "801642" and '"callsign":null' in row["value"]


def test_views(spark):
    names = tables.create_views(spark, clean.to_silver(reports(spark, {}), AS_OF))
    assert all(spark.table(name).count() == 1 for name in names)


def test_run_metrics(spark):
    raw = reports(spark, {}, {}, {"time_position": 1704153600}, {"latitude": 100.0})
    files_seen = raw.withColumn("file", F.lit("a.json"))
    row = tables.run_metrics(files_seen, AS_OF, F.col("file")).first()
    assert row.asDict() == {"rows_read": 4, "rows_valid": 3, "rows_written": 2, "input_files": 1}


def test_observed(spark):
    df, watch = tables.observed(reports(spark, {}, {}), "sent")
    df.write.format("noop").mode("overwrite").save()
    assert watch.get == {"rows": 2}
