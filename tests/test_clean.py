"""Single cleaning operators on small inputs."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail import schema as S
from contrail.operators import clean

AS_OF = "2025-07-29 00:00:00"
GOOD = ("801642", "AXB1124", "India", 1753735222, 75.8221, 28.2676, 4892.04, 161.18, None, None)
NAMES = S.MESSAGE.fieldNames()


def frame(spark, *changes):
    return spark.createDataFrame([{**dict(zip(NAMES, GOOD)), **change} for change in changes], S.MESSAGE)


@pytest.mark.parametrize(
    "change, reasons",
    [
        ({}, []),
        ({"icao24": "80164"}, ["icao24"]),
        ({"icao24": "GGGGGG"}, ["icao24"]),
        ({"icao24": "0x12ab"}, ["icao24"]),
        ({"icao24": None}, ["icao24"]),
        ({"icao24": "ABCDEF"}, []),
        ({"origin_country": None}, ["origin_country"]),
        ({"time_position": None}, ["time_missing"]),
        ({"time_position": 0}, ["time_missing"]),
        ({"time_position": 1753747200 + 7200}, ["time_future"]),
        ({"time_position": 1753747200 + 3600}, []),
        ({"time_position": 1753747200 - 366 * 86400}, ["time_old"]),
        ({"latitude": 100.0}, ["latitude"]),
        ({"longitude": 200.0}, ["longitude"]),
        ({"longitude": -75.0}, []),
        ({"longitude": 180.0, "latitude": 90.0}, []),
        ({"longitude": 0.0, "latitude": 0.0}, []),
        ({"longitude": None, "latitude": None}, ["longitude", "latitude"]),
        ({"baro_altitude": -1.0}, ["altitude_negative"]),
        ({"velocity": -1.0}, ["velocity_negative"]),
        ({"velocity": 600.0}, ["velocity_excess"]),
        ({"velocity": 500.0}, []),
        ({"callsign": None, "baro_altitude": None, "velocity": None}, []),
    ],
)
def test_validate(spark, change, reasons):
    df = frame(spark, change)
    assert clean.with_reasons(df, AS_OF).first()["reasons"] == reasons
    valid, rejected = clean.validate(df, AS_OF)
    assert (valid.count(), rejected.count()) == ((0, 1) if reasons else (1, 0))


def test_validate_strict(spark):
    good = frame(spark, {}, {"icao24": "801643"})
    assert clean.validate_strict(good, AS_OF) is good
    with pytest.raises(clean.BatchRejected, match="1 of 2"):
        clean.validate_strict(frame(spark, {}, {"latitude": 91.0}), AS_OF)
    with pytest.raises(clean.BatchRejected, match="no rows"):
        clean.validate_strict(good.limit(0), AS_OF)


def test_normalise(spark):
    rows = clean.normalise(
        frame(spark, {"icao24": "ABCDEF", "callsign": "  AXB1124 "}, {"callsign": "   "}, {"callsign": None})
    ).collect()
    assert [(r["icao24"], r["callsign"]) for r in rows] == [
        ("abcdef", "AXB1124"), ("801642", None), ("801642", None),
    ]


def test_coordinates(spark):
    df = frame(
        spark, {}, {"latitude": None}, {"longitude": None}, {"latitude": None, "longitude": None},
        {"latitude": 0.0, "longitude": 0.0},
    )
    assert clean.filter_valid_coords(df).count() == 2
    assert clean.filter_bbox(df).count() == 1


def test_bbox_is_inclusive(spark):
    df = frame(
        spark, {"latitude": 6.0, "longitude": 68.0}, {"latitude": 38.0, "longitude": 97.0},
        {"latitude": 38.01, "longitude": 80.0}, {"latitude": 5.99, "longitude": 80.0},
    )
    assert clean.filter_bbox(df).count() == 2
    assert clean.filter_bbox(df, S.LOCAL_BOX).count() == 0


def test_conform_and_check_schema(spark):
    sparse = spark.createDataFrame([("801642", 75.0, 1)], "ICAO24 string, longitude float, other int")
    shaped = clean.conform(sparse)
    assert shaped.schema.simpleString() == S.MESSAGE.simpleString()
    assert shaped.first()["latitude"] is None
    assert clean.check_schema(shaped) is shaped
    with pytest.raises(clean.SchemaDrift, match="latitude: missing"):
        clean.check_schema(shaped.drop("latitude"))
    with pytest.raises(clean.SchemaDrift, match="longitude: string, expected double"):
        clean.check_schema(shaped.withColumn("longitude", F.col("longitude").cast("string")))


def test_event_time(spark):
    assert clean.to_event_time(frame(spark, {"time_position": 1704067200})).first()["event_time"].year == 2024
    text = spark.createDataFrame(
        [("1704067200",), ("2024-01-01 00:00:00",), ("soon",), (None,)], "time_position string"
    )
    times = [r["event_time"] for r in clean.to_event_time(text).collect()]
    assert times[0] == times[1] and times[2:] == [None, None]


def test_partition_date_text(spark):
    df = spark.createDataFrame([(1704067200000,)], "ms long")
    assert clean.partition_date_text(df, "ms").first()["partition_date"] == "2024-01-01"
    dated = df.select(F.lit("2024-02-03").cast("date").alias("d"))
    assert clean.partition_date_text(dated, "d").first()["partition_date"] == "2024-02-03"


def test_coerce_types(spark):
    df = spark.createDataFrame([("1.5", "x"), ("n/a", "y")], "v string, w string")
    assert [tuple(r) for r in clean.coerce_types(df, {"v": "double", "absent": "int"}).collect()] == [
        (1.5, "x"), (None, "y"),
    ]


def test_dedupe_without_tie_break_is_stable(spark):
    rows = frame(spark, {"callsign": "A"}, {"callsign": "B"}, {"callsign": "C"})
    df = clean.with_processed_at(rows, AS_OF)
    first = clean.dedupe(df).collect()
    assert len(first) == 1
    assert clean.dedupe(df.orderBy(F.desc("callsign"))).collect() == first


def test_dedupe_cuts_copies_before_the_shuffle(spark):
    df = clean.with_processed_at(frame(spark, {}), AS_OF)
    plan = clean.dedupe(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_dead_letters(spark):
    df = spark.createDataFrame(
        [('{"icao24":"801642","time_position":1}',), ('{"icao24":',), ("nonsense",)], "value string"
    )
    good, dead = clean.route_dead_letters(df, AS_OF)
    assert [r["icao24"] for r in good.collect()] == ["801642"]
    assert sorted(r["original_message"] for r in dead.collect()) == ["nonsense", '{"icao24":']
    assert {r["error"] for r in dead.collect()} == {"Invalid JSON"}
    assert good.schema.names == NAMES + ["processed_at"]


def test_plausible_time(spark):
    df = spark.createDataFrame([("1970-01-01",), ("2000-12-31",), ("2001-01-01",), (None,)], "t string")
    assert clean.filter_plausible_time(df.select(F.col("t").cast("timestamp").alias("event_time"))).count() == 1


def test_search_callsign(spark):
    df = frame(spark, {"callsign": "AIC101"}, {"callsign": "IGO2"}, {"callsign": None})
    assert clean.search_callsign(df, "aic").count() == 1
    assert clean.search_callsign(df, "").count() == 3


def test_address_with_a_line_end_is_rejected(spark):
    rows = spark.createDataFrame([("801642",), ("801642\n",), ("\n801642",), ("80164",)], "icao24 string")
    found = rows.withColumn("bad", clean.failures(AS_OF)["icao24"])
    assert [r.bad for r in found.collect()] == [False, True, True, True]
