"""File and message sources."""

import json

from pyspark.sql import functions as F

from contrail.operators import clean
from contrail.sources import files, snapshots

VALID = {
    "icao24": "801642", "callsign": "AXB1124", "origin_country": "India", "time_position": 1753735222,
    "longitude": 75.8221, "latitude": 28.2676, "baro_altitude": 4892.04, "velocity": 161.18,
}


def put(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_ndjson(spark, tmp_path):
    put(tmp_path, "2024/01/15/a.json", json.dumps(VALID) + "\n\n" + json.dumps({"icao24": "a", "extra": 1}) + "\n")
    put(tmp_path, "2024/01/15/notes.txt", "no json here")
    rows = files.read_ndjson(spark, str(tmp_path)).orderBy("icao24").collect()
    assert [r["icao24"] for r in rows] == ["801642", "a"]
    assert rows[0]["velocity"] == 161.18 and rows[1]["callsign"] is None


def test_documents(spark, tmp_path):
    put(tmp_path, "one.json", json.dumps(VALID, indent=2))
    put(tmp_path, "many.json", json.dumps([VALID, {**VALID, "icao24": "801643"}]))
    put(tmp_path, "none.json", "[]")
    assert files.read_json_documents(spark, str(tmp_path)).count() == 3


def test_mixed_set(spark, tmp_path):
    """Three files of three, no and one row, one row without a longitude."""
    put(tmp_path, "a.json", json.dumps([VALID, {**VALID, "icao24": "801643"}, {**VALID, "longitude": None}]))
    put(tmp_path, "b.json", "[]")
    put(tmp_path, "c.json", json.dumps(VALID))
    rows, errors = files.read_tolerant(spark, str(tmp_path), documents=True)
    assert clean.filter_valid_coords(rows).count() == 3
    assert errors.count() == 0


def test_tolerant(spark, tmp_path):
    put(tmp_path, "good.json", json.dumps(VALID) + "\n")
    put(tmp_path, "bad.json", "{broken\n" + json.dumps(VALID) + "\nalso broken\n")
    rows, errors = files.read_tolerant(spark, str(tmp_path))
    assert rows.count() == 2
    assert [(r["file"].rsplit("/", 1)[1], r["errors"]) for r in errors.collect()] == [("bad.json", 2)]


def test_tolerant_documents(spark, tmp_path):
    put(tmp_path, "good.json", json.dumps([VALID, VALID]))
    put(tmp_path, "bad.json", "[{]")
    rows, errors = files.read_tolerant(spark, str(tmp_path), documents=True)
    assert rows.count() == 2 and errors.count() == 1


def test_path_timestamp(spark):
    df = spark.createDataFrame(
        [("bronze/2024/01/15/143000_batch.json",), ("bronze/2024/01/15/143000_flights.json",), ("other.json",)],
        "path string",
    )
    out = df.select(
        F.date_format(files.path_timestamp("path", "2024-02-01 00:00:00"), "yyyy-MM-dd HH:mm:ss")
    ).collect()
    assert [r[0] for r in out] == ["2024-01-15 14:30:00", "2024-01-15 14:30:00", "2024-02-01 00:00:00"]


def state(**over):
    row = ["801642", "AXB1124 ", "India", 1753735222, None, 75.8, 28.2, 4892.0, False, 161.0, 90.0, None, None, None, "7700"]
    for index, value in over.items():
        row[int(index[1:])] = value
    return row


def explode(spark, states):
    df = spark.createDataFrame([(json.dumps({"time": 1, "states": states}),)], "value string")
    return snapshots.explode_states(df)


def test_snapshot(spark):
    rows = explode(spark, [state(), state(_6=50.0), ["stub"], state(_5=None), state(_1=None)]).collect()
    assert len(rows) == 4
    assert rows[0]["callsign"] == "AXB1124" and rows[0]["squawk"] == "7700" and rows[0]["true_track"] == 90.0
    assert rows[2]["longitude"] is None and rows[3]["callsign"] is None


def test_snapshot_short_arrays(spark):
    rows = explode(spark, [state()[:10], state()[:11], state()[:9]]).collect()
    assert [(r["velocity"], r["true_track"], r["squawk"]) for r in rows] == [
        (161.0, None, None), (161.0, 90.0, None),
    ]


def test_snapshot_box(spark):
    rows = explode(spark, [state(), state(_6=45.0), state(_6=2.0), state(_5=None)])
    assert clean.filter_bbox(rows).count() == 1


def test_empty_and_broken_snapshots(spark):
    df = spark.createDataFrame([('{"time":1,"states":[]}',), ('{"time":1}',), ("oops",)], "value string")
    assert snapshots.explode_states(df).count() == 0
