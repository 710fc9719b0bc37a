"""Per-piece windows and salted joins against their plain forms, and plan shapes."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from contrail.plans import skew
from contrail.plans.pieces import with_previous


@pytest.fixture(scope="module")
def lopsided(spark):
    """One aircraft holds a third of the rows; values have nulls and days have gaps."""
    n = 3000
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string")))
    second = F.col("id") * 977 + F.pmod(F.xxhash64("id"), F.lit(400))
    return spark.range(n).select(
        key.alias("icao24"),
        second.alias("time_position"),
        F.to_date(F.timestamp_seconds(second)).alias("partition_date"),
        F.when(F.col("id") % 7 != 0, F.col("id") % 50).cast("double").alias("v"),
    )


def test_with_previous(lopsided):
    plain = Window.partitionBy("icao24").orderBy("time_position")
    expected = lopsided.select(
        "icao24",
        "time_position",
        F.lag("v").over(plain).alias("prev_v"),
        (F.row_number().over(plain) > 1).alias("has_prev"),
        F.count(F.lit(1)).over(Window.partitionBy("icao24")).alias("n"),
    )
    got = with_previous(lopsided, ["v"], totals={"n": F.count(F.lit(1))}).select(*expected.columns)
    assert sorted(got.collect(), key=repr) == sorted(expected.collect(), key=repr)


def test_key_maximum_of_rows_with_a_previous_one(lopsided):
    # The highest value of a key may be in its first row, which doesn't count, or its only one.
    rows = lopsided.union(lopsided.sparkSession.sql("SELECT 'one', 5L, DATE '1970-01-01', 9e9D"))
    firsts = lopsided.groupBy("icao24").agg(F.min("time_position").alias("t"))
    rows = rows.join(firsts, "icao24", "left").withColumn("v", F.when(F.expr("t = time_position"), 1e6).otherwise(F.col("v"))).drop("t")
    key = Window.partitionBy("icao24")
    marked = rows.withColumn("later", F.col("time_position") > F.min("time_position").over(key))
    expected = marked.withColumn("top", F.max(F.when(F.col("later"), F.col("v"))).over(key)).drop("later")
    got = with_previous(rows, ["v"], tops={"top": "v"}).select(*expected.columns)
    assert sorted(got.collect(), key=repr) == sorted(expected.collect(), key=repr)


@pytest.mark.parametrize("joins", ["broadcast", "sorted"])
def test_motion_and_paths_read_their_input_once(spark, tmp_path, joins):
    from contrail.operators import tracks
    from contrail.sinks import tables
    from contrail.sources import testbed

    tables.write_silver(testbed.silver_positions(spark, "/root/testdata/sf0.001"), str(tmp_path / "s"))
    silver = spark.read.parquet(str(tmp_path / "s"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1" if joins == "sorted" else "10m")
    try:
        for frame in [
            tracks.motion_deltas(silver, ["event_id"] if "event_id" in silver.columns else []),
            tracks.detect_anomalies(silver),
            tracks.anomaly_counts(silver),
            tracks.altitude_trend(silver, keep=["callsign"]).select("icao24", "callsign", "time_position", "baro_altitude", "trend"),
            tracks.path_segments(silver),
            tracks.segment_colours(silver),
        ]:
            frame.collect()
            text = frame._jdf.queryExecution().executedPlan().toString()
            final = text.split("== Initial Plan ==")[0]
            assert final.count("FileScan") == 1, final
            assert "ReusedExchange" in final
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_salted_join(spark, lopsided, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 100)
    monkeypatch.setattr(skew, "MAX_HOT", 100)
    counts = lopsided.groupBy("icao24").agg(F.count(F.lit(1)).alias("n"))
    hot = skew.hot_keys(counts, ["icao24"], "n", 3000)
    assert [r["icao24"] for r in hot.collect()] == ["hot"] and hot.first()["_parts"] == 10
    got = skew.salted_join(lopsided, counts, ["icao24"], hot)
    expected = lopsided.join(counts, "icao24")
    assert sorted(got.collect(), key=repr) == sorted(expected.collect(), key=repr)


def test_hot_keys_are_bounded(spark):
    counts = spark.range(100_000).select("id", F.lit(2_000_000).cast("long").alias("n"))
    assert skew.hot_keys(counts, ["id"], "n", 200_000_000_000).count() <= skew.MAX_HOT


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    from contrail.operators import clean, geo, marts
    from contrail.sinks import tables
    from contrail.sources import testbed

    tables.write_silver(testbed.silver_positions(spark, "/root/testdata/sf0.001"), str(tmp_path / "s"))
    silver = spark.read.parquet(str(tmp_path / "s"))

    def scan(df):
        text = df._jdf.queryExecution().executedPlan().toString()
        return text[text.index("FileScan"):]

    assert "ReadSchema: struct<origin_country:string>" in scan(marts.country_kpis(silver))
    near = scan(geo.within_radius(silver, km=100))
    assert "GreaterThanOrEqual(latitude" in near and "LessThanOrEqual(longitude" in near
    day = silver.filter(F.col("partition_date") == F.lit("2024-01-15").cast("date"))
    assert "PartitionFilters: [isnotnull(partition_date" in scan(day)
    assert "GreaterThan(baro_altitude,0.0)" in scan(clean.filter_view(silver))
