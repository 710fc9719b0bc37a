"""A daily rollup from which exact distinct counts of aircraft follow for any range of days.

An aircraft's address is a number of 24 bits, so a set of aircraft is a bitmap: 512 buckets of 32,768 bits. Bitmaps
merge by OR, so days and countries add up without reading reports again and without expanding rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.operators.marts import row_count
from contrail.sinks.tables import balanced

KEY = ["partition_date", "origin_country", "bucket"]


def address(column: str = "icao24") -> Column:
    """The 24-bit address as a number; null unless it is six hexadecimal digits."""
    valid = F.col(column).rlike(r"\A[0-9a-fA-F]{6}\z")
    return F.when(valid, F.conv(column, 16, 10).cast("long"))


def daily_rollup(df: DataFrame) -> DataFrame:
    """One row per date, country and bucket of addresses that has reports: counts, sums and the bitmap of addresses.

    Sums are those of the bucket's reports, so they add up over buckets as well. Rows without a date are left out.
    """
    dated = df.filter(F.col("partition_date").isNotNull()).withColumn("_address", address())
    known = F.bitmap_bit_position("_address")
    return dated.groupBy("partition_date", "origin_country", F.bitmap_bucket_number("_address").alias("bucket")).agg(
        row_count().alias("reports"),
        F.sum("baro_altitude").alias("alt_sum"),
        F.count("baro_altitude").alias("alt_n"),
        F.sum("velocity").alias("vel_sum"),
        F.count("velocity").alias("vel_n"),
        F.bitmap_construct_agg(known).alias("aircraft"),
    )


def write_rollup(df: DataFrame, path: str) -> None:
    """Write the rollup of `df`; the dates that it has are replaced, so a day can be rolled up again."""
    balanced(daily_rollup(df), "partition_date").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("partition_date").parquet(path)


def _merged(rollup: DataFrame, *groups: str) -> DataFrame:
    """Figures of the days in `rollup`, by `groups`: bitmaps are merged by bucket first, then their bits are counted."""
    add = [F.sum(name).alias(name) for name in ("reports", "alt_sum", "alt_n", "vel_sum", "vel_n")]
    buckets = rollup.groupBy(*groups, "bucket").agg(*add, F.bitmap_or_agg("aircraft").alias("aircraft"))
    counted = buckets.withColumn("aircraft", F.when(F.col("bucket").isNotNull(), F.bitmap_count("aircraft")).otherwise(0))
    return counted.groupBy(*groups).agg(
        F.sum("reports").alias("total_flights"),
        F.sum("aircraft").alias("unique_aircraft"),
        (F.sum("alt_sum") / F.nullif(F.sum("alt_n"), F.lit(0))).alias("avg_altitude"),
        (F.sum("vel_sum") / F.nullif(F.sum("vel_n"), F.lit(0))).alias("avg_velocity"),
    )


def between(rollup: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """The days from `first` to `last`, both included; other partitions are not read."""
    if first:
        rollup = rollup.filter(F.col("partition_date") >= F.lit(first).cast("date"))
    if last:
        rollup = rollup.filter(F.col("partition_date") <= F.lit(last).cast("date"))
    return rollup


def summary_by_day(rollup: DataFrame, days: int = 7) -> DataFrame:
    """What `marts.daily_summary` gives, newest days first."""
    countries = rollup.groupBy("partition_date").agg(F.count_distinct("origin_country").alias("countries"))
    whole = _merged(rollup, "partition_date").join(countries, "partition_date")
    return whole.orderBy(F.desc("partition_date")).limit(days)


def stats_by_country(rollup: DataFrame) -> DataFrame:
    """What `marts.country_stats` gives for the days in `rollup`."""
    return _merged(rollup.filter(F.col("origin_country").isNotNull()), "origin_country")


def unique_aircraft(rollup: DataFrame) -> DataFrame:
    """How many aircraft reported on the days in `rollup`, one row; 0 for none."""
    return _merged(rollup).select(F.coalesce("unique_aircraft", F.lit(0)).alias("unique_count"))
