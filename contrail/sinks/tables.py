"""Table writes: hourly, silver, reload, incremental upsert, replay and views."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail import schema as S
from contrail.operators import clean, marts, tracks


class EmptyInput(ValueError):
    """A write that needs rows got none."""


def balanced(df: DataFrame, *columns: str) -> DataFrame:
    """Group rows by partition column; AQE splits large groups and merges small ones."""
    return df.hint("rebalance", *[F.col(name) for name in columns])


def silver_key(base: str, when: datetime) -> str:
    """File key of one hourly batch."""
    return f"{base}{when:%Y/%m/%d/%H}/flights_{when:%Y%m%d%H%M%S}.parquet"


def write_hourly(df: DataFrame, path: str, time: str = "event_time") -> None:
    """Write below year, month, day and hour folders; the hours that `df` has are replaced.

    So the same batch can be written again. It is computed once, for the check and the write.
    """
    df = df.persist()
    try:
        if df.isEmpty():
            raise EmptyInput("nothing to write")
        parts = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
        dated = df.withColumns({name: F.date_format(time, pattern) for name, pattern in parts.items()})
        balanced(dated, *parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            *parts
        ).parquet(path)
    finally:
        df.unpersist()


def write_silver(df: DataFrame, path: str, whole: bool = False, fmt: str = "parquet") -> None:
    """Overwrite the dates present in `df`, or the `whole` table."""
    (
        balanced(df, "partition_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .partitionBy("partition_date")
        .format(fmt)
        .save(path)
    )


def refresh_table(df: DataFrame, path: str, schema: T.StructType = S.SILVER, fmt: str = "parquet") -> None:
    """Replace a table with `df` under a fixed schema, rows of a country kept together."""
    shaped = clean.conform(df, schema)
    (
        balanced(shaped, "partition_date")
        .sortWithinPartitions("partition_date", "origin_country")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("partition_date")
        .format(fmt)
        .save(path)
    )


def write_clustered(df: DataFrame, path: str, by: list[str | Column], files: int, whole: bool = True) -> None:
    """Write `df` so that each file holds one range of `by`, whose rows are sorted.

    A reader that filters on those columns, or on what they are made of, skips files by their least and greatest
    values. `files` is the number of ranges; a value that fills several of them is spread over several files by a
    hash of the row. For positions `by` is `operators.geo.interleaved`.
    """
    keys = {f"_by{i}": F.col(key) if isinstance(key, str) else key for i, key in enumerate(by)}
    spread = F.pmod(F.xxhash64(*df.columns), F.lit(files))
    ranged = df.withColumns(keys).repartitionByRange(files, *keys, spread).sortWithinPartitions(*keys)
    ranged.drop(*keys).write.mode("overwrite" if whole else "append").parquet(path)


# --- incremental upsert ----------------------------------------------------


def _folder(spark: SparkSession, path: str):
    """The folder's file system and path; the one place that needs the driver's JVM."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _folder(spark, path)
    return files.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    files, target = _folder(spark, path)
    files.delete(target, True)


def _staged(path: str) -> str:
    return path.rstrip("/") + ".staged"


def _stage(rows: DataFrame, path: str, partition: str) -> None:
    balanced(rows, partition).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        partition
    ).parquet(_staged(path))


def _move_in(spark: SparkSession, path: str) -> None:
    write_silver(spark.read.parquet(_staged(path)), path)
    remove(spark, _staged(path))


def rewrite(spark: SparkSession, rows: DataFrame, path: str, partition: str = "partition_date") -> None:
    """Replace the partitions that `rows` has by `rows`, which may be read from the same table.

    They are first written beside the table and then moved in; after a failure between the two the
    next call first finishes the move.
    """
    if exists(spark, f"{_staged(path)}/_SUCCESS"):
        _move_in(spark, path)
    _stage(rows, path, partition)
    _move_in(spark, path)


def newer_than(source: DataFrame, target: DataFrame, watermark: str) -> DataFrame:
    """Source rows at the target's highest watermark or past it; all of them if it has none.

    Rows of one batch share a watermark, so those at it may be new; the merge on the key makes
    it harmless to take the others again.
    """
    high = target.agg(F.max(watermark)).scalar()
    return source.filter(high.isNull() | (F.col(watermark) >= high))


def last_per_key(
    changes: DataFrame, key: str, watermark: str, tie_break: list[str] | None = None
) -> DataFrame:
    ties = [F.col(name).desc() for name in tie_break] if tie_break else [F.xxhash64(*changes.columns)]
    order = Window.partitionBy(key).orderBy(F.col(watermark).desc(), *ties)
    return changes.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


def merge_rows(latest: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Target rows whose key has no change, and the changes."""
    return target.join(latest.select(key), key, "left_anti").unionByName(latest)


def upsert_incremental(
    source: DataFrame,
    path: str,
    key: str = "position_id",
    watermark: str = "processed_at",
    partition: str = "partition_date",
) -> int:
    """Merge new source rows into a partitioned Parquet table; returns the rows taken.

    Rows at the last load's watermark are taken again. It is kept in a table of one row beside the
    target; without that the target's own column is read. Only partitions that receive rows are
    rewritten, so `partition` must follow from `key`; their values are listed on the driver, so
    there must be few of them, as there are of dates.
    The merged partitions are first written beside the table and then moved in; after a
    failure between the two the next call first finishes the move.
    """
    spark = source.sparkSession
    if exists(spark, f"{_staged(path)}/_SUCCESS"):
        _move_in(spark, path)

    if not exists(spark, path):
        if source.isEmpty():
            return 0
        watched, watch = observed(source, f"first load of {path}")
        _stage(last_per_key(watched, key, watermark), path, partition)
        _move_in(spark, path)
        _write_watermark(spark, path, watermark)
        return watch.get["rows"]

    target = spark.read.schema(source.schema).parquet(path)
    # Only what may be new since the last load; read for its dates and for the merge.
    held = _watermark_path(path)
    high = spark.read.parquet(held) if exists(spark, held) else target
    changes = newer_than(source, high, watermark).persist()
    try:
        # One row per day that received rows.
        per_day = dict(changes.groupBy(partition).count().collect())
        if per_day:
            touched = target.filter(F.col(partition).isin(list(per_day)))
            _stage(merge_rows(last_per_key(changes, key, watermark), touched, key), path, partition)
    finally:
        changes.unpersist()
    if per_day:
        _move_in(spark, path)
        _write_watermark(spark, path, watermark, list(per_day), partition)
    return sum(per_day.values())


def _watermark_path(path: str) -> str:
    return path.rstrip("/") + ".watermark"


def _write_watermark(
    spark: SparkSession, path: str, watermark: str, touched: list | None = None, partition: str = "partition_date"
) -> None:
    """Keep the highest watermark, of the partitions just written and the one kept before."""
    rows = spark.read.parquet(path)
    if touched is not None:
        rows = rows.filter(F.col(partition).isin(touched))
    held = _watermark_path(path)
    highest = rows.agg(F.max(watermark).alias(watermark))
    if exists(spark, held):
        highest = highest.union(spark.read.parquet(held)).agg(F.max(watermark).alias(watermark))
    value = highest.first()[0]
    spark.createDataFrame([(value,)], highest.schema).write.mode("overwrite").parquet(held)


def merge_into_table(source: DataFrame, table: str, key: str = "position_id") -> None:
    """The same merge for a table format that supports it."""
    (
        source.alias("source")
        .mergeInto(table, F.col(f"source.{key}") == F.col(f"{table}.{key}"))
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )


def rebuilt(
    raw: DataFrame, dates: list[str], as_of: str | Column, tie_break: list[str] | None = None
) -> DataFrame:
    """Silver rows of `dates` from raw reports with `processed_at`; dates are picked before any shuffle."""
    wanted = [F.lit(day).cast("date") for day in dates]
    chosen = raw.filter(F.to_date(F.timestamp_seconds("time_position")).isin(*wanted))
    return clean.to_silver(chosen, as_of, tie_break)


def replay(
    read_bronze: Callable[[], DataFrame],
    path: str,
    dates: list[str],
    as_of: str | Column,
    tie_break: list[str] | None = None,
) -> None:
    """Rebuild the silver partitions of `dates` from the raw history; other partitions stay as they are.

    `read_bronze` must return all raw reports of `dates`: what it leaves out is gone from the table.
    `streaming.arrivals.replay_landed` finds them by an index of the landed folders; for a table that a stream adds
    to there is `streaming.silver.replay`.
    """
    write_silver(rebuilt(read_bronze(), dates, as_of, tie_break), path)


# --- messages, views, metrics ----------------------------------------------


def publish_json(df: DataFrame) -> DataFrame:
    """Rows as JSON message values, nulls written out, keyed by aircraft."""
    whole = F.struct(*[F.col(name) for name in df.columns])
    return df.select(
        F.col("icao24").alias("key"), F.to_json(whole, {"ignoreNullFields": "false"}).alias("value")
    )


def write_topic(df: DataFrame, servers: str, topic: str) -> None:
    """Send messages to a topic; needs the Kafka connector on the classpath."""
    publish_json(df).write.format("kafka").option("kafka.bootstrap.servers", servers).option(
        "topic", topic
    ).save()


def create_views(spark: SparkSession, silver: DataFrame) -> list[str]:
    """Register the staging view and the marts; returns their names."""
    views = {
        "stg_positions": clean.stg_positions(silver),
        "fact_positions": tracks.fact_positions(silver),
        "dim_aircraft": tracks.dim_aircraft(silver),
        "dim_airlines": marts.dim_airlines(silver),
        "daily_flight_counts": marts.daily_country_counts(silver),
        "hourly_flight_activity": marts.hourly_activity_by_date(silver),
        "top_airlines": marts.top_airlines(silver),
    }
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)
    return list(views)


def run_metrics(raw: DataFrame, as_of: str, file: Column | None = None) -> DataFrame:
    """Rows read, rows valid, rows left after de-duplication, and input files if known.

    Reduced to one row per key before the shuffle.
    """
    judged = clean.with_reasons(clean.normalise(raw), as_of)
    good = (F.size("reasons") == 0).cast("long")
    keyed = judged.groupBy("icao24", "time_position").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(good).alias("good")
    )
    totals = keyed.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_read"),
        F.coalesce(F.sum("good"), F.lit(0)).alias("rows_valid"),
        F.count_if(F.col("good") > 0).alias("rows_written"),
    )
    if file is None:
        return totals
    return totals.withColumn("input_files", raw.agg(F.count_distinct(file)).scalar())


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows as they pass, without another pass: read `.get` after an action."""
    watch = Observation(name)
    return df.observe(watch, F.count(F.lit(1)).alias("rows")), watch
