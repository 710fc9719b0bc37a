"""Which raw folders hold the reports of a day: an index of event dates and arrival dates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.schema import MESSAGE
from contrail.sinks import tables
from contrail.sources import files


def _beside(landed: str, name: str) -> str:
    return f"{landed.rstrip('/')}.{name}"


def event_date(message: Column) -> Column:
    """Date of a message's report; null where it can't be read."""
    second = F.get_json_object(message, "$.time_position").try_cast("long")
    # Beyond what a timestamp can hold there is no date.
    return F.to_date(F.timestamp_seconds(F.when(F.abs(second) < 1 << 38, second)))


def index_arrivals(spark: SparkSession, landed: str) -> DataFrame:
    """(event_date, ingest_date, rows) of all that `streaming.bronze.land` has written to `landed`.

    A stream with a checkpoint of its own reads each landed file once, however often this is called. A batch that
    runs twice writes the same figures under the same number, of which one set counts.
    """
    path = _beside(landed, "arrivals")

    def add(batch: DataFrame, number: int) -> None:
        dated = batch.select(event_date(F.col("value")).alias("event_date"), "ingest_date")
        counts = dated.groupBy("event_date", "ingest_date").agg(F.count(F.lit(1)).alias("rows"))
        counts.withColumn("batch", F.lit(number).cast("long")).coalesce(1).write.mode("append").parquet(path)

    stream = spark.readStream.schema(files.LANDED).json(landed)
    query = stream.writeStream.foreachBatch(add).option("checkpointLocation", _beside(landed, "arrivals-offsets"))
    query.trigger(availableNow=True).start().awaitTermination()
    schema = "event_date date, ingest_date date, rows long, batch long"
    if not tables.exists(spark, path):
        return spark.createDataFrame([], schema).drop("batch")
    once = spark.read.schema(schema).parquet(path).distinct()
    return once.groupBy("event_date", "ingest_date").agg(F.sum("rows").alias("rows"))


def arrival_dates(spark: SparkSession, landed: str, dates: list[str]) -> list[date]:
    """Arrival dates that hold reports of `dates`; a list of calendar days."""
    wanted = [F.lit(day).cast("date") for day in dates]
    found = index_arrivals(spark, landed).filter(F.col("event_date").isin(*wanted))
    return sorted(row[0] for row in found.select("ingest_date").distinct().collect())


def read_days(
    spark: SparkSession, landed: str, dates: list[str], schema: T.StructType = MESSAGE
) -> tuple[DataFrame, DataFrame]:
    """(reports, dead letters) of the arrival folders that hold reports of `dates`; no other folder is read.

    Reports of other days that came in the same folders are among them.
    """
    return files.read_landed(spark, landed, schema=schema, arrivals=arrival_dates(spark, landed, dates))


def replay_landed(
    spark: SparkSession,
    landed: str,
    path: str,
    dates: list[str],
    as_of: str | Column | None = None,
    tie_break: list[str] | None = None,
    schema: T.StructType = MESSAGE,
) -> None:
    """Rebuild the silver partitions of `dates` from the landed messages, however late these came.

    The index says which folders hold them, so nobody has to guess a margin of arrival dates, and none is left out.
    Reports are judged at the time when each was landed, unless `as_of` fixes one.
    """
    clock = F.col("processed_at") if as_of is None else as_of
    tables.replay(lambda: read_days(spark, landed, dates, schema)[0], path, dates, clock, tie_break)
