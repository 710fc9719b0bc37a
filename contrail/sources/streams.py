"""Message streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.schema import MESSAGE


def read_stream(
    spark: SparkSession,
    kind: str,
    location: str,
    schema: T.StructType = MESSAGE,
    max_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Messages as typed rows.

    `kafka`: `location` is the topic; reading starts at the latest offset and a value that
    is no JSON gives a row of nulls. `json` or `parquet`: `location` is a folder. For
    dead letters read the `value` text with `read_messages`. Where the schema has no
    `processed_at`, rows get the time of their micro-batch.
    """
    if kind == "kafka":
        messages = read_messages(spark, kind, location, max_per_trigger, options)
        return messages.select(F.from_json("value", schema).alias("m"), "landed_at").select(
            "m.*", F.col("landed_at").alias("processed_at")
        )
    reader = spark.readStream.schema(schema).options(**(options or {}))
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    rows = reader.format(kind).load(location)
    return rows if "processed_at" in rows.columns else rows.withColumn("processed_at", F.current_timestamp())


def flush_options(rows: int, delay: str) -> dict[str, str]:
    """Options of a topic source whose batches start at `rows` new messages or after `delay`, whichever comes first."""
    return {"minOffsetsPerTrigger": str(rows), "maxTriggerDelay": delay}


def read_messages(
    spark: SparkSession,
    kind: str,
    location: str,
    max_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Messages as received: (value, origin, position, landed_at).

    `kafka`: `origin` is topic and partition, `position` the offset. Otherwise lines of a folder's
    files: `origin` is the file. `landed_at` is the time of the micro-batch.
    """
    landed = F.current_timestamp().alias("landed_at")
    reader = spark.readStream.format("kafka" if kind == "kafka" else "text").options(**(options or {}))
    if kind == "kafka":
        reader = reader.option("subscribe", location)
        if "startingOffsets" not in (options or {}):
            reader = reader.option("startingOffsets", "latest")
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        origin = F.concat_ws("-", "topic", "partition").alias("origin")
        return reader.load().select(
            F.col("value").cast("string").alias("value"), origin, F.col("offset").alias("position"), landed
        )
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    origin = F.col("_metadata.file_path").alias("origin")
    return reader.load(location).select("value", origin, F.lit(None).cast("long").alias("position"), landed)
