"""Raw landing of a message stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from contrail.sources.streams import flush_options, read_messages

# Fixed value: time between flushes of the landing job.
FLUSH_INTERVAL = "300 seconds"
# Text form of times in landed files; the default one cuts them to milliseconds.
MICROSECONDS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
# How often a topic is asked whether enough messages wait for a flush.
POLL_INTERVAL = "5 seconds"


def write_bronze_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = FLUSH_INTERVAL,
    fmt: str = "json",
) -> StreamingQuery:
    """Append messages as files below their arrival date.

    A flush comes every `interval` with all that has arrived by then, or, with None, as soon as
    the source has handed out its rows and then stops. Offsets and files are committed together,
    so a failed flush is repeated and not lost.
    """
    arrived = F.col("landed_at") if "landed_at" in df.columns else F.current_timestamp()
    landed = df.withColumn("ingest_date", F.to_date(arrived))
    writer = (
        landed.writeStream.format(fmt)
        .option("timestampFormat", MICROSECONDS)
        .option("checkpointLocation", checkpoint)
        .partitionBy("ingest_date")
        .outputMode("append")
    )
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start(path)


def land_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    path: str,
    checkpoint: str,
    interval: str | None = FLUSH_INTERVAL,
    max_rows: int | None = None,
    flush_rows: int | None = None,
) -> StreamingQuery:
    """Land a topic's messages as they were received. Needs the Kafka connector.

    With `flush_rows` a flush comes as soon as so many messages wait, or after `interval` with those there are.

    A flush takes all that has arrived, so a backlog clears; `max_rows` caps a flush, and
    with it the pace, and is for a source that must be spared.
    """
    options = {"kafka.bootstrap.servers": servers}
    if flush_rows and interval:
        options |= flush_options(flush_rows, interval)
        interval = POLL_INTERVAL
    return land(read_messages(spark, "kafka", topic, max_rows, options), path, checkpoint, interval)


def land(messages: DataFrame, path: str, checkpoint: str, interval: str | None = FLUSH_INTERVAL) -> StreamingQuery:
    """Land messages of `read_messages`: their text, where they came from, and when.

    Nothing is parsed, so unreadable messages and unknown fields are kept for a later replay;
    `sources.files.read_landed` parses them.
    """
    return write_bronze_stream(messages, path, checkpoint, interval)
