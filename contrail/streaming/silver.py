"""Bronze to silver, one micro-batch at a time."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from contrail.operators import clean
from contrail.sinks import tables
from contrail.streaming import ledger

KEY = ["icao24", "time_position"]
# What names a rejected report: all its columns.
REJECT = "reject_id"


def writer_of(checkpoint: str) -> str:
    """The name under which a query's batches stand in the ledger: its checkpoint's."""
    return hashlib.md5(checkpoint.encode()).hexdigest()


def _append(rows: DataFrame, dates: DataFrame, path: str, main: str, key: list[str], attempt: str) -> None:
    """Add `rows` whose key no visible row of their `dates` has, numbered by the attempt.

    `dates` has a `partition_date` for each of `rows` at least; it needs neither their order nor their repeats gone.
    """
    spark = rows.sparkSession
    if tables.exists(spark, path):
        # A list of dates: one per day the batch touches.
        days = [row[0] for row in dates.select("partition_date").distinct().collect()]
        known = spark.read.parquet(path).filter(F.col("partition_date").isin(days))
        rows = rows.join(ledger.visible(known, main).select(*key), key, "left_anti")
    numbered = ledger.stamped(rows, attempt)
    tables.balanced(numbered, "partition_date").write.mode("append").partitionBy("partition_date").parquet(path)


def add_kept(batch: DataFrame, path: str, as_of: str | Column, tie_break: list[str] | None, attempt: str) -> None:
    """The batch's valid reports, one a key, that the table does not have; unseen until the attempt is committed."""
    valid = clean.normalise(batch).filter(clean.passes(as_of))
    dates = clean.with_partition_date(clean.to_event_time(valid))
    _append(clean.to_silver(batch, as_of, tie_break), dates, path, path, KEY, attempt)


def add_rejected(batch: DataFrame, rejects: str, path: str, as_of: str | Column, attempt: str) -> None:
    """The batch's rejected reports, each once; unseen until the attempt is committed."""
    bad = clean.validate(clean.normalise(batch), as_of)[1]
    whole = F.struct(*[F.col(name) for name in sorted(bad.columns)])
    named = bad.withColumns({REJECT: F.sha2(F.to_json(whole), 256), "partition_date": F.to_date("processed_at")})
    _append(named.dropDuplicates([REJECT]), named, rejects, path, [REJECT], attempt)


def add_batch(
    batch: DataFrame,
    path: str,
    as_of: str | Column,
    tie_break: list[str] | None = None,
    rejects: str | None = None,
    writer: str | None = None,
    number: int | None = None,
) -> None:
    """Add the batch's new reports to their dates, and its rejected ones to the table `rejects`, or neither.

    Rows carry the number of this attempt, and readers see them once the ledger names it, after both tables
    are written. What a failed attempt left is never seen, and a batch that has finished is skipped when it comes
    again. Repeats are dropped within the batch and against the visible rows, of which only the key columns of the
    dates concerned are read; so another checkpoint or query adds only what is not there yet, rejects included.
    """
    spark = batch.sparkSession
    if writer is not None and ledger.is_finished(spark, path, writer, number):
        return
    attempt = uuid.uuid4().hex
    batch.persist()  # read for the dates, for the rows and for the rejects
    try:
        add_kept(batch, path, as_of, tie_break, attempt)
        if rejects:
            add_rejected(batch, rejects, path, as_of, attempt)
    finally:
        batch.unpersist()
    ledger.commit(spark, path, attempt, writer, number)


def silver_stream(
    raw: DataFrame,
    path: str,
    checkpoint: str,
    as_of: str | Column | None = None,
    interval: str | None = None,
    tie_break: list[str] | None = None,
    rejects: str | None = None,
) -> StreamingQuery:
    """Keep the silver table up to date; with no `interval`, take what is there and stop.

    Reports are judged at the time when each came in, `processed_at`, unless `as_of` fixes one.
    """
    clock = F.col("processed_at") if as_of is None else as_of
    writer = raw.writeStream.foreachBatch(
        lambda batch, number: add_batch(batch, path, clock, tie_break, rejects, writer_of(checkpoint), number)
    ).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def compact(spark: SparkSession, path: str, dates: list[str]) -> None:
    """Write the files of `dates` anew, few and large: a stream adds some with every batch.

    What failed attempts left there goes. To be run between the stream's batches.
    """
    wanted = [F.lit(day).cast("date") for day in dates]
    rows = ledger.visible(spark.read.parquet(path).filter(F.col("partition_date").isin(*wanted)), path)
    tables.rewrite(spark, ledger.stamped(rows, None), path)


def replay(
    read_bronze: Callable[[], DataFrame],
    path: str,
    dates: list[str],
    as_of: str | Column,
    tie_break: list[str] | None = None,
) -> None:
    """`tables.replay` for a table that a stream adds to."""
    tables.write_silver(ledger.stamped(tables.rebuilt(read_bronze(), dates, as_of, tie_break), None), path)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """The rows of finished batches."""
    return ledger.visible(spark.read.parquet(path), path)


def read_rejects(spark: SparkSession, rejects: str, path: str) -> DataFrame:
    """The rejected reports of finished batches of the table at `path`."""
    return ledger.visible(spark.read.parquet(rejects), path).drop(REJECT)
