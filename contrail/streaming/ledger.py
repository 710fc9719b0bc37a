"""A ledger of finished batches, which decides what readers of a table see.

Rows carry the number of the attempt that wrote them, `commit_id`. An attempt counts once the ledger
beside the main table names it, so all tables that a batch writes to gain its rows at the same moment, or none
does. Rows without a number are always seen: those of a rewritten partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.sinks import tables

COMMIT = "commit_id"
SCHEMA = f"{COMMIT} string, writer string, batch long, committed_at timestamp"


def _path(path: str) -> str:
    return path.rstrip("/") + ".ledger"


def entries(spark: SparkSession, path: str) -> DataFrame:
    """Finished attempts: one small row per batch."""
    if not tables.exists(spark, _path(path)):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(_path(path))


def is_finished(spark: SparkSession, path: str, writer: str, batch: int) -> bool:
    done = (F.col("writer") == writer) & (F.col("batch") == batch)
    return not entries(spark, path).filter(done).isEmpty()


def commit(spark: SparkSession, path: str, attempt: str, writer: str | None = None, batch: int | None = None) -> None:
    """Name `attempt` as finished: one file of one row, which appears whole or not at all."""
    row = spark.createDataFrame([(attempt, writer, batch)], f"{COMMIT} string, writer string, batch long")
    row.withColumn("committed_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(_path(path))


def stamped(rows: DataFrame, attempt: str | Column | None) -> DataFrame:
    number = attempt if isinstance(attempt, Column) else F.lit(attempt)
    return rows.withColumn(COMMIT, number.cast("string"))


def visible(rows: DataFrame, path: str) -> DataFrame:
    """Those of `rows` whose attempt is finished, without its number. `path` is the table that the ledger stands beside.

    The ledger is joined in whatever way its size calls for: it has a row per batch, not per report.
    """
    done = entries(rows.sparkSession, path).select(COMMIT, F.lit(True).alias("_done"))
    return rows.join(done, COMMIT, "left").filter(F.col(COMMIT).isNull() | F.col("_done")).drop(COMMIT, "_done")
