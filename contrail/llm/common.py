"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contrail.session import prepare, scratch
from contrail.sinks.tables import remove

# A word, for sizes and shingles: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


# Rows and bytes that Spark hands to a Python worker at a time. Texts and sets are long, and
# a worker holds a batch several times over.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def bounded(spark: SparkSession) -> SparkSession:
    """Set the sizes of batches, where the session has others."""
    for key, value in BATCHES.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bounded(prepare(spark)).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read back.

    Cuts the lineage: a lost executor costs no more than the tasks it was running.
    """
    bounded(df.sparkSession)
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(kept: DataFrame, *read: DataFrame) -> DataFrame:
    """`kept`, after the files of `read` (results of `stored`) are removed: nothing that is still to run may need them."""
    for frame in read:
        for file in {os.path.dirname(name) for name in frame.inputFiles()}:
            remove(frame.sparkSession, file)
    return kept


def fresh(df: DataFrame, name: str) -> str:
    """A column name that `df` doesn't have."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def code_point_key(column: Column) -> Column:
    """Text that sorts like `column` by code point, nulls last, and is never null."""
    return F.when(column.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), column))


def running(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    totals: dict[str, Column],
    name: str = "running",
) -> DataFrame:
    """Adds, for each of `totals`, its sum over the rows before this one in its group.

    `order` must be total up to rows that are alike. No group is held whole: rows are
    range-partitioned, summed by partition, and each partition starts from the sums of those
    before it. Names starting with `_r_` are reserved.
    """
    keys = [F.col(c) for c in (*groups, *order)]
    ranged = stored(
        df.withColumns({f"_r_{k}": v for k, v in totals.items()})
        .repartitionByRange(*keys)
        .withColumn("_r_part", F.spark_partition_id()),
        name,
    )
    by_part = Window.partitionBy(*groups).orderBy("_r_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy(*groups, "_r_part").agg(*[F.sum(f"_r_{k}").alias(f"_r_{k}") for k in totals])
    starts = sums.select(
        *[F.col(g).alias(f"_r_g{i}") for i, g in enumerate(groups)],
        F.col("_r_part").alias("_r_of"),
        *[F.coalesce(F.sum(f"_r_{k}").over(by_part), F.lit(0)).alias(f"_r_start_{k}") for k in totals],
    )
    within = Window.partitionBy("_r_part", *groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    same = F.col("_r_part") == F.col("_r_of")
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"_r_g{i}"))
    out = ranged.withColumns(
        {f"_r_in_{k}": F.coalesce(F.sum(f"_r_{k}").over(within), F.lit(0)) for k in totals}
    ).join(starts, same)
    return out.select(*df.columns, *[(F.col(f"_r_start_{k}") + F.col(f"_r_in_{k}")).alias(k) for k in totals])
