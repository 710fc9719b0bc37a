"""Quality figures of a feed, for a batch or a stream.

`as_of` is a time for a batch; for a stream it is a column, such as `processed_at`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from contrail.operators import clean

# Lag bands in seconds.
YELLOW_LAG = 10
RED_LAG = 30


def _lag() -> Column:
    return F.unix_timestamp("processed_at") - F.col("time_position")


def _figures(as_of: str | Column) -> list[Column]:
    bad = clean.failures(as_of)
    passed = ~F.greatest(*bad.values())
    return [
        F.count(F.lit(1)).alias("fetched"),
        F.count_if(passed).alias("sent"),
        *[F.count_if(condition).alias(f"error_{name}") for name, condition in bad.items()],
        F.max(_lag()).alias("lag_seconds"),
    ]


def lag_band(lag: Column) -> Column:
    return (
        F.when(lag >= RED_LAG, F.lit("red")).when(lag >= YELLOW_LAG, F.lit("yellow")).otherwise(F.lit("green"))
    )


def quality_metrics(raw: DataFrame, as_of: str | Column) -> DataFrame:
    """One row: reports fetched, sent on, errors per rule, highest lag and its band."""
    return clean.normalise(raw).agg(*_figures(as_of)).withColumn("lag_band", lag_band(F.col("lag_seconds")))


def observe_quality(raw: DataFrame, as_of: str | Column, name: str = "quality") -> tuple[DataFrame, str]:
    """The frame with the same figures attached; a streaming query reports them with every
    batch in `query.lastProgress.observedMetrics[name]`."""
    watched = clean.normalise(raw).observe(name, *_figures(as_of))
    return watched, name


def observe_batch(raw: DataFrame, as_of: str | Column, name: str = "quality") -> tuple[DataFrame, Observation]:
    watch = Observation(name)
    return clean.normalise(raw).observe(watch, *_figures(as_of)), watch


def reject_rate(raw: DataFrame, as_of: str | Column, minutes: int = 5, lateness: str | None = None) -> DataFrame:
    """Rejects per second and reason over tumbling windows of event time.

    Give `lateness` for a stream, so that finished windows can be written out.
    """
    timed = clean.to_event_time(clean.normalise(raw))
    if lateness:
        timed = timed.withWatermark("event_time", lateness)
    reasons = clean.with_reasons(timed, as_of).select("event_time", F.explode("reasons").alias("reason"))
    return (
        reasons.groupBy(F.window("event_time", f"{minutes} minutes").alias("w"), "reason")
        .agg(F.count(F.lit(1)).alias("rejects"))
        .select(
            F.col("w.start").alias("window_start"),
            "reason",
            "rejects",
            (F.col("rejects") / F.lit(minutes * 60.0)).alias("per_second"),
        )
    )


class QualityListener(StreamingQueryListener):
    """Appends the figures that `observe_quality` attached to a stream to the table at `path`, a row per batch."""

    def __init__(self, spark: SparkSession, path: str, name: str = "quality"):
        self.spark, self.path, self.name = spark, path, name

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(self.name)
        if seen is None:
            return
        figures = seen.asDict()
        schema = ", ".join(["query string", "batch long", "at string", *[f"{name} long" for name in figures]])
        row = (str(progress.id), progress.batchId, progress.timestamp, *figures.values())
        self.spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(self.path)


def batch_figures(spark: SparkSession, path: str) -> DataFrame:
    """What a `QualityListener` has written, one row per query and batch; a batch that was told of twice counts once."""
    return spark.read.parquet(path).dropDuplicates(["query", "batch"])


def summed(figures: DataFrame) -> DataFrame:
    """Figures of all batches together, in the columns of `quality_metrics`."""
    counts = [name for name in figures.columns if name not in ("query", "batch", "at", "lag_seconds")]
    totals = figures.agg(*[F.sum(name).alias(name) for name in counts], F.max("lag_seconds").alias("lag_seconds"))
    return totals.withColumn("lag_band", lag_band(F.col("lag_seconds")))
