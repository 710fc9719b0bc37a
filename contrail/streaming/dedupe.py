"""De-duplication across micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.operators import clean


def _timed(df: DataFrame, lateness: str) -> DataFrame:
    timed = df if "event_time" in df.columns else clean.to_event_time(df)
    return timed.withWatermark("event_time", lateness)


def dedupe_stream(df: DataFrame, lateness: str = "5 seconds") -> DataFrame:
    """One report per aircraft and second, the first that comes. A key is remembered until the watermark is
    `lateness` past it; `sinks.tables.upsert_incremental` catches later repeats."""
    return _timed(df, lateness).dropDuplicatesWithinWatermark(["icao24", "time_position"])


def latest_stream(df: DataFrame, lateness: str = "5 seconds", order: tuple[str, ...] = ("processed_at",)) -> DataFrame:
    """One report per aircraft and second, the highest by `order`, whichever comes first.

    A key is held until the watermark has passed its second and then handed out once (append mode); a copy
    that comes later still is dropped. Of copies alike in `order` the other columns decide, nulls lowest, so the choice
    is the same in any order of arrival. The state has one report per open key, and copies of a batch are reduced
    before they are shuffled.
    """
    timed = _timed(df, lateness)
    rest = [name for name in timed.columns if name not in (*order, "event_time")]
    best = F.max(F.struct(*order, *rest)).alias("_best")
    held = timed.groupBy("event_time", F.col("icao24").alias("_key")).agg(best)
    return held.select("event_time", "_best.*").select(*timed.columns)
