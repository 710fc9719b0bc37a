"""Snapshot messages: one JSON object that holds an array of positional state arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.operators.clean import filter_min_fields
from contrail.schema import MESSAGE, MIN_STATE_FIELDS, STATE_POSITIONS

SNAPSHOT = "time LONG, states ARRAY<ARRAY<STRING>>"


def explode_states(df: DataFrame, json_col: str = "value", min_fields: int = MIN_STATE_FIELDS) -> DataFrame:
    """One typed row per state; short arrays are dropped, absent fields are null."""
    states = df.select(F.explode(F.from_json(json_col, SNAPSHOT)["states"]).alias("state"))
    kept = filter_min_fields(states, "state", min_fields)
    rows = kept.select(
        *[
            F.get("state", F.lit(STATE_POSITIONS[field.name]))
            .try_cast(field.dataType)
            .alias(field.name)
            for field in MESSAGE
        ]
    )
    return rows.withColumn("callsign", F.nullif(F.trim("callsign"), F.lit("")))


def state_array(columns: dict[str, Column]) -> Column:
    """Pack named columns into one state array of text, for building snapshots."""
    by_position = {STATE_POSITIONS[name]: column for name, column in columns.items()}
    blank = F.lit(None).cast("string")
    return F.array(
        *[by_position[i].cast("string") if i in by_position else blank for i in range(15)]
    )


def pack_snapshots(df: DataFrame) -> DataFrame:
    """Snapshot JSON from flat reports, one state and one stub array a message.

    The inverse of `explode_states`; no grouping, so no message grows with the data.
    """
    state = state_array({field.name: F.col(field.name) for field in MESSAGE})
    stub = F.array(F.col("icao24"))
    snapshot = F.struct(F.col("time_position").alias("time"), F.array(state, stub).alias("states"))
    return df.select(F.to_json(snapshot).alias("value"))
