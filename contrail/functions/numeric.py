"""Rounding and averaging that give the same answer for any partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_count() -> Column:
    return F.count(F.lit(1))


def exact_mean(column: Column | str, places: int = 6) -> Column:
    """Mean of a fractional column, summed as decimals so row order cannot matter."""
    column = F.col(column) if isinstance(column, str) else column
    return F.round(F.avg(column.cast("decimal(18,12)")), places).cast("double")


def half_away(column: Column, places: int = 0) -> Column:
    """SQL rounding: halves go away from zero."""
    return F.round(column, places)


def half_even(column: Column, places: int = 0) -> Column:
    """Data-frame rounding: halves go to the even neighbour."""
    return F.bround(column, places)


def half_up(column: Column) -> Column:
    """Script rounding: halves go up."""
    return F.floor(column + F.lit(0.5))


def equal_width_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Bin number 1..bins of right-closed bins over [low, high]; one bin if low = high."""
    position = F.ceil((value - low) * F.lit(bins) / F.nullif(high - low, F.lit(0.0)))
    return F.coalesce(F.greatest(F.least(position, F.lit(bins)), F.lit(1)), F.lit(1)).cast("int")
