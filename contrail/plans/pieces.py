"""Per-key windows that never hold a whole key in one task.

A plain `Window.partitionBy(key)` over raw rows puts every row of a key in one task,
so one busy key stalls the job. Here a key is cut into pieces (one calendar day).
After de-duplication on (key, whole second) a piece has at most 86,400 rows. What a
piece needs from its neighbours is carried by a summary with one row per (key, piece),
built with partial aggregation and joined back on (key, piece).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_previous(
    df: DataFrame,
    columns: Sequence[str],
    key: str = "icao24",
    order: str = "time_position",
    piece: str = "partition_date",
    totals: dict[str, Column] | None = None,
    tops: dict[str, str] | None = None,
) -> DataFrame:
    """Add `prev_<c>`, the value in the key's previous row, for each of `columns`.

    `order` must be unique within a key. `totals` adds whole-key totals: an additive
    aggregate per piece (a count or sum), summed over the pieces of the key. `tops` adds, under a
    new name, the key's maximum of a column over the rows that have a previous one.

    `df` is read once and its rows are shuffled once, for the windows and the summary alike, if the
    result's user needs all columns of `df`: hand in no others. Rows without key or piece go.
    """
    totals, tops = totals or {}, tops or {}
    shuffled = df.filter(F.col(key).isNotNull() & F.col(piece).isNotNull()).repartition(key, piece)
    counted = shuffled
    if tops:
        start = F.min(order).over(Window.partitionBy(key, piece))
        counted = shuffled.withColumn("_later", F.col(order) > start)
    summary = counted.groupBy(key, piece).agg(
        # Of all columns, so that this branch needs no fewer of them: Spark then uses one exchange for both.
        F.bit_xor(F.xxhash64(*df.columns)).alias("_seen"),
        *[F.max_by(name, order).alias(f"_last_{name}") for name in columns],
        *[column.alias(f"_sum_{name}") for name, column in totals.items()],
        *[F.max(column).alias(f"_top_{name}") for name, column in tops.items()],
        *[F.max(F.when(F.col("_later"), F.col(column))).alias(f"_later_{name}") for name, column in tops.items()],
    )
    seen = F.col("_seen").isNotNull()
    whole = Window.partitionBy(key)
    ordered = whole.orderBy(piece)
    carry = summary.select(
        "*",
        F.coalesce(F.lag(seen).over(ordered), F.lit(False)).alias("_has_carry"),
        *[F.lag(F.when(seen, F.col(f"_last_{name}"))).over(ordered).alias(f"_carry_{name}") for name in columns],
        *[F.sum(f"_sum_{name}").over(whole).alias(name) for name in totals],
    ).select(
        F.col(key),
        F.col(piece),
        "_has_carry",
        *[f"_carry_{name}" for name in columns],
        *totals,
        *[
            F.max(F.when(F.col("_has_carry"), F.col(f"_top_{name}")).otherwise(F.col(f"_later_{name}"))).over(whole).alias(name)
            for name in tops
        ],
    )
    within = Window.partitionBy(key, piece).orderBy(order)
    first = F.row_number().over(within) == 1
    joined = shuffled.join(carry, [key, piece])
    out = joined.withColumns(
        {
            f"prev_{name}": F.when(first, F.col(f"_carry_{name}")).otherwise(F.lag(name).over(within))
            for name in columns
        }
        | {"has_prev": F.when(first, F.col("_has_carry")).otherwise(F.lit(True))}
    )
    return out.drop("_has_carry", *[f"_carry_{name}" for name in columns])
