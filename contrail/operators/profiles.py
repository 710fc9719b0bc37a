"""Table profiles: nulls, ranges, schema and a sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.functions.numeric import row_count


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows, nulls and whole percent of nulls per column, from one pass."""
    columns = columns or df.columns
    counts = df.agg(row_count().alias("_rows"), *[F.count(name).alias(name) for name in columns])
    return (
        counts.unpivot("_rows", columns, "column_name", "filled")
        .withColumn("nulls", F.col("_rows") - F.col("filled"))
        .select(
            "column_name",
            F.col("_rows").alias("total"),
            "nulls",
            F.expr("nulls * 100 div greatest(_rows, 1)").alias("percent"),
        )
    )


def range_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, lowest and highest value as text per time or date column."""
    kinds = {field.name: field.dataType for field in df.schema}

    def text(name: str, column):
        if isinstance(kinds[name], T.TimestampType):
            return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        return column.cast("string")

    bounds = df.agg(
        row_count().alias("rows"),
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                text(name, F.min(name)).alias("min_value"),
                text(name, F.max(name)).alias("max_value"),
            ).alias(name)
            for name in columns
        ],
    )
    return bounds.select("rows", F.inline(F.array(*columns)))


def schema_profile(df: DataFrame) -> DataFrame:
    """Position, name, type and filled rows of every column."""
    fields = [
        F.struct(
            F.lit(position).alias("ordinal"),
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("data_type"),
            F.count(field.name).alias("filled"),
        )
        for position, field in enumerate(df.schema, start=1)
    ]
    return df.agg(F.array(*fields).alias("fields")).select(F.inline("fields"))


def sample_text(df: DataFrame, columns: list[str], order: list[str], n: int = 5) -> DataFrame:
    """The first `n` rows in a fixed order, as text."""
    return df.orderBy(*order).limit(n).select(*[F.col(name).cast("string").alias(name) for name in columns])
