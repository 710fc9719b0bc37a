"""Named queries over a data folder, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.session import prepare
from contrail.sources import testbed


@dataclass
class Inputs:
    """The frames a query may start from."""

    spark: SparkSession
    sf_dir: str

    as_of = testbed.AS_OF
    # The data is sparse, so "live" means the last day and not the last quarter of an hour.
    minutes = 1440

    @cached_property
    def events(self) -> DataFrame:
        return testbed.read_events(self.spark, self.sf_dir)

    @cached_property
    def raw(self) -> DataFrame:
        return testbed.raw_positions(self.spark, self.sf_dir)

    @cached_property
    def silver(self) -> DataFrame:
        return testbed.silver_positions(self.spark, self.sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, so results compare across engines."""
    patterns = {T.DateType: "yyyy-MM-dd", T.TimestampType: "yyyy-MM-dd HH:mm:ss.SSSSSS"}
    casts = {
        field.name: F.date_format(field.name, patterns[type(field.dataType)])
        for field in df.schema
        if type(field.dataType) in patterns
    }
    return df.withColumns(casts) if casts else df


def query(name: str, sql: str | None = None):
    """Register a function of `Inputs` under `name`."""

    def register(build: Callable[[Inputs], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(build(Inputs(prepare(spark), sf_dir)))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return build

    return register
