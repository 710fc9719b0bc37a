"""File sources: JSON lines, JSON documents, tables, and times taken from paths."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.operators import clean
from contrail.schema import MESSAGE

# Fixed value: date path of a raw file.
PATH_TIME = r"(\d{4}/\d{2}/\d{2}/\d{6})"


def json_files(spark: SparkSession, schema: T.StructType = MESSAGE, glob: str = "*.json"):
    """Reader for every `.json` file below a prefix, at any depth; other files are skipped."""
    return (
        spark.read.schema(schema)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
    )


def read_ndjson(spark: SparkSession, path: str | list[str], schema: T.StructType = MESSAGE) -> DataFrame:
    """Newline-delimited JSON; blank lines are skipped and large files are split."""
    return json_files(spark, schema).json(path)


def read_json_documents(
    spark: SparkSession, path: str | list[str], schema: T.StructType = MESSAGE, glob: str = "*.json"
) -> DataFrame:
    """Files that hold one object or an array of objects each."""
    return json_files(spark, schema, glob).option("multiLine", "true").json(path)


def read_tolerant(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = MESSAGE,
    documents: bool = False,
    glob: str = "*.json",
) -> tuple[DataFrame, DataFrame]:
    """(good rows, errors per file): a bad file or line does not stop the rest.

    `documents` reads a file as one object or array, otherwise each line is a message. A file that
    isn't empty and of which nothing can be read counts as one error.
    """
    found = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    file = F.col("_metadata.file_path").alias("file")
    lines = (
        found.option("wholetext", str(documents).lower())
        .option("ignoreCorruptFiles", "true")
        .text(path)
        .select("value", file)
    )
    text = lines.filter(F.trim("value") != "")
    # The listing alone: no content is read.
    listed = found.format("binaryFile").load(path).filter("length > 0").select(file)
    silent = listed.join(lines.select("file").distinct(), "file", "left_anti")
    if documents:
        parsed = text.withColumn("rows", F.from_json("value", T.ArrayType(schema)))
        good = parsed.select("file", F.inline("rows")).drop("file")
        bad = parsed.filter(F.col("rows").isNull())
    else:
        corrupt = "_corrupt"
        wide = T.StructType(schema.fields + [T.StructField(corrupt, T.StringType())])
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
        parsed = text.withColumn("row", F.from_json("value", wide, options))
        broken = F.col("row").isNull() | F.col(f"row.{corrupt}").isNotNull()
        good = parsed.filter(~broken).select("row.*").drop(corrupt)
        bad = parsed.filter(broken)
    errors = bad.select("file").union(silent).groupBy("file").agg(F.count(F.lit(1)).alias("errors"))
    return good, errors


# What `streaming.bronze.land` writes.
LANDED = "value string, origin string, position long, landed_at timestamp, ingest_date date"


def read_landed(
    spark: SparkSession,
    path: str,
    first: str | None = None,
    last: str | None = None,
    schema: T.StructType = MESSAGE,
    arrivals: list[date] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(reports, dead letters) of messages that `streaming.bronze.land` wrote.

    `first` and `last` are arrival dates, `arrivals` a list of them; no other folders are read. Which arrival
    dates hold a day's reports `streaming.arrivals` knows. A report's `processed_at` is the time when it was landed.
    """
    rows = spark.read.schema(LANDED).json(path)
    if arrivals is not None:
        rows = rows.filter(F.col("ingest_date").isin(*[F.lit(day) for day in arrivals]) if arrivals else F.lit(False))
    if first:
        rows = rows.filter(F.col("ingest_date") >= F.lit(first).cast("date"))
    if last:
        rows = rows.filter(F.col("ingest_date") <= F.lit(last).cast("date"))
    return clean.route_dead_letters(rows, F.col("landed_at"), schema=schema)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Columnar table scan; `fmt` may name any table format on the classpath."""
    return spark.read.format(fmt).load(path)


def path_timestamp(column: Column | str, as_of: str) -> Column:
    """Time in a path like `2024/01/15/143000_batch.json`, else `as_of`."""
    column = F.col(column) if isinstance(column, str) else column
    found = F.nullif(F.regexp_extract(column, PATH_TIME, 1), F.lit(""))
    return F.coalesce(
        F.try_to_timestamp(found, F.lit("yyyy/MM/dd/HHmmss")), F.lit(as_of).cast("timestamp")
    )
