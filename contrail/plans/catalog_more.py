"""Further evidence: the other views, strict batches, schema drift, JSON documents, whole rows of tolerant reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail import schema as S
from contrail.operators import clean, tracks
from contrail.plans.base_sql import BASE, stamp
from contrail.plans.catalog_clean import MESSAGE
from contrail.plans.catalog_tracks import PLACED, POSITION, POSITION_SQL
from contrail.plans.registry import SQL, Inputs, query
from contrail.session import scratch
from contrail.sinks import tables
from contrail.sources import files

NUMBERED = T.StructType([T.StructField("event_id", T.LongType()), *S.MESSAGE.fields])
# Messages of one JSON document, at most.
DOCUMENT = 1000


def _view(name: str) -> Callable[[Inputs], DataFrame]:
    def run(p: Inputs) -> DataFrame:
        tables.create_views(p.spark, p.silver)
        return p.spark.table(name)

    return run


for _view_name, _like in {
    "stg_positions": "stg_positions",
    "fact_positions": "fact_positions",
    "dim_aircraft": "dim_aircraft",
    "dim_airlines": "dim_airlines",
    "hourly_flight_activity": "hourly_activity_by_date",
}.items():
    query(f"view_{_view_name}", SQL[_like])(_view(_view_name))


@query("flight_path_of", BASE + f"select {POSITION_SQL} from kept where {PLACED} and icao24 = '000001'")
def _(p: Inputs):
    return tracks.flight_path(p.silver, "000001").select(*POSITION)


def _verdict(check: Callable[[], DataFrame]) -> str:
    try:
        check()
    except (clean.BatchRejected, clean.SchemaDrift) as problem:
        return str(problem)
    return "passes"


@query("validate_strict", BASE + """
  select 'all' as batch, count(*) filter (bad) || ' of ' || count(*) || ' rows break a rule' as verdict from flagged
  union all select 'valid', case when count(*) > 0 then 'passes' end from valid
  union all select 'none', 'batch holds no rows'""")
def _(p: Inputs):
    raw = clean.normalise(p.raw)
    batches = {"all": raw, "valid": clean.validate(raw, p.as_of)[0], "none": raw.filter("event_id < 0")}
    told = [(name, _verdict(lambda: clean.validate_strict(batch, p.as_of))) for name, batch in batches.items()]
    return p.spark.createDataFrame(told, "batch string, verdict string")


@query("check_schema", BASE + """
  select 'raw' as frame, 'passes' as verdict, count(*) as rows from raw
  union all select 'drifted', 'icao24: missing; time_position: string, expected bigint', count(*) from raw""")
def _(p: Inputs):
    drifted = p.raw.drop("icao24").withColumn("time_position", F.col("time_position").cast("string"))
    frames = {"raw": p.raw, "drifted": drifted}
    told = [
        frame.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("frame"), F.lit(_verdict(lambda: clean.check_schema(frame))).alias("verdict"), "rows"
        )
        for name, frame in frames.items()
    ]
    return told[0].union(told[1])


@query("read_json_documents", BASE + f"select event_id, {MESSAGE} from raw")
def _(p: Inputs):
    """Files that hold an array of messages each."""
    path = scratch(p.spark, "documents")
    number = F.floor(F.col("event_id") / DOCUMENT).alias("document")
    messages = F.collect_list(F.struct("event_id", *S.MESSAGE.fieldNames()))  # of DOCUMENT events and their repeats
    documents = p.raw.groupBy(number).agg(F.to_json(messages, {"ignoreNullFields": "false"}).alias("value"))
    documents.repartition("document").write.partitionBy("document").text(path)
    return files.read_json_documents(p.spark, path, NUMBERED, glob="*.txt")


def _damaged(p: Inputs) -> DataFrame:
    """Messages as text; every hundredth is cut in half."""
    whole = F.to_json(F.struct("event_id", *S.MESSAGE.fieldNames()), {"ignoreNullFields": "false"})
    half: Column = F.substring(whole, F.lit(1), (F.length(whole) / 2).cast("int"))
    return p.raw.select(F.when(F.col("event_id") % 100 == 0, half).otherwise(whole).alias("value"))


@query("read_tolerant_rows", BASE + f"select event_id, {MESSAGE} from raw where event_id % 100 <> 0")
def _(p: Inputs):
    path = scratch(p.spark, "damaged")
    _damaged(p).write.text(path, lineSep="\n")
    return files.read_tolerant(p.spark, path, NUMBERED, glob="*.txt")[0]


@query("dead_letter_rows", BASE + f"""
  select case when event_id % 100 = 0 then 'Invalid JSON' end as error, event_id,
    case when event_id % 100 <> 0 then icao24 end as icao24, {stamp("timestamp '2024-01-31 00:00:00'", 'processed_at')} from raw""")
def _(p: Inputs):
    """Which messages went which way; the number of a broken one is read from its text."""
    good, dead = clean.route_dead_letters(_damaged(p), p.as_of, schema=NUMBERED)
    number = F.regexp_extract("original_message", '"event_id":([0-9]+)', 1).cast("long").alias("event_id")
    return good.select(F.lit(None).cast("string").alias("error"), "event_id", "icao24", "processed_at").union(
        dead.select("error", number, F.lit(None).cast("string"), "processed_at")
    )
