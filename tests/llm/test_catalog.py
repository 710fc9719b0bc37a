"""Every query with SQL against DuckDB on the smallest data set, and the helper for running sums."""

import random

import pytest
from compare import connect, difference
from pyspark.sql import functions as F

import __spark_entry__ as entry
from contrail.llm import catalog, common

SF_DIR = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in catalog.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(catalog.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(catalog.SQL) <= set(catalog.QUERIES)


@pytest.mark.parametrize("name", list(catalog.SQL))
def test_query(spark, name):
    assert difference(catalog.QUERIES[name](spark, SF_DIR), connect(SF_DIR), catalog.SQL[name]) is None


def test_running_sums(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(50), rng.randrange(5)) for _ in range(800)]
    rows += [("hot", i, 1) for i in range(900)]
    frame = spark.createDataFrame(rows, "g string, k int, n int").repartition(7)
    got = common.running(frame, ["g"], ["k", "n"], {"place": F.lit(1), "sum": F.col("n")})
    want, last = [], {}
    for g, k, n in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        place, total = last.get(g, (0, 0))
        want.append((g, k, n, place, total))
        last[g] = place + 1, total + n
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    whole = common.running(frame, [], ["g", "k", "n"], {"place": F.lit(1)})
    assert sorted(r.place for r in whole.collect()) == list(range(len(rows)))
    assert common.running(frame.limit(0), ["g"], ["k"], {"place": F.lit(1)}).count() == 0
