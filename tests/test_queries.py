"""Every named query against its SQL on the smallest data set, and the shape of its plan."""

import pytest
from compare import connect, difference

import __spark_entry__ as entry
from contrail.plans import catalog

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, duck, name):
    frame = entry.queries()[name](spark, SF_DIR)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan
    assert difference(frame, duck, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_known_counts(spark):
    """Figures of the derived data that were computed independently of this code."""
    from contrail.sources import testbed

    raw = testbed.raw_positions(spark, SF_DIR)
    assert raw.count() == 1050
    assert raw.select("icao24", "time_position").distinct().count() == 1000
    kept = testbed.silver_positions(spark, SF_DIR)
    assert kept.count() == 986
    assert kept.select("icao24").distinct().count() == 15
