"""Every query against its SQL equivalent, and every plan against the scale rules."""

import pytest

import workloads
from tools.check import compare, connect

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(workloads.QUERIES))
def test_query(spark, con, sf, name):
    df = workloads.QUERIES[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [w for w in FORBIDDEN if w in plan]
    problem, rows = compare(con, spark, name, lambda *_: df, workloads.ORACLES.get(name), sf)
    assert problem is None, problem
    assert rows >= 0


def test_entry_and_names(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["domain", "slug", "touched_at"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_pushdown(spark, sf):
    """The lookback reaches the unit scan."""
    plan = workloads.QUERIES["patch_targets"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan
    assert "WindowGroupLimit" in plan
