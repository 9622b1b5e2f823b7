"""Every query agrees with its SQL, and no plan holds what would not scale."""

import pytest

import oracle
from catalog import ORACLE, QUERIES


@pytest.fixture(scope="module")
def duck(small):
    return oracle.connect(small)


#: Reports of violations of which the smallest tables hold none.
EMPTY_WHEN_SMALL = {"quality_unique"}


@pytest.mark.parametrize("name", QUERIES)
def test_agrees_with_sql_and_scales(spark, small, duck, name):
    df = QUERIES[name](spark, small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert operator not in plan, f"{operator} in the plan of {name}"
    # a whole table in one task: allowed only for the single row of a total
    assert plan.count("SinglePartition") == 0 or "HashAggregate(keys=[]" in plan or "SortAggregate(key=[]" in plan
    problem = oracle.difference(spark, duck, small, name, df)
    assert problem is None or problem == "no rows" and name in EMPTY_WHEN_SMALL, problem


def test_bypass_feeds_are_read_once(spark, small):
    """Two feeds and two station tables: a scan each."""
    plan = QUERIES["survey_ybfmp"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 4


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())
