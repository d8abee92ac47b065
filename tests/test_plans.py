"""Physical-plan checks on the registered queries: no cartesian products or
nested-loop joins, column pruning and filter pushdown at the scan."""

import pytest

import __spark_entry__ as E

QUERIES = E.queries()
SIDE_EFFECTS = {"o01_pipeline_table_counts", "a12_streaming_upsert"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SIDE_EFFECTS))
def test_no_cartesian_or_nested_loop(spark, sf_dir, name):
    p = plan_of(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in p, name
    assert "BroadcastNestedLoopJoin" not in p, name


def test_flagship_prunes_columns(spark, sf_dir):
    p = plan_of(QUERIES["e03_backlog_by_priority"](spark, sf_dir))
    assert "o_totalprice" not in p and "o_custkey" not in p
    assert p.count("Exchange") == 1  # one shuffle: partial + final aggregation


def test_filter_reaches_the_scan(spark, sf_dir):
    p = plan_of(QUERIES["b11_range_filter"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(o_orderdate), IsNotNull(o_totalprice), GreaterThanOrEqual(o_orderdate" in p
