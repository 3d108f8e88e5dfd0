"""Plan shape: no Python UDFs, pruned scans, no single-partition windows."""
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

SQL_QUERIES = sorted(set(E.oracle_sql()) - {"stream_score"})


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", SQL_QUERIES)
def test_no_python_udf(spark, name):
    p = _plan(E.queries()[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_scan_is_pruned(spark):
    p = _plan(E.queries()["column_moments"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double,l_discount:double,l_tax:double>" in p \
        or "l_orderkey" not in p


def test_exclusion_filter_pushed(spark):
    df = E.queries()["exclude_entities"](spark, SF_SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "Filter" in p


@pytest.mark.parametrize("name", ["stratified_split", "stratified_folds", "entity_risk_tier", "scenario_delta"])
def test_no_single_partition_window_on_rows(spark, name):
    p = _plan(E.queries()[name](spark, SF_SMALL))
    # the only un-partitioned windows allowed are over per-model tables
    assert "Window [row_number() windowspecdefinition(__h" not in p or "__b" in p
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_stats_applied_without_join(spark):
    p = _plan(E.queries()["stress_index"](spark, SF_SMALL))
    assert "Subquery" in p and "BroadcastNestedLoopJoin" not in p
