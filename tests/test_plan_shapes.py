"""Plan checks over every registered query: no row-at-a-time Python, no
Cartesian products or nested-loop joins, filters pushed where they should be."""

import pytest

import __spark_entry__ as E

from conftest import SF_SMALL

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("key", sorted(E.queries()))
def test_plan_has_no_forbidden_nodes(spark, key):
    plan = E.queries()[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    for node in FORBIDDEN:
        assert node not in plan, f"{key}: {node}"


def test_lookup_filters_reach_the_scan(spark):
    plan = E.queries()["lookup_keys"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(o_orderkey" in plan


def test_search_scans_each_table_once(spark):
    plan = E.queries()["search_all"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("documents.parquet") == 1 and plan.count("conversations.parquet") == 1
