"""Scale guards over the final plan of every registered query."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF001
from wayfare.plans.inspect import final_plan

from wayfare.plans import QUERIES

NAMES = sorted(QUERIES)
PAIR_OUTPUT = {"two_leg_pairs", "two_leg_year_2007_rows"}


@pytest.fixture(scope="module")
def plans(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        yield {name: final_plan(E.queries()[name](spark, SF001)) for name in NAMES}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", NAMES)
def test_no_quadratic_or_python_operators(plans, name):
    plan = plans[name]
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    python = any(k in plan for k in ("MapInArrow", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"))
    assert not python
    assert "RoundRobinPartitioning" not in plan


@pytest.mark.parametrize("name", NAMES)
def test_aggregates_have_partial_step(plans, name):
    """Every aggregate is pre-aggregated before its shuffle: partial functions
    appear, or (a pure DISTINCT, which Catalyst may reduce an unused
    aggregation to) the key-only aggregate runs on both sides of the exchange."""
    plan = plans[name]
    aggs = [l for l in plan.split("\n") if "Aggregate(" in l]
    if aggs:
        distinct_only = all("functions=[]" in l for l in aggs)
        assert "partial_" in plan or (distinct_only and len(aggs) >= 2)


@pytest.mark.parametrize("name", NAMES)
def test_only_pair_outputs_join_flight_rows(plans, name):
    """Totals join pre-aggregated buckets; only the pair outputs join rows."""
    plan = plans[name]
    if "SortMergeJoin" in plan and name not in PAIR_OUTPUT:
        # the join inputs are aggregates (buckets), visible as an aggregate
        # below each side of the join
        assert plan.count("HashAggregate") >= 2
