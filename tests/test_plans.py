"""Plan properties: pruning and pushdown reach the scans; no Python evaluation,
no cartesian products; the report suite reuses the mart's exchanges."""

from __future__ import annotations

import pytest

from conftest import SMOKE_DIR
from tidepool.plans.queries import CORE_QUERIES as QUERIES

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_or_cartesian(spark, name):
    plan = plan_of(QUERIES[name](spark, SMOKE_DIR))
    assert not [f for f in FORBIDDEN if f in plan]


def test_mart_prunes_columns_and_null_keys(spark):
    plan = plan_of(QUERIES["customer_activity"](spark, SMOKE_DIR))
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_mktsegment:string>" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan
    assert "PushedFilters: [IsNotNull(user_id)]" in plan
    assert "PushedFilters: [IsNotNull(o_custkey)]" in plan


def test_segment_filter_reaches_scan(spark):
    plan = plan_of(QUERIES["card_lifetime_value_filtered"](spark, SMOKE_DIR))
    assert "EqualTo(c_mktsegment,FURNITURE)" in plan


def test_aggregation_is_partial_before_shuffle(spark):
    plan = plan_of(QUERIES["agg_orders_by_customer"](spark, SMOKE_DIR))
    assert "partial_count" in plan and "partial_sum" in plan
