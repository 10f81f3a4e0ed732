"""Plan assertions: pushdown, pruning, no cartesian products for equi-joins, no row-at-a-time UDFs."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_pushdown_pruning_topk(spark):
    df = entry.entry(spark)
    plan = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double>" in plan
    assert "TakeOrderedAndProject" in plan
    assert "partial_sum" in plan
    assert df.count() == 3


@pytest.mark.parametrize("name", [n for n in entry.queries() if n != "join_cross"])
def test_no_cartesian_product_or_row_udf(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    plan = plan_text(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
    assert "BatchEvalPython" not in plan, name


@pytest.mark.parametrize("name", ["apply_changes", "partial_update", "kpi_match", "kpi_upsert", "role_delta",
                                  "role_assign", "dataset_get_or_create", "create_conflicts", "update_body",
                                  "insight_revenue_by_segment", "having_sum", "pivot_status"])
def test_grouping_is_partial_before_the_shuffle(spark, name):
    """Operators that reduce by key aggregate map-side first, so a key holding a third of all
    rows is reduced before the exchange instead of landing whole in one task."""
    plan = plan_text(entry.queries()[name](spark, SF_SMALL))
    assert "partial_" in plan, name


def test_top_k_per_group_limits_before_the_shuffle(spark):
    plan = plan_text(entry.queries()["sql_window"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan and "Partial" in plan
