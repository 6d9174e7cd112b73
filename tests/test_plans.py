"""Physical-plan shape: pruning, no nested loops or Python, partial aggregation."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from tessera.plans import live
from tessera.plans.queries import QUERIES
from tessera.sources.fixtures import FixtureTables
from tests.conftest import settings
from tests.plan_summary import final_plan, plan_nodes, run

SF_SMALL = "/root/testdata/sf0.001"


def _executed_plan(spark, name: str) -> str:
    df = entry.queries()[name](spark, SF_SMALL)
    run(df)
    return final_plan(df._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_nested_loops_or_python(spark, name):
    plan = _executed_plan(spark, name)
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert "EvalPython" not in plan


def test_product_scan_reads_only_needed_columns(spark):
    plan = _executed_plan(spark, "engagement_status")
    cols = re.findall(r"FileScan parquet \S*\[([^\]]*)\][^\n]*lineitem\.parquet", plan)
    assert cols, plan
    # lineitem has 11 columns; prices, tax and ship date feed nothing here
    for c in cols:
        for unused in ("l_extendedprice", "l_discount", "l_tax", "l_shipdate"):
            assert unused not in c, cols


def test_status_groups_are_partially_aggregated(spark):
    plan = _executed_plan(spark, "project_status")
    partial = [l for l in plan.splitlines() if "HashAggregate" in l and "partial_" in l]
    assert any("partial_min" in l and "partial_max" in l for l in partial), partial


def test_bounded_lookups_are_broadcast(spark):
    plan = _executed_plan(spark, "product_prep")
    # the section lookup is joined map-side into the product scan
    assert "BroadcastHashJoin" in plan


LARGE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


def _tables_read(plan: str, table: str) -> int:
    return len(re.findall(rf"FileScan parquet [^\n]*{table}\.parquet", plan))


def test_large_plan_reads_the_dimension_once(spark):
    """Products: one read for the groups and one for the rows; the dimension: one."""
    with settings(spark, LARGE):
        df = live.project_status(FixtureTables(spark, SF_SMALL))
        run(df)
        plan = final_plan(df._jdf.queryExecution().executedPlan().toString())
    assert _tables_read(plan, "customer") == 1
    assert _tables_read(plan, "lineitem") <= 2


def _shuffled_columns(spark, name: str) -> list[str]:
    """The output columns of every shuffle of the executed plan."""
    df = QUERIES[name](FixtureTables(spark, SF_SMALL))
    run(df)
    nodes = plan_nodes(df._jdf.queryExecution().executedPlan())
    return [n.output().mkString(",") for n in nodes if n.nodeName() == "Exchange"]


@pytest.mark.parametrize("name", ["status_presence", "engagement_status", "engagement_master", "legacy_engagement_master"])
def test_rollups_shuffle_products_only_through_partial_aggregates(spark, name):
    """No shuffle carries a product's line number; classes are counted before they are shuffled."""
    columns = _shuffled_columns(spark, name)
    assert columns and not [c for c in columns if "l_linenumber" in c]
    assert any("product_status" in c and "count#" in c for c in columns), columns


def test_product_rows_are_seen_in_shuffles(spark):
    """The test above can fail: the product output shuffles its rows."""
    assert [c for c in _shuffled_columns(spark, "project_status") if "l_linenumber" in c]


@pytest.mark.parametrize(
    "name, exchanges, products", [("legacy_engagement_master", 46, 1), ("group_by_display_name", 54, 2), ("legacy_project_status", 52, 2)]
)
def test_display_name_groups_read_products_and_dimension_once(spark, name, exchanges, products):
    with settings(spark, LARGE):
        df = QUERIES[name](FixtureTables(spark, SF_SMALL))
        run(df)
        nodes = [n.nodeName() for n in plan_nodes(df._jdf.queryExecution().executedPlan())]
        plan = final_plan(df._jdf.queryExecution().executedPlan().toString())
    assert nodes.count("Exchange") <= exchanges
    assert _tables_read(plan, "lineitem") <= products
    assert _tables_read(plan, "customer") == 1


def test_goal_coverage_computes_statuses_once(spark):
    """The anti join's side has no product scan under it."""
    with settings(spark, LARGE):
        df = QUERIES["goal_coverage"](FixtureTables(spark, SF_SMALL))
        run(df)
        nodes = list(plan_nodes(df._jdf.queryExecution().executedPlan()))
    anti = [n for n in nodes if "Join" in n.nodeName() and "LeftAnti" in n.toString().splitlines()[0]]
    assert anti
    for n in anti:
        assert "lineitem" not in n.toString()


def test_mixed_dates_are_generated_code(spark):
    """Both columns in one generated stage that compiles; nothing falls back to interpretation."""
    with settings(spark, {"spark.sql.codegen.fallback": "false"}):
        plan = _executed_plan(spark, "mixed_dates")
    projects = [l for l in plan.splitlines() if "Project" in l]
    assert projects and all("*(" in l for l in projects), plan
    assert "lambda" not in plan
