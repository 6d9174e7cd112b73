"""Hot keys: one group / key holding a third of all rows is split across tasks.

Skew thresholds are lowered so AQE's skew-join split triggers on test-sized
data; the final adaptive plan must show a skew-split sort-merge join and the
results must equal the unsplit computation.
"""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tessera.functions import status as st
from tessera.operators.joins import left_join_split, null_safe_join
from tessera.operators.rules import with_group_values
from tessera.plans import legacy, live
from tessera.sources.fixtures import FIXTURES
from tests.conftest import settings

SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "8",
}


def skew_conf(spark):
    return settings(spark, SKEW_CONF)


def _final_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def hot_products(spark):
    n = 120_000
    i = F.col("id")
    return spark.range(n).select(
        # a third of all rows belong to engagement 0, in one group
        F.when(i % 3 == 0, F.lit(0)).otherwise(i % 5000).cast("long").alias("gid"),
        F.lit("BP").alias("resource_package"),
        F.lit("NT").alias("bible_book_ref"),
        F.lit("MAT").alias("scriptural_association"),
        F.when(i % 7 == 0, "Planned").otherwise("Completed").alias("product_status"),
        i.alias("row_id"),
    )


def test_hot_group_is_split(spark, hot_products):
    keys = ["gid", "resource_package", "bible_book_ref"]
    with skew_conf(spark):
        out = with_group_values(hot_products, keys, st.live_group_values(), "aggregate").select(
            "row_id", "BP_num", first_status()
        )
        got = {r.row_id: (r.BP_num, r.s) for r in out.collect()}
        plan = _final_plan(out)
    assert "SortMergeJoin(skew=true)" in plan
    ref = with_group_values(hot_products, keys, st.live_group_values(), "window").select(
        "row_id", "BP_num", first_status()
    )
    assert got == {r.row_id: (r.BP_num, r.s) for r in ref.collect()}
    assert got[0][0] >= 40_000


def first_status():
    from tessera.operators.rules import first_match

    return first_match(st.live_rules()).alias("s")


def test_hot_null_key_is_split(spark):
    i = F.col("id")
    left = spark.range(90_000).select(
        F.when(i % 3 == 0, F.lit(None)).otherwise(i % 3000).cast("long").alias("k"), i.alias("v")
    )
    right = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w")).union(
        spark.createDataFrame([(None, -1)], "k long, w long")
    )
    with skew_conf(spark):
        out = null_safe_join(left, right, "k", "inner")
        n = len(out.collect())
        plan = _final_plan(out)
    assert n == 90_000
    assert "SortMergeJoin(skew=true)" in plan


def test_hot_key_on_right_of_goal_join_is_split(spark):
    """A goal language covered by a third of all engagements."""
    i = F.col("id")
    goals = spark.range(2000).select(F.concat(F.lit("i"), F.col("id").cast("string")).alias("lc"))
    engagements = spark.range(90_000).select(
        F.concat(F.lit("i"), F.when(i % 3 == 0, F.lit(0)).otherwise(i % 4000).cast("string")).alias("iso"),
        i.alias("eid"),
    )
    with skew_conf(spark):
        out = left_join_split(goals, engagements, {"lc": "iso"})
        rows = out.collect()
        plan = _final_plan(out)
    plain = null_safe_join(goals, engagements, {"lc": "iso"}, "left")
    assert sorted((r.lc, r.eid or -1) for r in rows) == sorted((r.lc, r.eid or -1) for r in plain.collect())
    assert "SortMergeJoin(skew=true)" in plan


def test_hot_group_is_split_with_nullable_keys(spark):
    """Same as above with several non-constant, partly NULL group keys (as in the flagship)."""
    i = F.col("id")
    df = spark.range(120_000).select(
        F.when(i % 3 == 0, F.lit(0)).otherwise(i % 5000).cast("long").alias("gid"),
        F.when(i % 3 == 0, F.lit("BP")).otherwise(F.when(i % 2 == 0, "OBS").otherwise("EJ")).alias(
            "resource_package"
        ),
        F.when(i % 3 == 0, F.lit("NT"))
        .otherwise(F.when(i % 5 == 0, F.lit(None)).otherwise("OT"))
        .alias("bible_book_ref"),
        F.when(i % 3 == 0, F.lit("Draft"))
        .otherwise(F.when(i % 7 == 0, F.lit(None)).otherwise("X"))
        .alias("scripture_text_name"),
        F.lit("MAT").alias("scriptural_association"),
        F.when(i % 7 == 0, "Planned").otherwise("Completed").alias("product_status"),
        i.alias("row_id"),
    )
    keys = ["gid", "resource_package", "bible_book_ref", "scripture_text_name"]
    with skew_conf(spark):
        out = with_group_values(df, keys, st.live_group_values(), "aggregate").select(
            "row_id", "BP_num", first_status()
        )
        got = {r.row_id: (r.BP_num, r.s) for r in out.collect()}
        plan = _final_plan(out)
    assert "SortMergeJoin(skew=true)" in plan
    ref = with_group_values(df, keys, st.live_group_values(), "window").select(
        "row_id", "BP_num", first_status()
    )
    assert got == {r.row_id: (r.BP_num, r.s) for r in ref.collect()}


@pytest.fixture(scope="module")
def hot_tables(spark, small_tables):
    """A third of 300,000 products belong to one engagement; products come from 16 tasks."""
    tables = {name: small_tables[name] for name in FIXTURES}
    i = F.col("id")
    ids = sorted(r[0] for r in live.engagement_dimension(small_tables).select("language_engagement_id").collect())
    hot, others = F.lit(ids[0]), F.lit(ids[1:])[(i % (len(ids) - 1)).cast("int")]
    tables["uw_translation_products"] = spark.range(0, 300_000, 1, 16).select(
        F.when(i % 3 == 0, hot).otherwise(others).alias("language_engagement_id"),
        i.alias("l_orderkey"),
        (i % 7).cast("int").alias("l_linenumber"),
        i.alias("l_partkey"),
        i.alias("l_suppkey"),
        F.when(i % 3 == 0, "BP").when(i % 5 == 0, "OBS").otherwise("EJ").alias("resource_package"),
        F.lit("Text").alias("resource_format"),
        F.concat(F.lit("BK"), (F.when(i % 3 == 0, F.lit(40)).otherwise(i % 60)).cast("string")).alias(
            "scriptural_association"
        ),
        F.lit(None).cast("string").alias("scripture_text_name"),
        F.when(i % 11 == 0, "Planned").otherwise("Completed").alias("product_status"),
    )
    return tables


@pytest.mark.parametrize("flow", ["live", "legacy"])
def test_hot_engagement_is_split_in_the_flow(spark, hot_tables, flow):
    build = live.project_status if flow == "live" else legacy.legacy_project_status
    digest = lambda df: df.groupBy("l_orderkey", "BP_num", "project_status").count()
    with skew_conf(spark):
        out = build(hot_tables)
        rows = digest(out).collect()
        out._jdf.queryExecution().toRdd().count()
        plan = _final_plan(out)
    assert "SortMergeJoin(skew=true)" in plan
    window = digest(build(hot_tables, method="window")).collect()
    assert sorted(map(str, rows)) == sorted(map(str, window))


def test_hot_engagement_rollup_moves_no_products(spark, hot_tables):
    """Classes of a hot engagement are counts: the rollup needs no split."""
    with skew_conf(spark):
        out = live.engagement_status(live.status_classes(hot_tables))
        rows = out.collect()
    ref = live.engagement_status(live.project_status(hot_tables))
    assert sorted(map(str, rows)) == sorted(map(str, ref.collect()))
