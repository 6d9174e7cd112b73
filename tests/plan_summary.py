"""Summarize the physical plan of every registered query (run after execution,
so the adaptive plan is final): shuffles, broadcasts, join kinds, skew splits
and what each Parquet scan reads.

    python tests/plan_summary.py /root/testdata/sf0.1 > /tmp/plans.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def final_plan(plan: str) -> str:
    """The executed part of an adaptive plan string (drop the initial plan)."""
    # Only the outer markers start a line; plans nested in cached relations
    # carry their own, indented ones.
    if "\n+- == Final Plan ==" in plan:
        plan = plan.split("\n+- == Final Plan ==", 1)[1].split("\n+- == Initial Plan ==", 1)[0]
    return plan


STAGE_WRAPPERS = ("ShuffleQueryStage", "BroadcastQueryStage", "TableCacheQueryStage", "ResultQueryStage")


def plan_nodes(node):
    """Operators of an executed plan, through adaptive plans and query stages.

    Cached relations are not entered: they are computed once and appear as
    one ``InMemoryTableScan``.
    """
    name = node.nodeName()
    if name == "AdaptiveSparkPlan":
        yield from plan_nodes(node.finalPhysicalPlan())
        return
    if name in STAGE_WRAPPERS:
        yield from plan_nodes(node.plan())
        return
    yield node
    children = node.children()
    for i in range(children.size()):
        yield from plan_nodes(children.apply(i))


def run(df) -> None:
    """Execute the DataFrame's own query (finalizing its adaptive plan) without
    bringing rows to the driver."""
    df._jdf.queryExecution().toRdd().count()


def summarize(df) -> dict:
    nodes = list(plan_nodes(df._jdf.queryExecution().executedPlan()))
    names = [n.nodeName() for n in nodes]
    return {
        "shuffles": names.count("Exchange"),
        "reused_shuffles": sum(1 for n in nodes if n.nodeName() == "ReusedExchange"),
        "broadcasts": names.count("BroadcastExchange"),
        "broadcast_hash_joins": names.count("BroadcastHashJoin"),
        "sort_merge_joins": names.count("SortMergeJoin"),
        "partial_aggregates": sum(
            1
            for n in nodes
            if n.nodeName() in ("HashAggregate", "ObjectHashAggregate", "SortAggregate")
            and "partial_" in n.simpleString(100)
        ),
        "windows": names.count("Window"),
        "nested_loop_or_cartesian": names.count("BroadcastNestedLoopJoin") + names.count("CartesianProduct"),
        "python_udfs": names.count("BatchEvalPython") + names.count("ArrowEvalPython"),
        "cache_scans": names.count("InMemoryTableScan"),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    import __spark_entry__ as entry
    from tessera.session import build_session

    spark = build_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    print("| query | shuffles | reused | broadcasts | BHJ | SMJ | partial aggs | cache scans | windows | loops/cartesian | Python UDFs |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    scans = {}
    for name, build in entry.queries().items():
        df = build(spark, sf_dir)
        run(df)
        plan = final_plan(df._jdf.queryExecution().executedPlan().toString())
        s = summarize(df)
        print(
            f"| {name} | {s['shuffles']} | {s['reused_shuffles']} | {s['broadcasts']} | {s['broadcast_hash_joins']} | "
            f"{s['sort_merge_joins']} | {s['partial_aggregates']} | {s['cache_scans']} | {s['windows']} | "
            f"{s['nested_loop_or_cartesian']} | {s['python_udfs']} |"
        )
        for m in re.finditer(r"FileScan parquet \S*\[([^\]]*)\].*?Location: \S+\(\d+ paths\)\[file:[^\]]*/(\w+)\.parquet\]", plan):
            scans.setdefault(m.group(2), set()).add(m.group(1).count(",") + 1)
    print()
    print("Columns read per scan (by table):", {k: sorted(v) for k, v in sorted(scans.items())})


if __name__ == "__main__":
    main()
