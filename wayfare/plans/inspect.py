"""Read the physical plan Spark actually ran (after adaptive re-planning)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def final_plan(df: DataFrame, run: bool = True) -> str:
    """The executed plan of ``df``'s own query execution. With ``run`` the
    plan is executed first so adaptive decisions (exchange reuse, skew
    splits, coalescing) are final; only the "Final Plan" part is returned."""
    qe = df._jdf.queryExecution()
    if run:
        qe.toRdd().count()
    plan = qe.executedPlan().toString()
    if "== Final Plan ==" in plan:
        plan = plan.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    return plan


def plan_summary(plan: str) -> dict[str, str]:
    """Scans, exchanges, joins, partial aggregates, windows, Python nodes and
    pushed / partition filters of a plan string."""
    scans = re.findall(r"FileScan (\w+)", plan)
    ex = []
    for full, keys in re.findall(
            r"(?<!Reused)Exchange (hashpartitioning\(([^)]*)\)|SinglePartition|"
            r"RoundRobinPartitioning\(\d+\)|rangepartitioning)", plan):
        if keys:
            cols = [re.sub(r"#\d+L?", "", k.strip()) for k in keys.split(",")[:-1]]
            ex.append("hash(" + ",".join(cols) + ")")
        else:
            ex.append(full.split("(")[0])
    joins = re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|"
                       r"BroadcastNestedLoopJoin|CartesianProduct)", plan)
    pf = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plan)
    reused = plan.count("ReusedExchange")
    python = sorted(set(re.findall(
        r"(MapInArrow|MapInPandas|ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas)", plan)))
    return {
        "scans": str(len(scans)) + (f" (+{reused} reused)" if reused else ""),
        "exchanges": ", ".join(ex) or "-",
        "joins": ", ".join(joins) or "-",
        "partial agg": "yes" if "partial_" in plan else "-",
        "window": "yes" if "Window" in plan else "-",
        "python": ", ".join(python) or "-",
        "partition filters": "; ".join(re.sub(r"#\d+", "", p) for p in pf if p) or "-",
        "pushed": "; ".join(sorted(set(re.sub(r"#\d+", "", p) for p in pushed if p)))[:90] or "-",
    }
