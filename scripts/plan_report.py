"""Summarise the executed (final adaptive) plan of every registered query.

usage: python scripts/plan_report.py [sf_dir] > PLANS.md
Per query: exchanges by kind, join strategies, windows, Python operators,
whole-stage-codegen stages, and each scan's columns and pushed filters.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarry.plans.catalog import QUERIES  # noqa: E402
from quarry.session import build_session, release_scratch  # noqa: E402
from quarry.streaming import jobs  # noqa: E402

EXCHANGES = {
    "hash": r"Exchange hashpartitioning",
    "range": r"Exchange rangepartitioning",
    "roundrobin": r"Exchange RoundRobinPartitioning",
    "single": r"Exchange SinglePartition",
    "broadcast": r"BroadcastExchange",
    "reused": r"ReusedExchange",
}
JOINS = ["BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
         "CartesianProduct"]
STATEFUL_OR_PYTHON = ["ArrowEvalPython", "BatchEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
          "FlatMapGroupsInPandasWithState", "StateStoreSave"]
AGGS = ["HashAggregate", "SortAggregate", "ObjectHashAggregate"]


def final_plan(df) -> str:
    """The plan text with every adaptive "Initial Plan" block removed (scalar
    subqueries carry their own, nested at their indentation)."""
    out, skip_above = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        indent = len(line) - len(line.lstrip(" :|+-"))
        if skip_above is not None:
            if indent >= skip_above:
                continue
            skip_above = None
        if "== Initial Plan ==" in line:
            skip_above = indent
            continue
        out.append(line)
    return "\n".join(out)


def summarise(plan: str) -> dict:
    ex = {k: len(re.findall(v, plan)) for k, v in EXCHANGES.items()}
    joins = Counter(j for j in JOINS for _ in re.finditer(rf"\b{j}\b", plan))
    # an unpartitioned window reads a single-partition exchange, whatever lists its line prints
    lines = plan.splitlines()
    windows = [k for k, ln in enumerate(lines) if re.search(r"\bWindow \[", ln)]
    source = lambda k: next((ln for ln in lines[k + 1:] if re.search(r"Exchange |Scan ", ln)), "")
    unpartitioned = sum("Exchange SinglePartition" in source(k) for k in windows)
    py = Counter(p for p in STATEFUL_OR_PYTHON for _ in re.finditer(rf"\b{p}\b", plan))
    aggs = Counter(a for a in AGGS for _ in re.finditer(rf"\b{a}\(", plan))
    codegen = len(set(re.findall(r"\*\((\d+)\)", plan)))
    scans = set()
    for m in re.finditer(r"FileScan parquet \[([^\]]*)\].*?Location: \w+\([^)]*\)\[file:[^\]]*/(\w+)\.parquet\]"
                         r".*?PushedFilters: \[([^\]]*)\]", plan):
        cols = ",".join(c.split("#")[0] for c in m.group(1).split(",") if c)
        scans.add(f"{m.group(2)}({cols})" + (f" push[{m.group(3)}]" if m.group(3) else ""))
    return {"ex": ex, "joins": joins, "windows": len(windows), "unpartitioned": unpartitioned,
            "python": py, "aggs": aggs, "codegen": codegen, "scans": sorted(scans)}


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    print("# PLANS\n")
    print(f"Final adaptive plans of the registered queries at `{sf}` (generated by "
          "`scripts/plan_report.py`). Exchange counts are per plan; `reused` exchanges are read, "
          "not recomputed. `single` exchanges carry only one row per bucket (the prefix step of "
          "the bucketed ordinals, whose windows are the unpartitioned ones counted here), "
          "a global partial aggregate or a scalar subquery. A stream query's row has the plan of its "
          "last micro-batch besides the batch read of its result; tables that a query writes and "
          "reads back are not shown. `docs/SCALE_REVIEW.md` reviews the plans.\n")
    print("| query | exchanges | joins | aggregates | windows (unpartitioned) | python | codegen stages | scans |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    # the plan of every stream's last micro-batch, taken when the stream ends
    seen: list[str] = []
    finish = jobs._finish

    def finish_and_keep(q) -> None:
        finish(q)
        seen.append("\n" + q._jsq.explainInternal(False))

    jobs._finish = finish_and_keep
    for name, fn in {**QUERIES, **jobs.STREAM_QUERIES}.items():
        df = fn(spark, sf)
        df._jdf.queryExecution().executedPlan().execute().count()   # run this plan (AQE finalises it)
        text = final_plan(df)
        text += "".join(seen.pop() for _ in range(len(seen)))
        s = summarise(text)
        ex = ", ".join(f"{k} {v}" for k, v in s["ex"].items() if v) or "none"
        joins = ", ".join(f"{k} {v}" for k, v in s["joins"].items()) or "none"
        py = ", ".join(f"{k} {v}" for k, v in s["python"].items()) or "none"
        aggs = ", ".join(f"{k} {v}" for k, v in s["aggs"].items()) or "none"
        release_scratch(spark)
        print(f"| {name} | {ex} | {joins} | {aggs} | {s['windows']} ({s['unpartitioned']}) | {py} | "
              f"{s['codegen']} | {'; '.join(s['scans'])} |")
    spark.stop()


if __name__ == "__main__":
    main()
