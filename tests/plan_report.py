"""Physical-plan summary of every registered query (written to PLANS.md).

    python tests/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import __spark_entry__ as E  # noqa: E402


def final_only(plan: str) -> str:
    """Drop the ``== Initial Plan ==`` sections of adaptive plans."""
    out, skip = [], False
    for line in plan.splitlines():
        if "== Initial Plan ==" in line:
            skip = True
            indent = len(line) - len(line.lstrip(" :|+-"))
            continue
        if skip:
            cur = len(line) - len(line.lstrip(" :|+-"))
            if "== Final Plan ==" in line or cur < indent:
                skip = False
            else:
                continue
        out.append(line)
    return "\n".join(out)


def summarize(plan: str) -> dict[str, object]:
    plan = final_only(plan)
    return {
        "exchanges": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobin|SinglePartition)", plan)),
        "single_partition": plan.count("Exchange SinglePartition"),
        "broadcast_joins": plan.count("BroadcastHashJoin"),
        "sort_merge_joins": plan.count("SortMergeJoin"),
        "shuffled_hash_joins": plan.count("ShuffledHashJoin"),
        "nested_loop_joins": plan.count("BroadcastNestedLoopJoin") + plan.count("CartesianProduct"),
        "partial_top_k": plan.count("WindowGroupLimit") // 2,
        "take_ordered": plan.count("TakeOrderedAndProject"),
        "python_nodes": plan.count("EvalPython") + plan.count("InPandas"),
        "pushed_filters": sorted(set(re.findall(r"PushedFilters: \[([^\]]+)\]", plan))),
    }


NOTES = """
## Notes

* Orders: one exchange spreads the single-split lineitem file (absent at scale),
  one is keep-last (`WindowGroupLimit` pre-limits per task, so at most one row
  per `order_id` and task is shuffled), one is the gold aggregation. The
  dimension joins are broadcast (nation always, the others when AQE measures
  them small); at scale `lineitem`-`orders` is a shuffle join on the order key.
* `daily_revenue` / `content_timeline`: the running total is two-level; the
  only single-partition exchange holds one row per calendar month.
* `top_customers`: one aggregation (totals + `mode`) over one read of silver,
  then `TakeOrderedAndProject`.
* `bm25` / `rrf`: single-partition exchanges are the global aggregates of the
  N and avgdl scalar subqueries (one row per task). Documents are shuffled once
  by `doc_id`; the rest of the scoring and the per-task top-k run in that
  stage.
* `vector_top_k`: one stage scores vectors against the constant query set and
  pre-limits; one exchange for the final top-k.
* No query has a nested-loop or cartesian join or a Python evaluation node.
"""


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from strata.session import get_session
    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    print("# PLANS\n")
    print(f"Final adaptive physical plans of the registered queries at `{sf_dir}` on local[8]"
          " (generated by `tests/plan_report.py`). Exchanges count shuffles, including the"
          " round-robin spread of single-split test files and the one-row global aggregates of"
          " scalar subqueries; `partial_top_k` counts per-task `WindowGroupLimit` pre-limits"
          " (keep-last and top-k) that run before a shuffle.\n")
    print("| query | exchanges | single-partition | broadcast joins | sort-merge joins | nested-loop joins |"
          " partial top-k | take-ordered | python nodes |")
    print("|---|---|---|---|---|---|---|---|---|")
    details = []
    for name, fn in E.queries().items():
        if name == "incremental_orders":
            continue
        df = fn(spark, sf_dir)
        qe = df._jdf.queryExecution()
        df.collect()  # run this query execution so its adaptive plan is final
        plan = qe.executedPlan().toString()
        s = summarize(plan)
        print(f"| {name} | {s['exchanges']} | {s['single_partition']} | {s['broadcast_joins']} |"
              f" {s['sort_merge_joins']} | {s['nested_loop_joins']} | {s['partial_top_k']} | {s['take_ordered']} |"
              f" {s['python_nodes']} |")
        details.append((name, s["pushed_filters"]))
    print(NOTES)
    print("## Filters pushed into Parquet scans\n")
    for name, pf in details:
        if pf:
            print(f"* `{name}`: " + "; ".join(f"`{p}`" for p in pf))


if __name__ == "__main__":
    main()
