"""Markdown table of the physical operators of every registered query (static plans).

    python tools/plan_inventory.py /root/testdata/sf0.001 docs/PLAN_INVENTORY.md

Counts shuffles by kind, broadcasts, aggregates, windows, sorts and top-k per
query. Queries that write files or run streams are listed without a plan.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from grantscope.plans.registry import QUERIES  # noqa: E402
from grantscope.session import build_session  # noqa: E402

WRITES = {"evidence_package_index", "sink_csv_roundtrip", "sink_json_roundtrip", "stream_terminated_access",
          "stream_last_used_from_log", "quick_exports_index", "view_exports_index", "findings_from_stored",
          "review_kpis"}
COLUMNS = [
    ("hash shuffles", r"Exchange hashpartitioning(?![^\n]*REPARTITION_BY_NUM)"),
    ("fan-out (small inputs only)", r"Exchange hashpartitioning[^\n]*REPARTITION_BY_NUM"),
    ("range shuffles", r"Exchange rangepartitioning"),
    ("single-partition", r"Exchange SinglePartition"),
    ("broadcasts", r"BroadcastExchange"),
    ("aggregates", r"(?:Hash|ObjectHash|Sort)Aggregate"),
    ("windows", r"\bWindow \["),
    ("top-k", r"TakeOrderedAndProject"),
    ("joins", r"(?:BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin)"),
    ("nested loop / cartesian", r"(?:BroadcastNestedLoopJoin|CartesianProduct)"),
    ("python", r"(?:BatchEvalPython|ArrowEvalPython|PythonUDF)"),
]


def main(sf_dir: str, out: str) -> None:
    spark = build_session("local[4]")
    head = "| query | " + " | ".join(c for c, _ in COLUMNS) + " |"
    lines = ["# Plan inventory\n",
             f"Static physical plans at `{sf_dir}` (before adaptive re-planning: at scale AQE may turn a broadcast "
             "into a sort-merge join or the reverse). Generated by `python tools/plan_inventory.py`. "
             "Fan-out exchanges exist only because each test file is one row group (see README); at scale "
             "inputs have more splits than cores and they disappear. Single-partition exchanges only ever carry "
             "already aggregated rows (one-row totals, per-group counts); windows run on distinct values or "
             "aggregated rows.\n",
             head, "|" + "---|" * (len(COLUMNS) + 1)]
    for name, fn in QUERIES.items():
        if name in WRITES:
            lines.append(f"| {name} | " + " | ".join("(writes / streams)" if i == 0 else "" for i in
                                                     range(len(COLUMNS))) + " |")
            continue
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        counts = [len(re.findall(p, plan)) for _, p in COLUMNS]
        lines.append(f"| {name} | " + " | ".join(str(c) for c in counts) + " |")
    with open(out, "w") as fh:
        fh.write("\n".join(lines) + "\n")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001",
         sys.argv[2] if len(sys.argv) > 2 else "docs/PLAN_INVENTORY.md")
