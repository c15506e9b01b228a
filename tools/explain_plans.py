"""Write the final (adaptive) physical plans of key queries to a Markdown file.

    python tools/explain_plans.py /root/testdata/sf0.01 docs/PLANS.md

Each query's own result is materialised once (a documentation tool on a
small scale factor: the plan shapes do not depend on it) so its adaptive
plan is final; lines are shortened to keep the operator tree readable.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from grantscope.plans.registry import QUERIES  # noqa: E402
from grantscope.session import build_session  # noqa: E402

KEY_QUERIES = ["findings_all", "rule_004_sod", "rule_005_mfa", "summary_kpis", "filter_options",
               "manager_assignment", "admin_grants", "last_used_from_log", "top_findings_20"]


def final_plan(df, width: int = 150) -> str:
    df.collect()  # small scale factor only: finalises this frame's own adaptive plan
    text = df._jdf.queryExecution().executedPlan().toString()
    lines = text.split("== Initial Plan ==")[0].splitlines()
    return "\n".join(line if len(line) <= width else line[:width] + " …" for line in lines)


def main(sf_dir: str, out: str) -> None:
    spark = build_session("local[8]")
    parts = ["# Final physical plans\n", f"Generated by `python tools/explain_plans.py {sf_dir} {out}` "
             "(local[8], adaptive execution on; long expressions cut).\n"]
    for name in KEY_QUERIES:
        parts.append(f"## {name}\n\n```\n{final_plan(QUERIES[name](spark, sf_dir))}\n```\n")
    with open(out, "w") as fh:
        fh.write("\n".join(parts))


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2] if len(sys.argv) > 2 else "docs/PLANS.md")
