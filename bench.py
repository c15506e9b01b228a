"""Benchmark of the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and forces full evaluation with the ``noop`` sink
(every row computed, nothing collected to the driver). Each query is timed
twice, plan building and its size checks included: ``cold`` is the first run
in the session (code generation and class loading with it, no warm-up on other
data), ``queries`` is the run after all have run once. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from grantscope.plans.registry import QUERIES  # noqa: E402
from grantscope.session import build_session  # noqa: E402

HEADLINE = [
    "findings_all",
    "summary_kpis",
    "rule_004_sod",
    "rule_005_mfa",
    "finding_type_breakdown",
    "dept_type_pivot",
    "top_findings_20",
    "findings_search",
    "access_inventory",
    "critical_no_justification",
    "manager_assignment",
    "last_used_from_log",
    "evidence_summary_meta",
    "domain_violations",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus))
    times: dict[str, dict[str, float | None]] = {"cold": {}, "warm": {}}
    failed = set()
    for run in times.values():
        for name in HEADLINE:
            t = time.perf_counter()
            try:
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                run[name] = round(time.perf_counter() - t, 3)
            except Exception as exc:  # a failing query is reported, not hidden
                print(f"{name} failed: {exc}", file=sys.stderr)
                run[name] = None
                failed.add(name)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "headline_queries_total", "value": round(sum(v for v in times["warm"].values() if v), 3), "unit": "sec",
           "queries": times["warm"], "cold": times["cold"],
           "cold_value": round(sum(v for v in times["cold"].values() if v), 3), "sf": sf}
    if failed:
        out["failed"] = sorted(failed)
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
