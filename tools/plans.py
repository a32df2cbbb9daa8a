"""Write the final (adaptive) physical plans of the headline queries to PLANS.md.

    python tools/plans.py [sf_dir]

Each query's own execution runs once (``collect``; the results are small)
so that AQE has settled its plan; the tree is then trimmed to operator lines.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from regioncast import catalog  # noqa: E402
from regioncast.session import get_session  # noqa: E402

HEADLINE = ["q1_avg_daily_per_centre", "top5_next_month_strict", "top5_next_month_carryover",
            "top5_next_month_filled", "coverage_share", "cluster_cost", "cells_put", "cells_deleted"]
KEEP = re.compile(r"(Exchange|Join|Aggregate|Window|Scan parquet|FileScan|Sort |Union|Generate|"
                  r"BroadcastExchange|AQEShuffleRead|InMemoryTableScan|Filter|Limit|QueryStage)")


def _final_plan(df) -> str:
    qe = df._jdf.queryExecution()
    return qe.executedPlan().toString()


def _trim(plan: str) -> list[str]:
    lines = []
    in_final = "Final Plan" not in plan
    for line in plan.splitlines():
        if "Final Plan" in line:
            in_final = True
            continue
        if "Initial Plan" in line:
            break
        if in_final and KEEP.search(line):
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r", \[plan_id=\d+\]", "", line)
            lines.append(line[:170])
    return lines


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", shuffle_partitions=16)
    out = ["# Physical plans", "",
           f"Final adaptive plans of the headline queries on `{sf_dir}` (local[8], 16 shuffle partitions),",
           "trimmed to scans, filters, exchanges, joins, aggregates, windows and sorts. Written by `tools/plans.py`.",
           ""]
    for name in HEADLINE:
        df = catalog.QUERIES[name](spark, sf_dir)
        df.collect()
        plan = _final_plan(df)
        pushed = sorted(set(re.findall(r"PushedFilters: \[[^\]]*\]", plan)))
        out += [f"## {name}", "", "```"] + _trim(plan) + ["```", ""]
        if pushed:
            out += ["Pushed to Parquet: " + "; ".join(p.replace("PushedFilters: ", "") for p in pushed), ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out))
    print(path)
    spark.stop()


if __name__ == "__main__":
    main()
