"""Physical-plan inventory of every registered query.

Each query is executed (collect) and its FINAL adaptive plan is read:
shuffle exchanges and broadcast exchanges actually run, exchanges and
subqueries reused instead of recomputed, window operators, Python
(pandas) operators, parquet scans and the widest ReadSchema. Model fits
and other actions that run inside the query callable are not counted.
Writes a markdown table to stdout.

    python tools/plan_stats.py [sf_dir] [key ...] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohortlens.plans.catalog import QUERIES  # noqa: E402
from cohortlens.session import get_session  # noqa: E402

SKIP = {"tune_grid", "tune_grid_best"}  # their plans are a createDataFrame of fitted metrics


def final_only(plan: str) -> list[str]:
    """Drop every '== Initial Plan ==' section an executed adaptive plan
    (and each of its subqueries) prints next to its final plan."""
    out, skip_col = [], None
    for ln in plan.splitlines():
        col = len(ln) - len(ln.lstrip(" :|+-"))
        if skip_col is not None:
            if col >= skip_col:
                continue
            skip_col = None
        if "== Initial Plan ==" in ln:
            skip_col = col
            continue
        out.append(ln)
    return out


def stats(plan: str) -> dict:
    lines = final_only(plan)
    plan = "\n".join(lines)
    def n(pat):
        return sum(1 for ln in lines if re.search(pat, ln))
    widths = [len(m.group(1).split(",")) for m in re.finditer(r"ReadSchema: struct<(.*)>", plan)]
    return {
        "shuffles": n(r"(?<!Reused)\bExchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)"),
        "reused": n(r"Reused(Exchange|Subquery)"),
        "broadcasts": n(r"BroadcastExchange"),
        "windows": n(r"\bWindow \["),
        "python": n(r"(ArrowEvalPython|FlatMapCoGroupsInPandas|MapInPandas|FlatMapGroupsInPandas|FlatMapCoGroupsInArrow|MapInArrow|BatchEvalPython)"),
        "scans": n(r"FileScan parquet|Scan ExistingRDD|FileScan csv"),
        "max_read_cols": max(widths) if widths else 0,
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = get_session("local[4]", shuffle_partitions=8)
    rows = []
    keys = sys.argv[2:]
    for k, f in QUERIES.items():
        if k in SKIP or (keys and k not in keys):
            continue
        df = f(spark, sf)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        rows.append((k, stats(plan)))
    cols = ["shuffles", "reused", "broadcasts", "windows", "python", "scans", "max_read_cols"]
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for k, s in rows:
        print(f"| `{k}` | " + " | ".join(str(s[c]) for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
