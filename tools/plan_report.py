"""Physical-plan summary of the library's registered queries (markdown table on stdout).

usage: python tools/plan_report.py [sf_dir]

Per query: shuffle exchanges, broadcast exchanges, operators outside
whole-stage codegen (Python evaluation excluded), file scans with the number
of columns they read and the filters pushed into them. Queries that run
jobs while being built (model fits) are skipped.
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from terroir.plans import testdata  # noqa: E402
from terroir.session import build_session  # noqa: E402

SKIP = {"forest_metrics", "feature_importance", "forest_predictions", "learning_curve", "model_actuals", "model_correlation"}


def summarize(plan: str) -> dict:
    lines = plan.split("\n")
    shuffles = sum(1 for l in lines if re.search(r"\bExchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", l))
    bcast = sum(1 for l in lines if "BroadcastExchange" in l)
    scans, pushed = [], []
    for l in lines:
        m = re.search(r"FileScan (\w+) \[([^\]]*)\]", l)
        if m:
            scans.append(f"{m.group(1)}:{len(m.group(2).split(','))}")
            p = re.search(r"PushedFilters: \[([^\]]*)\]", l)
            if p and p.group(1):
                pushed.append(str(len(p.group(1).split(", "))))
    return {"shuffles": shuffles, "broadcasts": bcast, "scans": " ".join(scans) or "-",
            "pushed": ",".join(pushed) or "-"}


def plan_text(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def codegen_gaps(text: str) -> str:
    gaps = []
    for l in text.split("\n"):
        s = l.strip().lstrip(":+- ").strip()
        if not s or s.startswith("*(") or s.startswith("("):
            continue
        op = s.split(" ")[0].split("(")[0]
        if op in ("Project", "Filter", "HashAggregate", "SortAggregate", "Window", "Generate",
                  "Expand", "BroadcastHashJoin", "SortMergeJoin"):
            gaps.append(op)
    return ",".join(sorted(set(gaps))) or "-"


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.adaptive.enabled", "false")   # static plan, readable
    print("| query | shuffles | broadcasts | scans (format:columns read) | pushed filters | outside codegen |")
    print("| --- | --- | --- | --- | --- | --- |")
    for name, fn in testdata.QUERIES.items():
        if name in SKIP:
            continue
        text = plan_text(fn(spark, sf_dir))
        s = summarize(text)
        print(f"| {name} | {s['shuffles']} | {s['broadcasts']} | {s['scans']} | {s['pushed']} | "
              f"{codegen_gaps(text)} |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
