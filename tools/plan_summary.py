"""Summarise the executed physical plan of every catalogue query.

Usage: python tools/plan_summary.py [--sf-dir DIR] [--out PLANS.md] [name ...]

For each query: shuffles (Exchange), join strategies, windows, sorts,
whole-stage-codegen stages and each scan's read schema and pushed filters,
taken from the final adaptive plan after the query ran (collected, so the
plan read back is the one that executed). What a query does before its last plan
(key checks, fits, checkpoints, written tables) is read from Spark's event log,
kept in a scratch folder: jobs, stages, bytes shuffled and written, and the
operators of all its plans.
"""

from __future__ import annotations

import argparse
import json
import os
import re
import sys
import tempfile
from collections import Counter, defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from keelson.plans.queries import QUERIES  # noqa: E402
from keelson.session import get_session  # noqa: E402

OPS = ("Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange RoundRobinPartitioning",
       "Exchange SinglePartition", "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin",
       "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "Window", "Sort ",
       "HashAggregate", "ObjectHashAggregate", "Generate", "Union", "TakeOrderedAndProject")
SKIP = {"cv_select", "cv_metrics", "logreg_fit", "logreg_score"}
GROUP = "spark.jobGroup.id"


def final_part(plan: str) -> str:
    """The executed plan only (an adaptive plan also prints its initial plan)."""
    return plan.split("== Initial Plan ==")[0]


def summarise(plan: str) -> tuple[Counter, list[str]]:
    plan = final_part(plan)
    counts = Counter()
    for op in OPS:
        counts[op.strip()] = plan.count(op)
    scans = []
    for line in plan.splitlines():
        if "FileScan" in line or "Scan parquet" in line:
            rs = re.search(r"ReadSchema: (struct<[^>]*>?)", line)
            pf = re.search(r"PushedFilters: \[([^\]]*)\]", line)
            loc = re.search(r"\[file:[^\]]*/([^/\]]+)\]", line)
            scans.append(f"{loc.group(1) if loc else '?'}: read {rs.group(1) if rs else '?'}"
                         + (f"; pushed [{pf.group(1)}]" if pf and pf.group(1) else ""))
    return counts, scans


def all_jobs(folder: str) -> dict[str, Counter]:
    """Per job group: jobs, stages, MB shuffled and MB written, from the event log."""
    out: dict[str, Counter] = defaultdict(Counter)
    group_of: dict[int, str] = {}
    for name in os.listdir(folder):
        with open(os.path.join(folder, name), encoding="utf-8") as log:
            for line in log:
                e = json.loads(line)
                if e["Event"] == "SparkListenerJobStart":
                    group = (e.get("Properties") or {}).get(GROUP, "")
                    out[group]["jobs"] += 1
                    group_of.update({i: group for i in e["Stage IDs"]})
                elif e["Event"] == "SparkListenerStageCompleted":
                    out[group_of.get(e["Stage Info"]["Stage ID"], "")]["stages"] += 1
                elif e["Event"] == "SparkListenerTaskEnd":
                    m, c = e.get("Task Metrics") or {}, out[group_of.get(e["Stage ID"], "")]
                    c["shuffled"] += m.get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0)
                    c["written"] += m.get("Output Metrics", {}).get("Bytes Written", 0)
    return out


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    ap.add_argument("--out", default="PLANS.md")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    log = tempfile.mkdtemp(prefix="keelson-events-")
    spark = get_session("local[8]", shuffle_partitions=16, conf={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log}", "spark.eventLog.compress": "false",
        "spark.eventLog.rolling.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    qs = QUERIES
    names = a.names or [n for n in qs if n not in SKIP]
    lines = ["# Physical plans of the query catalogue", "",
             f"Final adaptive plans at `{a.sf_dir}`, `local[8]`, 16 shuffle partitions, read back after "
             "running each query. Generated by `tools/plan_summary.py`. Counts are operator "
             "occurrences in the final plan (a broadcast exchange appears once per broadcast side). "
             "The second line counts everything the query starts, also before its last plan.", ""]
    found = []
    for name in names:
        spark.sparkContext.setJobGroup(name, name)
        df = qs[name](spark, a.sf_dir)
        df.collect()  # runs under the frame's own execution, so the adaptive plan is final
        plan = df._jdf.queryExecution().executedPlan().toString()
        counts, scans = summarise(plan)
        found.append((name, counts, scans))
    spark.stop()
    everything = all_jobs(log)
    for name, counts, scans in found:
        ops, c = ", ".join(f"{k} x{v}" for k, v in counts.items() if v), everything[name]
        lines += [f"## {name}", "", f"- operators: {ops or 'scan and projection only'}",
                  f"- in all: {c['jobs']} jobs, {c['stages']} stages, {c['shuffled'] / 1e6:.1f} MB shuffled, "
                  f"{c['written'] / 1e6:.1f} MB written"]
        lines += [f"- scan {s}" for s in dict.fromkeys(scans)] + [""]
    with open(a.out, "w") as fh:
        fh.write("\n".join(lines))
    print(f"wrote {a.out} ({len(names)} queries)")


if __name__ == "__main__":
    main()
