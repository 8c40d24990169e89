"""Summarize what every registered query really ran (markdown), from Spark's event log.

Usage: python tools/plan_summary.py [sf_dir] [name ...] > PLANS.md
Each query is evaluated with the no-op sink. Counted are all jobs that it
started, also while it was built, and the plans as they were after runtime
re-planning, with those of cached tables: stages that wrote shuffle data, joins, scans.
"""

from __future__ import annotations

import collections
import glob
import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarry.plans.catalog import queries  # noqa: E402
from quarry.session import build_session  # noqa: E402

JOINS = ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct")
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow")


def nodes(plan: dict):
    yield plan
    for child in plan["children"]:
        yield from nodes(child)


def summarize(folder: str, spans: list[tuple[str, float, float]]) -> dict[str, dict]:
    """For each (name, begin, end in ms) what the event log in ``folder`` says of it."""
    out = {name: {"shuffles": 0, "mb": 0.0, "jobs": 0, "plans": {}} for name, _, _ in spans}
    of = lambda t: next((n for n, a, b in spans if a <= t <= b), None)
    owner, writing = {}, set()
    for path in glob.glob(f"{folder}/*"):
        for line in open(path, encoding="utf-8"):
            e = json.loads(line)
            kind = e["Event"].rpartition(".")[2]
            if kind == "SparkListenerSQLExecutionStart":
                owner[e["executionId"]] = of(e["time"])
            if "sparkPlanInfo" in e and (name := owner.get(e["executionId"])):
                out[name]["plans"][e["executionId"]] = e["sparkPlanInfo"]  # the last one is the plan that ran
            elif kind == "SparkListenerJobStart" and (name := of(e["Submission Time"])):
                out[name]["jobs"] += 1
            elif kind == "SparkListenerTaskEnd" and (name := of(e["Task Info"]["Launch Time"])):
                n = (e.get("Task Metrics") or {}).get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0)
                if n:
                    out[name]["mb"] += n / 1e6
                    writing.add((name, e["Stage ID"]))
    for name, _ in writing:
        out[name]["shuffles"] += 1
    return out


def run(spark, sf_dir: str, names=None) -> list[tuple[str, float, float]]:
    """Evaluate the queries one by one; (name, begin, end) of each."""
    spans = []
    for name, fn in queries().items():
        if names and name not in names:
            continue
        spark.catalog.clearCache()
        begin = time.time() * 1000
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        spans.append((name, begin, time.time() * 1000))
    return spans


def forbidden(plans: dict) -> list[str]:
    return sorted({b for p in plans.values() for n in nodes(p) for b in FORBIDDEN if n["nodeName"].startswith(b)})


EVENT_LOG = {"spark.eventLog.enabled": "true", "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
             "spark.sql.maxMetadataStringLength": "2000"}


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    folder = tempfile.mkdtemp(prefix="quarry-events-", dir="/tmp")
    spark = build_session(extra=EVENT_LOG | {"spark.eventLog.dir": f"file://{folder}"})
    spans = run(spark, sf_dir, sys.argv[2:])
    spark.stop()
    print("# What the registered queries ran\n")
    print(f"From Spark's event log at `{sf_dir}`: `python tools/plan_summary.py`. Plans are those after runtime re-planning.\n")
    print("| Query | Jobs | Stages writing a shuffle | MB shuffled | Joins | Scans (columns) | Forbidden ops |")
    print("|---|---|---|---|---|---|---|")
    for name, s in summarize(folder, spans).items():
        every = [n for p in s["plans"].values() for n in nodes(p)]
        joins = collections.Counter(j for n in every for j in JOINS if n["nodeName"].startswith(j))
        scans = collections.Counter()
        for n in every:
            if n["nodeName"].startswith("Scan parquet") and (m := re.search(r"/(\w+)\.parquet", str(n.get("metadata", {})))):
                schema = re.search(r"struct<(.*)>", n.get("metadata", {}).get("ReadSchema", ""))
                scans[f"{m[1]}: {', '.join(c.split(':')[0] for c in schema[1].split(',')) if schema else '-'}"] += 1
        bad = forbidden(s["plans"])
        print(f"| `{name}` | {s['jobs']} | {s['shuffles']} | {s['mb']:.2f} | {', '.join(f'{k} {v}' for k, v in joins.items()) or '-'} "
              f"| {'<br>'.join(sorted(scans)) or '-'} | {', '.join(bad) or 'none'} |")


if __name__ == "__main__":
    main()
