"""bench.py prints one JSON line with the fields the driver records."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line(small_dir):
    env = dict(os.environ, BENCH_SF_DIR=small_dir, BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "apriori_item_counts", "pagerank_iter1"],
                         capture_output=True, text=True, env=env, timeout=600, check=True).stdout
    lines = [l for l in out.splitlines() if l.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= rec.keys()
    assert rec["unit"] == "sec" and rec["sf"] == 0.001
    assert set(rec["queries"]) == {"apriori_item_counts", "pagerank_iter1"}
    assert abs(rec["value"] - sum(rec["queries"].values())) < 0.01
