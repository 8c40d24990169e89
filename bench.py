"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query is fully evaluated with the no-op sink (every row computed,
nothing collected to the driver), BENCH_RUNS times (median), after a warm-up
pass of all queries on the smallest scale factor; caches are cleared before each.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarry.plans.catalog import queries  # noqa: E402
from quarry.session import build_session  # noqa: E402

HEADLINE = [
    "apriori_item_counts",
    "apriori_candidate_pairs",
    "apriori_frequent_pairs",
    "fpgrowth_itemsets",
    "association_rules",
    "pagerank_10",
    "pagerank_damped",
    "doc_shingles",
    "doc_similar_groups",
    "shingle_vocabulary",
    "jaccard_similar_pairs",
    "minhash_similar_pairs",
    "nb_model",
    "nb_predictions",
    "nb_accuracy",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    # the documents lie in one row group: stated here, as a caller would, not guessed by the library
    spark.conf.set("quarry.input.partitions", cpus)
    qs = queries()
    # warm-up on the smallest scale: JVM JIT and codegen for every code path,
    # on other data, so no timed query reads anything cached here
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001"))
    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        for name in names:
            qs[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    times = {}
    for name in names:
        took = []
        for _ in range(runs):
            spark.catalog.clearCache()  # each run builds its own cached tables
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(took), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus)}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
