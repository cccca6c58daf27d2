"""Benchmark: headline queries on the large impression log (lineitem ⋈ orders) and the
other operator families, at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]``. Prints one JSON line.

Each query is executed fully with the ``noop`` sink (no driver collection); the
reported time per query is the best of ``$BENCH_REPEAT`` runs (default 3) after one
warm-up pass over a small query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from situate.plans.queries import QUERIES  # noqa: E402
from situate.session import get_spark  # noqa: E402

HEADLINE = ["kpi_metrics_big", "user_features_big", "association_rules_big", "top_strategies_big"]
OTHERS = ["kpi_metrics", "top_strategies", "enrich_log", "frequent_itemsets", "rule_match", "event_clean",
          "tour_clean", "weather_pivot", "creative_catalog", "context_catalog", "grade_cases", "eval_suite",
          "reconcile_metrics", "decode_envelope", "weighted_choice", "silhouette", "digest_sections"]
LONG = ["kmeans_segments", "frequent_itemsets_general", "transaction_matrix", "scan_csv_roundtrip", "scan_raw_array", "rule_match_arrays", "rules_general"]  # timed once


def run(spark, name, sf_dir):
    t = time.perf_counter()  # before the query is built: some run jobs while being built
    df = QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = get_spark("situate-bench", cpus=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    run(spark, "kpi_metrics", sf_dir)  # warm-up: JVM, codegen caches, file listing
    times = {}
    for name in HEADLINE + OTHERS:
        times[name] = round(min(run(spark, name, sf_dir) for _ in range(repeat)), 3)
    for name in LONG:
        times[name] = round(run(spark, name, sf_dir), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(times[q] for q in HEADLINE), 3),
        "unit": "sec",
        "queries": times,
        "all_total_sec": round(sum(times.values()), 3),
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
