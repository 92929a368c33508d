"""Benchmark: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is run to completion through the `noop` sink (the whole plan
executes, nothing is collected) after one warm-up run of the flagship
query; prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "feature_table",       # raw derivation + clean + single-shuffle pivot + aggregates + encode + label
    "pivot_wide",
    "validate_features",
    "completeness",
    "encode_state",
    "stratified_split",
    "roc_auc",
    "cv_summary",
    "classification_report",
    "validate_requests",
    "assemble_features",
    "ingest_pages",
    "prediction_stats",
    "daily_risk",
    "recent_predictions",
    "state_risk",
    "normalise_scores",
    "score_batch",         # validate -> assemble -> compiled trees -> tier
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE

    from wardstat.session import build_session
    from wardstat.plans.catalog import QUERIES

    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
                          app_name="wardstat-bench")
    # warm-up (JIT, file listing caches)
    QUERIES["feature_table"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
