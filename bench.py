"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion into Spark's ``noop`` sink (the whole plan
executes, nothing is collected to the driver). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfwise.plans.catalog import queries  # noqa: E402
from shelfwise.session import build_session  # noqa: E402

HEADLINE = [
    "scan_interactions",
    "preprocess_interactions",
    "user_item_matrix",
    "build_dictionary",
    "index_interactions",
    "split_three_way",
    "topk_batch",
    "topk_excluding_seen",
    "score_catalogue",
    "metric_report",
    "als_metric_report",
    "als_topk_unseen",
    "mlp_topk",
    "stream_dedupe",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=2 * cpus, app_name="shelfwise-bench",
                          driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
    qs = queries()
    timings: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in only or HEADLINE:
        t0 = time.perf_counter()
        try:
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings[name] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # noqa: BLE001
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
