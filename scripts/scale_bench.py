"""Scale-up run: F1 replicated with user-id offsets (each copy is a new set
of users with the same tastes), then the ALS pipeline end to end and exact
top-k serving with seen items excluded.

    SCALE_COPIES=17 python scripts/scale_bench.py     # ~10M interactions from sf0.1

Benchmark helper only: the data is derived by Spark from the given tables.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from shelfwise.operators import als, split  # noqa: E402
from shelfwise.plans.pipelines import run_als, run_serving  # noqa: E402
from shelfwise.session import build_session  # noqa: E402
from shelfwise.sources import tables  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    copies = int(os.environ.get("SCALE_COPIES", "17"))
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    out_dir = os.environ.get("SCALE_OUT")  # optional: where to land the replicated table
    spark = build_session(f"local[{cpus}]", shuffle_partitions=4 * cpus, driver_memory="20g")
    base = tables.interactions(spark, sf_dir)
    offset = base.agg(F.max("user_id")).first()[0] + 1
    grown = base.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).select(
        (F.col("user_id") + F.col("_copy") * F.lit(offset)).alias("user_id"), "item_id", "rating", "ts"
    )
    timings = {}
    t = time.perf_counter()
    path = out_dir or os.path.join(spark.sparkContext.getCheckpointDir(), f"scale-{copies}")
    grown.write.mode("overwrite").parquet(path)
    inter = spark.read.parquet(path)
    rows = inter.count()
    timings["materialise"] = round(time.perf_counter() - t, 2)

    t = time.perf_counter()
    run = run_als(tables.raw_form(inter), 10)
    report = run.report.first().asDict()
    timings["p1_als_pipeline"] = round(time.perf_counter() - t, 2)

    t = time.perf_counter()
    parts = split.train_test_split(inter.select(
        F.col("user_id").cast("int"), F.col("item_id").cast("int"), "rating"))
    model = als.fit(parts["train"])
    uf, itf = als.factors(model)
    timings["als_fit"] = round(time.perf_counter() - t, 2)
    t = time.perf_counter()
    served = run_serving(parts["test"], uf, itf, 10, exclusions=parts["train"].select("user_id", "item_id"))
    served.write.format("noop").mode("overwrite").save()
    timings["topk_all_users_excluding_seen"] = round(time.perf_counter() - t, 2)
    spark.stop()
    print(json.dumps({"rows": rows, "copies": copies, "seconds": timings,
                      "metrics": {k: (round(v, 6) if isinstance(v, float) else v) for k, v in report.items()}}))


if __name__ == "__main__":
    main()
