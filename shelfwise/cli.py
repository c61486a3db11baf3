"""Command line for the four pipelines, reading the reference's inputs.

    python -m shelfwise preprocess --interactions RAW --out DIR        # P2
    python -m shelfwise als --interactions RAW --out DIR [--user-map user_map.json --item-map item_map.json]  # P1
    python -m shelfwise neural --matrix DIR/user_item_matrix --out MODELS   # P3
    python -m shelfwise serve --models MODELS --users USERS --out RECS [--exclude PAIRS]  # P4

Inputs are tables in the reference's raw shape (string ``user_id`` /
``item_id``, ``rating``, epoch-second ``timestamp``); ``--format`` picks the
data source (``parquet`` by default). The session comes from
``spark-submit``/the environment; ``spark.checkpoint.dir`` must name shared
storage on a cluster.
"""

from __future__ import annotations

import argparse
import os
import sys

if not __package__:  # run as a script (spark-submit shelfwise/cli.py ...)
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.ml import PipelineModel  # noqa: E402
from pyspark.ml.recommendation import ALSModel  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from shelfwise.operators import als, ids  # noqa: E402
from shelfwise.plans import pipelines  # noqa: E402
from shelfwise.schema import ITEM, USER  # noqa: E402
from shelfwise.session import ensure_checkpoint_dir  # noqa: E402
from shelfwise.sources import sinks  # noqa: E402
from shelfwise.sources.tables import read_table  # noqa: E402


def _dictionary(spark: SparkSession, path: str | None):
    if path is None:
        return None
    if path.endswith(".json"):
        return sinks.read_json_dictionary(spark, path)
    return sinks.read_dictionary(spark, path)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    ap = argparse.ArgumentParser(prog="shelfwise")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p2 = sub.add_parser("preprocess")
    p2.add_argument("--interactions", required=True)
    p2.add_argument("--out", required=True)
    p1 = sub.add_parser("als")
    p1.add_argument("--interactions", required=True)
    p1.add_argument("--out", required=True)
    p1.add_argument("--user-map")
    p1.add_argument("--item-map")
    p1.add_argument("--k", type=int, default=10)
    p1.add_argument("--rank", type=int, default=10)
    p1.add_argument("--max-iter", type=int, default=10)
    p1.add_argument("--reg-param", type=float, default=0.1)
    p3 = sub.add_parser("neural")
    p3.add_argument("--matrix", required=True)
    p3.add_argument("--out", required=True)
    p3.add_argument("--rank", type=int, default=32)
    p4 = sub.add_parser("serve")
    p4.add_argument("--models", required=True)
    p4.add_argument("--users", required=True)
    p4.add_argument("--out", required=True)
    p4.add_argument("--exclude")
    p4.add_argument("--k", type=int, default=10)
    for p in (p1, p2, p3, p4):
        p.add_argument("--format", default="parquet")
    a = ap.parse_args(argv)

    spark = spark or SparkSession.builder.appName(f"shelfwise-{a.cmd}").getOrCreate()
    ensure_checkpoint_dir(spark)
    if a.cmd == "preprocess":
        pipelines.run_preprocess(read_table(spark, a.interactions, a.format), a.out, a.format)
    elif a.cmd == "als":
        params = als.AlsParams(rank=a.rank, max_iter=a.max_iter, reg_param=a.reg_param)
        pipelines.run_als(
            read_table(spark, a.interactions, a.format), a.k, params, a.out,
            user_dictionary=_dictionary(spark, a.user_map),
            item_dictionary=_dictionary(spark, a.item_map),
        )
    elif a.cmd == "neural":
        matrix = read_table(spark, a.matrix, a.format)
        user_dict, item_dict = ids.build_dictionary(matrix, USER), ids.build_dictionary(matrix, ITEM)
        sinks.write_dictionary(user_dict, os.path.join(a.out, "user_dictionary"))
        sinks.write_dictionary(item_dict, os.path.join(a.out, "item_dictionary"))
        user_dict = sinks.read_dictionary(spark, os.path.join(a.out, "user_dictionary"))
        item_dict = sinks.read_dictionary(spark, os.path.join(a.out, "item_dictionary"))
        indexed = ids.index_interactions(matrix, user_dict, item_dict)
        run = pipelines.run_neural(indexed, rank=a.rank, model_dir=a.out)
        sinks.append_metrics(run.test_metrics, os.path.join(a.out, "metrics"))
    elif a.cmd == "serve":
        model = PipelineModel.load(sinks.latest_model_path(spark, os.path.join(a.models, "latest")))
        uf, itf = als.factors(ALSModel.load(os.path.join(a.models, "als_factors")))
        user_dict = sinks.read_dictionary(spark, os.path.join(a.models, "user_dictionary"))
        item_dict = sinks.read_dictionary(spark, os.path.join(a.models, "item_dictionary"))
        users = ids.encode(read_table(spark, a.users, a.format).select(USER), user_dict, USER)
        excl = None
        if a.exclude:
            pairs = read_table(spark, a.exclude, a.format).select(USER, ITEM)
            excl = ids.index_interactions(pairs, user_dict, item_dict)
        pipelines.run_serving(users, uf, itf, a.k, excl, model, out_path=a.out, fmt=a.format,
                              user_dictionary=user_dict, item_dictionary=item_dict)


if __name__ == "__main__":
    main()
