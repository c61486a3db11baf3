"""Physical-plan shape: the properties the operators rely on at scale."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfwise.operators import prep, scoring, topk
from shelfwise.plans.catalog import oracle_sql, queries
from shelfwise.sources import tables


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_topk_per_user_limits_map_side(spark):
    scores = spark.range(1000).select(
        (F.col("id") % 3).alias("user_id"), F.col("id").alias("item_id"), F.rand(1).alias("score")
    )
    p = plan(topk.topk_per_user(scores, 5))
    # partial limit before the shuffle, final after it
    assert p.count("WindowGroupLimit") == 2
    assert re.search(r"WindowGroupLimit.*Partial", p, re.S)


@pytest.mark.parametrize("keys", [["user_id", "item_id", "ts"], ["user_id", "item_id"]])
def test_dedupe_combines_before_the_shuffle(spark, keys):
    df = tables.interactions(spark, SF_SMALL)
    p = plan(prep.dedupe(df, keys))
    # partial hash aggregate (map side) under the exchange, final above it
    assert re.search(r"HashAggregate\(keys=.*functions=\[partial_max", p)
    assert "Exchange hashpartitioning" in p and "SortAggregate" not in p


@pytest.mark.parametrize("name", ["dedupe_interactions", "preprocess_interactions", "upsert_latest"])
def test_choosing_a_row_does_not_sort(spark, name):
    assert "SortAggregate" not in plan(queries()[name](spark, SF_SMALL))


@pytest.mark.parametrize("name", ["als_recommendations", "als_topk_unseen", "mlp_topk", "topk_excluding_seen"])
def test_no_product_join_in_serving(spark, name):
    p = plan(queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "NestedLoop" not in p


def test_interaction_scan_reads_only_needed_columns(spark):
    df = tables.interactions(spark, SF_SMALL).select("user_id", "item_id")
    p = df._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    assert schemas, p
    for s in schemas:
        assert "l_quantity" not in s and "l_shipdate" not in s and "l_tax" not in s


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_no_cartesian_or_nested_loop_join(spark, name):
    if name.startswith("stream_"):
        pytest.skip("streaming queries run their stream while planning")
    p = plan(queries()[name](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in p, f"{name}: {bad}"


@pytest.mark.parametrize("users_per_bucket", [32_768, 50])
def test_scorer_shuffles_each_side_once(spark, users_per_bucket):
    vec = tables.vectors(spark, SF_SMALL)
    users = vec.select(F.col("vec_id").alias("user_id"), F.col("embedding").alias("features"))
    items = vec.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("features"))
    p = plan(scoring.topk_vectors(users, items, 5, users_per_bucket=users_per_bucket))
    below = p[p.index("FlatMapCoGroupsInPandas"):]
    # one exchange per side feeding the cogroup, nothing in between
    assert below.count("Exchange ") == 2
    if users_per_bucket == 50:  # several groups: hash-placed by (bucket, block)
        assert below.count("Exchange hashpartitioning") == 2


def test_stored_frames_are_compressed(spark):
    import os
    from urllib.parse import urlparse

    from shelfwise.plans.pipelines import stored

    rows = spark.range(20_000).selectExpr(
        "concat('user_', id % 500) user_id", "concat('item_', id % 700) item_id", "id % 5 rating",
        "if(id = 3, null, id) `timestamp`", "cast('2020-01-01' as timestamp_ntz) ts")
    kept = stored(rows)
    assert kept.schema == rows.schema and kept.exceptAll(rows).count() == 0 == rows.exceptAll(kept).count()
    files = [urlparse(f).path for f in kept.inputFiles()]
    assert files and sum(map(os.path.getsize, files)) < 20 * 20_000  # a checkpoint has 100 bytes a row
    empty = stored(rows.limit(0))
    assert empty.count() == 0 and empty.columns == rows.columns
