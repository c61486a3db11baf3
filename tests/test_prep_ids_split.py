"""Hand frames for cleaning, dictionaries and splits."""

import json

import pytest

from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfwise.operators import ids, prep, split
from shelfwise.sources import tables


def test_null_filter_runs_before_dedupe(spark):
    # The reference drops duplicates first: if the null-rated copy survives,
    # the key disappears. Filtering first keeps the rated copy.
    df = spark.createDataFrame(
        [("u", "i", None, 1), ("u", "i", 5, 1)],
        "user_id string, item_id string, rating bigint, timestamp bigint",
    )
    out = prep.preprocess_interactions(df).collect()
    assert len(out) == 1 and out[0]["rating"] == 5


def test_dedupe_survivor_is_deterministic(spark):
    df = spark.createDataFrame(
        [(1, 2, 3, 10), (1, 2, 5, 10), (1, 2, 4, 10), (1, 3, 1, 10)],
        "user_id long, item_id long, rating int, ts long",
    )
    for parts in (1, 3):
        out = {(r.user_id, r.item_id): r.rating
               for r in prep.dedupe(df.repartition(parts), ["user_id", "item_id", "ts"]).collect()}
        assert out == {(1, 2): 5, (1, 3): 1}


def test_null_keys_compare_equal_in_dedupe(spark):
    df = spark.createDataFrame(
        [(None, 2, 3, 10), (None, 2, 4, 10)], "user_id long, item_id long, rating int, ts long"
    )
    out = prep.dedupe(df, ["user_id", "item_id", "ts"]).collect()
    assert len(out) == 1 and out[0]["rating"] == 4


def test_user_item_matrix_mean(spark):
    df = spark.createDataFrame([(1, 1, 2), (1, 1, 5), (2, 1, 3)], "user_id long, item_id long, rating int")
    out = {(r.user_id, r.item_id): r.rating for r in prep.user_item_matrix(df).collect()}
    assert out == {(1, 1): 3.5, (2, 1): 3.0}


def test_epoch_to_timestamp_is_utc_wall_clock(spark):
    import datetime as dt

    df = spark.createDataFrame([("u", "i", 1, 86400 + 3600)],
                               "user_id string, item_id string, rating bigint, timestamp bigint")
    out = prep.preprocess_interactions(df).first()
    assert out["timestamp"] == dt.datetime(1970, 1, 2, 1, 0, 0)


def test_dictionary_is_a_sorted_bijection_independent_of_partitions(spark):
    keys = spark.range(0, 1000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    expected = {k: i for i, k in enumerate(sorted(f"k{n}" for n in range(1000)))}
    for n in (1, 3, 7):
        got = {r.key: r.idx for r in ids.build_dictionary(keys.repartition(5), "key", n).collect()}
        assert got == expected


def test_dictionary_skips_nulls_and_duplicates(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("a",)], "key string")
    got = sorted((r.key, r.idx) for r in ids.build_dictionary(df, "key").collect())
    assert got == [("a", 0), ("b", 1)]


def test_encode_drops_unknown_and_decode_falls_back(spark):
    d = spark.createDataFrame([("a", 0), ("b", 1)], "key string, idx int")
    df = spark.createDataFrame([("a", 1), ("zz", 2), ("b", 3)], "user_id string, v int")
    enc = ids.encode(df, d, "user_id").collect()
    assert sorted((r.user_id, r.v) for r in enc) == [(0, 1), (1, 3)]
    back = spark.createDataFrame([(0,), (7,)], "user_id int")
    dec = sorted(r.user_id for r in ids.decode(back, d, "user_id").collect())
    assert dec == ["7", "a"]


def test_dictionary_from_json(spark):
    text = spark.createDataFrame([(json.dumps({"user_0": 0, "user_1": 1}),)], "value string")
    got = sorted((r.key, r.idx) for r in ids.dictionary_from_json(text).collect())
    assert got == [("user_0", 0), ("user_1", 1)]


def test_split_parts_are_disjoint_cover_and_stable(spark):
    inter = tables.interactions(spark, SF_SMALL)
    a = split.assign_parts(inter, (0.8, 0.1, 0.1), ("train", "val", "test"))
    b = split.assign_parts(inter.repartition(7), (0.8, 0.1, 0.1), ("train", "val", "test"))
    key = ["user_id", "item_id", "ts", "rating"]
    rows_a = sorted(tuple(r) for r in a.select(*key, "part").collect())
    rows_b = sorted(tuple(r) for r in b.select(*key, "part").collect())
    assert rows_a == rows_b
    assert len(rows_a) == inter.count()
    # The same pair never lands in two parts.
    per_pair = a.groupBy("user_id", "item_id").agg(F.countDistinct("part").alias("n"))
    assert per_pair.filter("n > 1").count() == 0
    shares = {r.part: r["count"] for r in a.groupBy("part").count().collect()}
    total = sum(shares.values())
    assert 0.7 < shares["train"] / total < 0.9


def test_random_split_is_offered(spark):
    parts = split.random_split(spark.range(100), (0.5, 0.5), seed=1)
    assert sum(p.count() for p in parts) == 100


def test_split_of_small_weights_is_not_empty(spark):
    inter = tables.interactions(spark, SF_SMALL)
    parts = split.hash_split(inter, (0.997, 0.003))
    n = parts["test"].count()
    assert 0 < n < 60 and n + parts["train"].count() == inter.count()


def test_split_refuses_weights_below_its_resolution():
    assert split.thresholds((0.5, 0.5, 0.0)) == [1 << 31, 1 << 32]
    with pytest.raises(ValueError):
        split.thresholds((1.0, 1e-12))


def test_kept_parts_are_hashed_once(spark):
    import hashlib

    from shelfwise.plans.pipelines import stored

    pairs = [(u, i, 1) for u in [None, *range(30)] for i in [None, *range(20)]] * 2  # every row twice
    df = spark.createDataFrame(pairs, "user_id int, item_id int, rating int").repartition(3)
    number = lambda u, i: int(hashlib.md5(
        ",".join(str(v) for v in (u, i) if v is not None).encode()).hexdigest()[:8], 16)
    rows = lambda d: sorted(map(repr, (tuple(r) for r in d.collect())))
    for weights in ((0.8, 0.2), (0.5, 0.5), (1.0, 0.0), (0.0, 1.0)):
        cut = split.thresholds(weights)[0]
        for keep in (None, stored):
            parts = split.hash_split(df, weights, keep=keep)
            assert rows(parts["train"]) == sorted(repr(r) for r in pairs if number(*r[:2]) < cut)
            assert rows(parts["test"]) == sorted(repr(r) for r in pairs if number(*r[:2]) >= cut)
    for part in split.train_test_split(df, keep=stored).values():
        assert part.columns == df.columns
        assert "md5" not in part._jdf.queryExecution().toString()


def test_als_queries_store_their_columns_and_parts_once(spark, monkeypatch):
    from shelfwise.plans import model_queries

    kept = []
    monkeypatch.setattr(model_queries, "stored", lambda df: kept.append(df) or df)
    rows = [(u, i, (u + i) % 5 + 1, 7) for u in range(12) for i in range(8)]
    raw = spark.createDataFrame(rows, "user_id int, item_id int, rating bigint, timestamp bigint").select(
        F.concat(F.lit("user_"), "user_id").alias("user_id"), F.concat(F.lit("item_"), "item_id").alias("item_id"),
        "rating", "timestamp")
    monkeypatch.setattr(model_queries.tables, "raw_interactions", lambda *_: raw)
    _, parts = model_queries.fitted(spark, "unused", rank=2)
    assert [df.columns for df in kept] == [["user_id", "item_id", "rating"], ["user_id", "item_id", "rating", "part"]]
    assert sum(p.count() for p in parts.values()) == len(rows)
    assert model_queries.indexed_parts(spark, "unused")["test"].columns == raw.columns


def test_best_row_equals_a_sorted_choice(spark):
    import datetime as dt
    import random

    from pyspark.sql import Window
    from shelfwise.operators.latest import best_row

    rng = random.Random(3)
    day = lambda: rng.choice([None, dt.date(1969, 12, 31), dt.date(2024, 2, 29)])
    rows = [(rng.randint(0, 3), rng.choice([None, -(2**31), -1, 0, 2**31 - 1]), day(),
             rng.choice([None, True, False])) for _ in range(300)]
    df = spark.createDataFrame(rows, "k int, a int, d date, f boolean")
    for order in (["a", "d", "f"], ["f", "d", "a"]):
        w = Window.partitionBy("k").orderBy(*[F.desc_nulls_last(c) for c in order])
        want = df.withColumn("n", F.row_number().over(w)).where("n = 1").drop("n")
        assert sorted(map(str, best_row(df, ["k"], order).collect())) == sorted(map(str, want.collect()))
    instants = spark.sql("""SELECT k, timestamp_micros(t) AS t, timestamp_ntz '1969-07-20 20:17:40.123456' AS n
        FROM VALUES (1, -5L), (1, 7L), (2, NULL) AS v(k, t)""")
    got = {r.k: (r.t, r.n) for r in best_row(instants, ["k"], ["t", "n"]).collect()}
    assert got[1][0].microsecond == 7 and got[2][0] is None and got[1][1] == dt.datetime(1969, 7, 20, 20, 17, 40, 123456)


def test_best_row_with_text_falls_back_to_a_struct(spark):
    df = spark.createDataFrame([(1, "a", 2), (1, "b", 1)], "k int, s string, n int")
    assert [tuple(r) for r in prep.dedupe(df, ["k"], prefer="n").collect()] == [(1, "a", 2)]


def test_dense_index_keeps_the_callers_cache(spark):
    df = spark.range(50).select((F.col("id") * 7 % 50).alias("x")).persist()
    df.count()
    assert ids.dense_index(df, ["x"]).where("x <> idx").count() == 0
    assert df.storageLevel.useMemory
    df.unpersist()


def test_encode_does_not_sort_the_interactions(spark, monkeypatch):
    """Both lookups sorted all rows by their string ids, which spills at size."""
    rows = spark.createDataFrame([("a", "x", 1), ("b", "y", 2), ("b", None, 3), (None, "x", 4), ("c", "x", 5)],
                                 "user_id string, item_id string, rating int")
    d = spark.createDataFrame([("a", 0), ("b", 1), ("x", 2), ("y", 3)], "key string, idx int")
    monkeypatch.setattr(ids, "BROADCAST_KEYS", 0, raising=False)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        out = ids.index_interactions(rows, d, d)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ShuffledHashJoin") == 2 and "Sort" not in plan.replace("SortMerge", "Sort")
        assert sorted(map(tuple, out.collect())) == [(0, 2, 1), (1, 3, 2)]
    finally:
        spark.conf.set(key, before)
