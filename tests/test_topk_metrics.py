"""Top-k, exclusion and metric rules on hand frames, and properties
against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import metrics, topk

SCORES = "user_id long, item_id long, score double"


def brute_topk(rows, k, excluded=frozenset()):
    by_user = {}
    for u, i, s in rows:
        if (u, i) not in excluded:
            by_user.setdefault(u, []).append((i, s))
    out = {}
    for u, items in by_user.items():
        items.sort(key=lambda t: (-t[1], t[0]))
        out[u] = [i for i, _ in items[:k]]
    return out


def as_lists(df):
    got = {}
    for r in df.orderBy("user_id", "rank").collect():
        got.setdefault(r.user_id, []).append(r.item_id)
    return got


def test_topk_ties_break_by_item(spark):
    rows = [(1, 5, 1.0), (1, 3, 1.0), (1, 4, 2.0), (1, 9, 0.5)]
    got = as_lists(topk.topk_per_user(spark.createDataFrame(rows, SCORES), 2))
    assert got == {1: [4, 3]}


def test_topk_k_zero_and_k_beyond_catalogue(spark):
    df = spark.createDataFrame([(1, 1, 1.0), (1, 2, 2.0)], SCORES)
    assert topk.topk_per_user(df, 0).count() == 0
    assert as_lists(topk.topk_per_user(df, 50)) == {1: [2, 1]}


def test_exclusion_happens_before_cut_and_can_empty_a_user(spark):
    rows = [(1, i, float(i)) for i in range(5)] + [(2, i, float(i)) for i in range(5)]
    excl = spark.createDataFrame([(1, 4), (1, 3)] + [(2, i) for i in range(5)], "user_id long, item_id long")
    got = as_lists(topk.topk_excluding(spark.createDataFrame(rows, SCORES), excl, 2))
    assert got == {1: [2, 1]}


def test_single_user_topk(spark):
    rows = [(1, 1, 3.0), (1, 2, 3.0), (2, 1, 9.0)]
    out = topk.topk_single_user(spark.createDataFrame(rows, SCORES), 1, 1).collect()
    assert [(r.item_id, r["rank"]) for r in out] == [(1, 1)]


@pytest.mark.parametrize("k", [1, 3, 10])
def test_ranked_list_topk_matches_brute_force(spark, k):
    rnd = random.Random(k)
    n_items, users = 40, list(range(12))
    ranked_rows = [(i, float(n_items - i // 2), i + 1) for i in range(n_items)]  # ties in score
    excluded = {(u, i) for u in users for i in range(n_items) if rnd.random() < 0.3}
    excluded |= {(0, i) for i in range(n_items)}  # user 0 excludes the whole catalogue
    excluded |= {(1, i) for i in range(30)}  # a heavy user
    ranked = spark.createDataFrame(ranked_rows, "item_id long, score double, pos long")
    ex = spark.createDataFrame(sorted(excluded) + [(3, 999)], "user_id long, item_id long")
    us = spark.createDataFrame([(u,) for u in users] + [(3,)], "user_id long")
    got = as_lists(topk.topk_from_ranked_list(us, ranked, ex, k, block=4))
    rows = [(u, i, s) for u in users for (i, s, _) in ranked_rows]
    want = brute_topk(rows, k, excluded)
    want = {u: v for u, v in want.items() if v}
    assert got == want


def test_nest_then_explode_round_trip(spark):
    recs = spark.createDataFrame(
        [(1, 7, 0.9, 1), (1, 8, 0.5, 2), (2, 7, 0.4, 1)], "user_id long, item_id long, score double, rank int"
    )
    nested = topk.nest_recommendations(recs)
    first = nested.filter("user_id = 1").first()
    assert [e.item_id for e in first.recommendations] == [7, 8]
    flat = sorted(tuple(r) for r in topk.explode_recommendations(nested).collect())
    assert flat == [(1, 7, 0.9), (1, 8, 0.5), (2, 7, 0.4)]


def test_unknown_and_restricted_users(spark):
    recs = spark.createDataFrame([(1, 1, 1.0), (2, 1, 1.0)], SCORES)
    wanted = spark.createDataFrame([(1,), (1,), (3,)], "user_id long")
    assert sorted(r.user_id for r in topk.restrict_to_users(recs, wanted).collect()) == [1]
    assert [r.user_id for r in topk.unknown_users(wanted, recs).collect()] == [3]


# ----------------------------------------------------------------- metrics

RECS = "user_id long, item_id long, predicted_rating double"
TEST = "user_id long, item_id long, rating double"


def test_pooled_precision_recall_with_duplicate_pair_and_absent_user(spark):
    recs = spark.createDataFrame([(1, 10, 0.9), (1, 11, 0.8)], RECS)
    # (1,10) occurs twice in the test set; user 2 has no recommendations.
    test = spark.createDataFrame([(1, 10, 5.0), (1, 10, 4.0), (1, 12, 2.0), (2, 10, 5.0)], TEST)
    r = metrics.precision_recall(recs, test, k=10).first()
    assert (r.hits, r.total_recs, r.total_relevant) == (2, 2, 3)
    assert r.precision_at_k == 1.0 and r.recall_at_k == pytest.approx(2 / 3)


def test_ndcg_binary_gain_and_ties_in_ideal(spark):
    recs = spark.createDataFrame([(1, 10, 0.9), (1, 11, 0.8)], RECS)
    # user 1: item 11 is in the test set with a low rating (binary gain still 1)
    test = spark.createDataFrame([(1, 11, 1.0), (1, 12, 5.0), (1, 13, 5.0)], TEST)
    r = metrics.ndcg(recs, test, k=2).first()
    dcg = 1 / math.log2(3)
    # ranks by rating: 12 and 13 tie at rank 1, 11 is rank 3 (> k=2)
    idcg = 2 * (1 / math.log2(2))
    assert r.dcg == pytest.approx(dcg) and r.idcg == pytest.approx(idcg)
    assert r.ndcg_at_k == pytest.approx(dcg / idcg)


def test_ideal_terms_equal_row_level_rank(spark):
    rnd = random.Random(3)
    rows = [(u, i, float(rnd.randint(1, 5))) for u in range(20) for i in range(rnd.randint(0, 30))]
    test = spark.createDataFrame(rows, TEST)
    k = 4
    from shelfwise.operators.ranking import rank_per_user_upto

    ranked = rank_per_user_upto(test, "rating", k, out="r")
    want = ranked.agg(F.sum(1.0 / F.log2(F.col("r") + 1))).first()[0]
    got = metrics.ideal_dcg_terms(test, k).agg(F.sum("idcg")).first()[0]
    assert got == pytest.approx(want)


def test_empty_test_set_gives_zeros(spark):
    recs = spark.createDataFrame([(1, 10, 0.9)], RECS)
    test = spark.createDataFrame([], TEST)
    pr = metrics.precision_recall(recs, test).first()
    nd = metrics.ndcg(recs, test).first()
    assert (pr.precision_at_k, pr.recall_at_k, nd.ndcg_at_k) == (0.0, 0.0, 0.0)


def test_rating_errors_and_binary_metrics(spark):
    pred = spark.createDataFrame([(4.0, 3.0), (2.0, 4.0), (1.0, None)], "rating double, prediction double")
    r = metrics.rating_errors(pred).first()
    assert r.rmse == pytest.approx(math.sqrt((1 + 4) / 2)) and r.mae == pytest.approx(1.5)
    scored = spark.createDataFrame([(1, 0.9), (0, 0.2), (1, 0.4), (0, 1.0)], "label int, probability double")
    b = metrics.binary_metrics(scored).first()
    eps = 1e-7
    want = -(math.log(0.9) + math.log(0.8) + math.log(0.4) + math.log(eps)) / 4
    assert b.bce == pytest.approx(want) and b.accuracy == 0.5


def test_grouped_row_rank_equals_window_rank(spark):
    from shelfwise.operators.ranking import rank_per_user_upto, rank_rows_upto

    rnd = random.Random(7)
    rows = [(u, i, float(rnd.randint(1, 5))) for u in range(15) for i in range(rnd.randint(0, 25))]
    rows += [(99, i, 5.0) for i in range(40)]  # one user, all tied: every row passes
    df = spark.createDataFrame(rows, TEST)
    a = sorted(tuple(r) for r in rank_per_user_upto(df, "rating", 3, out="r").collect())
    b = sorted(tuple(r) for r in rank_rows_upto(df, "rating", 3, out="r").select(*df.columns, "r").collect())
    assert a == b and sum(1 for r in a if r[0] == 99) == 40


def test_metric_report_matches_row_level_semantics_under_skew(spark):
    """Reference semantics done literally in pandas (row-level rank windows,
    fan-out joins) vs the pre-aggregated Spark operators, on data where one
    user holds a third of the rows, test pairs repeat and ratings tie."""
    import numpy as np
    import pandas as pd

    rnd = random.Random(11)
    test_rows = []
    for u in range(30):
        n = 300 if u == 0 else rnd.randint(0, 20)  # user 0: about a third of all rows
        for _ in range(n):
            test_rows.append((u, rnd.randint(0, 40), float(rnd.randint(1, 5))))
    test_rows += [(0, 3, 5.0)] * 25  # a pair copied many times
    rec_rows = [(u, i, float(rnd.randint(0, 3))) for u in range(25) for i in rnd.sample(range(41), 10)]
    k = 10
    test = spark.createDataFrame(test_rows, TEST)
    recs = spark.createDataFrame(rec_rows, RECS)
    pred = spark.createDataFrame([(r, r - 0.5) for _, _, r in test_rows], "rating double, prediction double")
    got = metrics.metric_report(recs, test, pred, k).first()

    t = pd.DataFrame(test_rows, columns=["user_id", "item_id", "rating"])
    r = pd.DataFrame(rec_rows, columns=["user_id", "item_id", "predicted_rating"])
    r["rec_rank"] = r.groupby("user_id")["predicted_rating"].rank(method="min", ascending=False)
    top = r[r.rec_rank <= k]
    rel = t[t.rating >= 4]
    hits = len(top.merge(rel, on=["user_id", "item_id"]))
    t["test_rank"] = t.groupby("user_id")["rating"].rank(method="min", ascending=False)
    joined = top.merge(t, on=["user_id", "item_id"], how="left", suffixes=("", "_t"))
    dcg = float(np.where(joined.rating.notna(), 1 / np.log2(joined.rec_rank + 1), 0).sum())
    idcg = float((1 / np.log2(t[t.test_rank <= k].test_rank + 1)).sum())
    assert got.precision_at_k == pytest.approx(hits / len(top))
    assert got.recall_at_k == pytest.approx(hits / len(rel))
    assert got.ndcg_at_k == pytest.approx(dcg / idcg)
    assert got.rmse == pytest.approx(0.5) and got.mae == pytest.approx(0.5)


@pytest.mark.parametrize("head,block", [(1, 1), (3, 2), (8, 4), (1024, 1024)])
def test_ranked_list_topk_in_head_and_tail(spark, head, block):
    """Users whose exclusions push them beyond the head find the rest."""
    ranked = spark.range(1, 41).select((100 - F.col("id")).alias("item_id"), (1.0 / F.col("id")).alias("score"),
                                       F.col("id").alias("pos"))
    seen = [(u, 100 - p) for u in range(1, 8) for p in range(1, 41) if p % 7 < u]
    excl = spark.createDataFrame(seen, "user_id long, item_id long")
    users = spark.range(0, 8).select(F.col("id").alias("user_id"))
    out = topk.topk_from_ranked_list(users, ranked, excl, 5, head=head, block=block, salts=3)
    got = sorted((r.user_id, r["rank"], r.item_id) for r in out.collect())
    want = []
    for u in range(8):
        free = [100 - p for p in range(1, 41) if (u, 100 - p) not in set(seen)][:5]
        want += [(u, n + 1, i) for n, i in enumerate(free)]
    assert got == want
