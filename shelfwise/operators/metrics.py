"""Evaluation metrics.

Pooled semantics of the reference are kept on purpose:

* precision, recall and NDCG are pooled totals, not per-user averages;
* a test pair that occurs twice counts twice (the joins are not
  de-duplicated) in hits, in relevant rows and in DCG;
* users without recommendations still count in recall's denominator;
* IDCG counts every tie that passes ``rank <= k``.

Every global total is a one-row aggregate; several totals are combined with
scalar subqueries into one row, never by collecting rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.columns import discount, ratio_or_zero
from shelfwise.operators.ranking import rank_groups_upto, rank_per_user_upto
from shelfwise.schema import ITEM, RATING, USER

EPS = 1e-7


def _one_row(spark, **scalars) -> DataFrame:
    return spark.range(1).select(*[col.alias(name) for name, col in scalars.items()])


def relevant_items(test: DataFrame, threshold: float = 4.0, rating: str = RATING) -> DataFrame:
    """Test rows with ``rating >= threshold``."""
    return test.filter(F.col(rating) >= F.lit(threshold))


def top_ranked(recs: DataFrame, k: int, score: str = "predicted_rating",
               user: str = USER) -> DataFrame:
    """E1 + B8: ``rank()`` of each recommendation by score, ``rank <= k``."""
    return rank_per_user_upto(recs, score, k, out="rec_rank", user=user)


def hits(top_k_recs: DataFrame, relevant: DataFrame) -> DataFrame:
    """Recommendations that match a relevant test row (inner join on
    the pair; a duplicated test pair yields two hits)."""
    return top_k_recs.join(relevant, [USER, ITEM], "inner")


def pair_counts(test: DataFrame, threshold: float = 4.0) -> DataFrame:
    """Test rows per ``(user, item)`` pair: ``n_test`` rows with a rating,
    ``n_rel`` of them relevant. A partial aggregate, so a pair copied millions of times is
    combined map-side; joining recommendations to it never fans out."""
    return test.groupBy(USER, ITEM).agg(
        F.count(F.col(RATING)).alias("n_test"),
        F.sum(F.when(F.col(RATING) >= F.lit(threshold), 1).otherwise(0)).alias("n_rel"),
    )


def _rec_side(recs: DataFrame, test: DataFrame, k: int, threshold: float, score: str) -> DataFrame:
    """One row ``total_recs, hits, dcg``: the top-k recommendations left-joined
    to the pair counts. ``hits`` and ``dcg`` equal the row-level joins of the
    reference (each duplicate test row counts once more)."""
    top = top_ranked(recs, k, score).select(USER, ITEM, "rec_rank")
    j = top.join(pair_counts(test, threshold), [USER, ITEM], "left")
    return j.agg(
        F.count(F.lit(1)).alias("total_recs"),
        F.coalesce(F.sum("n_rel"), F.lit(0)).alias("hits"),
        F.coalesce(F.sum(F.coalesce(F.col("n_test"), F.lit(0)) * discount("rec_rank")), F.lit(0.0)).alias("dcg"),
    )


def _scalars(row: DataFrame, names) -> dict:
    """Fields of a one-row DataFrame as scalar subqueries (one subquery)."""
    packed = row.select(F.struct(*names).alias("_r")).scalar()
    return {n: packed[n] for n in names}


def precision_recall(recs: DataFrame, test: DataFrame, k: int = 10,
                     threshold: float = 4.0, score: str = "predicted_rating") -> DataFrame:
    """J8/J9 (+C1, D3, D5): one row ``hits, total_recs, total_relevant,
    precision_at_k, recall_at_k``, pooled over users; users without
    recommendations still count in recall's denominator."""
    spark = recs.sparkSession
    rec = _scalars(_rec_side(recs, test, k, threshold, score), ["hits", "total_recs"])
    n_rel = relevant_items(test, threshold).agg(F.count(F.lit(1))).scalar()
    row = _one_row(spark, hits=rec["hits"], total_recs=rec["total_recs"], total_relevant=n_rel)
    return row.select(
        "*",
        ratio_or_zero("hits", "total_recs").alias("precision_at_k"),
        ratio_or_zero("hits", "total_relevant").alias("recall_at_k"),
    )


def dcg(recs: DataFrame, test: DataFrame, k: int = 10, score: str = "predicted_rating") -> DataFrame:
    """Per-recommendation gains (C2 + B9 + H2): recommendations left-joined
    to the test rows; a matched row gains ``1/log2(rec_rank + 1)`` (binary
    gain, no relevance threshold), an unmatched one 0."""
    top = top_ranked(recs, k, score).select(USER, ITEM, "rec_rank")
    truth = test.select(USER, ITEM, F.col(RATING).alias("_test_rating"))
    joined = top.join(truth, [USER, ITEM], "left")
    return joined.withColumn(
        "gain", F.when(F.col("_test_rating").isNotNull(), discount("rec_rank")).otherwise(F.lit(0.0))
    ).drop("_test_rating")


def ideal_dcg_terms(test: DataFrame, k: int = 10) -> DataFrame:
    """IDCG terms (E2 + B8 + H2) without a row-level window: the rank of each
    ``(user, rating)`` group (see :func:`rank_groups_upto`); each group
    passing ``rank <= k`` contributes ``count / log2(rank + 1)``."""
    ranked = rank_groups_upto(test, RATING, k, out="test_rank")
    return ranked.withColumn("idcg", F.col("_n") * discount("test_rank"))


def ndcg(recs: DataFrame, test: DataFrame, k: int = 10, score: str = "predicted_rating") -> DataFrame:
    """J10 (+C2, D4, D5): one row ``dcg, idcg, ndcg_at_k``, pooled over users."""
    spark = recs.sparkSession
    total_dcg = _rec_side(recs, test, k, 4.0, score).select("dcg").scalar()
    total_idcg = ideal_dcg_terms(test, k).agg(F.coalesce(F.sum("idcg"), F.lit(0.0))).scalar()
    row = _one_row(spark, dcg=total_dcg, idcg=total_idcg)
    return row.select("*", ratio_or_zero("dcg", "idcg").alias("ndcg_at_k"))


def rating_errors(predictions: DataFrame, label: str = RATING,
                  prediction: str = "prediction") -> DataFrame:
    """``rmse`` and ``mae`` in one aggregate (rows with a null
    prediction are skipped, as the regression evaluator does)."""
    valid = predictions.filter(F.col(prediction).isNotNull() & F.col(label).isNotNull())
    err = F.col(label).cast("double") - F.col(prediction).cast("double")
    return valid.agg(
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        F.count(F.lit(1)).alias("n"),
    )


def binary_metrics(scored: DataFrame, label: str = "label",
                   probability: str = "probability") -> DataFrame:
    """Mean binary cross-entropy over rows (p clamped to
    ``[eps, 1-eps]``) and accuracy at 0.5."""
    p = F.least(F.greatest(F.col(probability).cast("double"), F.lit(EPS)), F.lit(1.0 - EPS))
    y = F.col(label).cast("double")
    loss = -(y * F.log(p) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - p))
    correct = ((F.col(probability) > 0.5).cast("double") == y).cast("double")
    return scored.agg(
        F.avg(loss).alias("bce"), F.avg(correct).alias("accuracy"), F.count(F.lit(1)).alias("n")
    )


def metric_report(recs: DataFrame, test: DataFrame, predictions: DataFrame, k: int = 10,
                  threshold: float = 4.0, score: str = "predicted_rating") -> DataFrame:
    """One row ``rmse, mae, precision_at_k, recall_at_k, ndcg_at_k, k``
    from four one-row aggregates (errors; recommendations x pair counts;
    relevant rows; ideal DCG). Persist ``recs`` and ``test`` first when they
    are expensive to recompute."""
    spark = recs.sparkSession
    err = _scalars(rating_errors(predictions), ["rmse", "mae"])
    rec = _scalars(_rec_side(recs, test, k, threshold, score), ["hits", "total_recs", "dcg"])
    n_rel = relevant_items(test, threshold).agg(F.count(F.lit(1))).scalar()
    idcg = ideal_dcg_terms(test, k).agg(F.coalesce(F.sum("idcg"), F.lit(0.0))).scalar()
    row = _one_row(spark, rmse=err["rmse"], mae=err["mae"], hits=rec["hits"],
                   total_recs=rec["total_recs"], dcg=rec["dcg"], total_relevant=n_rel, idcg=idcg)
    return row.select(
        "rmse",
        "mae",
        ratio_or_zero("hits", "total_recs").alias("precision_at_k"),
        ratio_or_zero("hits", "total_relevant").alias("recall_at_k"),
        ratio_or_zero("dcg", "idcg").alias("ndcg_at_k"),
        F.lit(k).alias("k"),
    )


def per_user_ranking(recs: DataFrame, test: DataFrame, k: int = 10, threshold: float = 4.0) -> DataFrame:
    """One row per user with a relevant test item: ``n_rel, hits,
    precision_at_k, recall_at_k, average_precision, reciprocal_rank,
    ndcg_at_k``. ``recs`` holds ``(user, item, rank)`` with ranks from 1; an
    item counts once, however many test rows it has. A user without
    recommendations scores 0. At most k rows per user are grouped."""
    relevant = relevant_items(test, threshold).select(USER, ITEM).distinct()
    top = recs.where(F.col("rank") <= k).select(USER, ITEM, "rank")
    judged = top.join(relevant.withColumn("_rel", F.lit(1)), [USER, ITEM], "left").withColumn(
        "_rel", F.coalesce("_rel", F.lit(0)))
    w = Window.partitionBy(USER).orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    judged = judged.withColumn("_so_far", F.sum("_rel").over(w))
    hit = F.col("_rel") == 1
    own = judged.groupBy(USER).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_rel").alias("hits"), F.min(F.when(hit, F.col("rank"))).alias("_first"),
        F.sum(F.when(hit, F.col("_so_far") / F.col("rank")).otherwise(0.0)).alias("_ap"),
        F.sum(F.when(hit, discount("rank")).otherwise(0.0)).alias("_dcg"),
    )
    truth = relevant.groupBy(USER).agg(F.count(F.lit(1)).alias("n_rel"))
    best = F.least(F.col("n_rel"), F.lit(k))
    ideal = F.aggregate(F.sequence(F.lit(1), best.cast("int")), F.lit(0.0), lambda acc, i: acc + discount(i))
    return truth.join(own, USER, "left").select(
        USER, "n_rel", F.coalesce("hits", F.lit(0)).alias("hits"),
        F.coalesce(F.col("hits") / F.col("_n"), F.lit(0.0)).alias("precision_at_k"),
        (F.coalesce("hits", F.lit(0)) / F.col("n_rel")).alias("recall_at_k"),
        (F.coalesce("_ap", F.lit(0.0)) / best).alias("average_precision"),
        F.coalesce(F.lit(1.0) / F.col("_first"), F.lit(0.0)).alias("reciprocal_rank"),
        (F.coalesce("_dcg", F.lit(0.0)) / ideal).alias("ndcg_at_k"),
    )


def mean_ranking(per_user: DataFrame) -> DataFrame:
    """Per-user metrics averaged over users, one row."""
    return per_user.agg(
        F.count(F.lit(1)).alias("users"), F.avg("precision_at_k").alias("mean_precision"),
        F.avg("recall_at_k").alias("mean_recall"), F.avg("average_precision").alias("map_at_k"),
        F.avg("reciprocal_rank").alias("mrr_at_k"), F.avg("ndcg_at_k").alias("mean_ndcg"),
        F.avg((F.col("hits") > 0).cast("double")).alias("hit_rate"),
    )
