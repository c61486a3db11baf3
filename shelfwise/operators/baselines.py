"""Simple recommenders and predictors fitted on a training part.

They are the SQL-expressible inputs the ranking and error metrics are tested
with (the metrics do not care where scores come from), and reasonable
baselines in their own right: any model has to beat them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.schema import ITEM, RATING, SCORE, USER


def item_popularity(train: DataFrame, item: str = ITEM) -> DataFrame:
    """``(item_id, score)``: rows per item, a partial aggregate (a hot item
    is combined map-side)."""
    return train.groupBy(item).agg(F.count(F.lit(1)).cast("double").alias(SCORE))


def popular_items(train: DataFrame, k: int, item: str = ITEM) -> DataFrame:
    """The ``k`` items with most rows, ties broken by the smaller item id,
    with their 1-based ``rank``. A take-ordered top-k: each task keeps k rows."""
    top = item_popularity(train, item).orderBy(F.desc(SCORE), F.asc(item)).limit(k)
    return top.withColumn(
        "rank",
        # k rows only: the window's single partition is bounded by k.
        F.row_number().over(Window.orderBy(F.desc(SCORE), F.asc(item))),
    )


def recommend_popular(users: DataFrame, train: DataFrame, k: int,
                      user: str = USER, item: str = ITEM) -> DataFrame:
    """Same top-k list for every user: ``(user_id, item_id, score, rank)``.

    The list is at most ``k`` rows; it is folded into one array by a scalar
    subquery, so each user row just explodes that constant array (no join).
    """
    top = popular_items(train, k, item)
    packed = top.agg(
        F.sort_array(F.collect_list(F.struct(F.col("rank"), F.col(item), F.col(SCORE)))).alias("recs")
    )
    return users.select(F.col(user), F.inline(packed.scalar())).select(
        user, item, SCORE, F.col("rank").cast("int").alias("rank")
    )


def item_mean_predictions(pairs: DataFrame, train: DataFrame,
                          item: str = ITEM, rating: str = RATING) -> DataFrame:
    """``pairs`` + ``prediction``: the item's mean training rating, else the
    global mean (cold items). Left join on item; the global mean is a scalar
    subquery."""
    means = train.groupBy(item).agg(F.avg(F.col(rating).cast("double")).alias("_item_mean"))
    global_mean = train.agg(F.avg(F.col(rating).cast("double"))).scalar()
    return (
        pairs.join(means, item, "left")
        .withColumn("prediction", F.coalesce(F.col("_item_mean"), global_mean))
        .drop("_item_mean")
    )


def positive_share_probabilities(pairs: DataFrame, train: DataFrame, threshold: float = 4.0,
                                 item: str = ITEM, rating: str = RATING) -> DataFrame:
    """``pairs`` + ``probability``: the item's smoothed share of training
    ratings ``>= threshold``, ``(n_pos + 1) / (n + 2)``; 0.5 for cold items."""
    shares = train.groupBy(item).agg(
        F.sum(F.when(F.col(rating) >= threshold, 1).otherwise(0)).alias("_pos"),
        F.count(F.lit(1)).alias("_n"),
    )
    joined = pairs.join(shares, item, "left")
    prob = (F.coalesce(F.col("_pos"), F.lit(0)) + F.lit(1.0)) / (
        F.coalesce(F.col("_n"), F.lit(0)) + F.lit(2.0)
    )
    return joined.withColumn("probability", prob).drop("_pos", "_n")
