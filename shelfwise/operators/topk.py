"""Top-k selection, exclusion lists and nested recommendation lists
(F1, F2, B13, B14, C6, H3, H4, B6).

Top-k per user is ``row_number() <= k`` over a window partitioned by user:
Catalyst turns that shape into a partial ``WindowGroupLimit`` on the map side,
so even a user holding a third of all candidate rows ships at most ``k`` rows
per map task to the final window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.schema import ITEM, RATING, SCORE, USER

def topk_per_user(
    scores: DataFrame,
    k: int,
    user: str = USER,
    item: str = ITEM,
    score: str = SCORE,
    rank: str = "rank",
) -> DataFrame:
    """F2: the ``k`` best items per user, score descending, ties broken by
    the smaller item id, with a 1-based ``rank``. All users in one job."""
    if k <= 0:
        return scores.limit(0).withColumn(rank, F.lit(0))
    w = Window.partitionBy(user).orderBy(F.desc(score), F.asc(item))
    return scores.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def topk_single_user(
    scores: DataFrame,
    user_value,
    k: int,
    user: str = USER,
    item: str = ITEM,
    score: str = SCORE,
) -> DataFrame:
    """top ``k`` for one user (filter pushed to the scan, then a
    take-ordered limit: each task keeps k rows)."""
    top = (
        scores.filter(F.col(user) == F.lit(user_value))
        .orderBy(F.desc(score), F.asc(item))
        .limit(max(k, 0))
    )
    # At most k rows: the unpartitioned window is bounded by k.
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(score), F.asc(item))))


def exclude_items(scores: DataFrame, exclusions: DataFrame | None,
                  user: str = USER, item: str = ITEM) -> DataFrame:
    """Drop ``(user, item)`` pairs listed in ``exclusions`` (anti join on
    the pair, so a user with a huge list is spread over many tasks). An
    absent list excludes nothing."""
    if exclusions is None:
        return scores
    return scores.join(exclusions.select(user, item), [user, item], "left_anti")


def topk_excluding(scores: DataFrame, exclusions: DataFrame | None, k: int,
                   user: str = USER, item: str = ITEM, score: str = SCORE) -> DataFrame:
    """B13 + F2: exclusion strictly before the top-k cut."""
    return topk_per_user(exclude_items(scores, exclusions, user, item), k, user, item, score)


def topk_from_ranked_list(
    users: DataFrame,
    ranked: DataFrame,
    exclusions: DataFrame | None,
    k: int,
    user: str = USER,
    item: str = ITEM,
    score: str = SCORE,
    pos: str = "pos",
    block: int = 1024,
    head: int = 1024,
    salts: int = 16,
) -> DataFrame:
    """Exact per-user top-k from one global ranked list minus per-user
    exclusions (e.g. most popular items a user has not seen).

    ``ranked`` holds ``(item, score, pos)`` with ``pos`` dense from 1. A
    user's answer lies within the first ``need = k + e_u`` positions, ``e_u``
    being the number of the user's excluded items that are in the list, so
    each user gets exactly ``need`` candidates, never the catalogue.

    The first ``head`` positions, a constant number of them, travel as one
    array (scalar subquery) and every user takes a slice of it: no join, so no
    key that all users share. Only users who need more join the rest of the
    list, by block and salt (``salts`` copies of the list's tail, users spread
    over them), with ``pos <= need`` evaluated in the join: at most one block
    too many per user. The anti join is on the ``(user, item)`` pair, so one
    user with a huge exclusion list is still spread over many tasks.
    """
    users = users.select(user).distinct()
    if exclusions is not None:
        excl = exclusions.select(user, item).distinct()
        in_list = excl.join(ranked.select(item), item, "left_semi")
        counts = in_list.groupBy(user).agg(F.count(F.lit(1)).alias("_e"))
        need = users.join(counts, user, "left").select(
            user, (F.lit(k) + F.coalesce(F.col("_e"), F.lit(0))).alias("_need")
        )
    else:
        excl = None
        need = users.select(user, F.lit(k).cast("bigint").alias("_need"))
    if k <= 0:
        return need.limit(0).select(
            user, F.lit(None).cast("bigint").alias(item), F.lit(None).cast("double").alias(score),
            F.lit(0).alias("rank"),
        )
    listed = ranked.select(item, score, F.col(pos).cast("bigint").alias(pos))
    first = (
        listed.filter(F.col(pos) <= head)
        .agg(F.sort_array(F.collect_list(F.struct(pos, item, score))).alias("_head"))
        .scalar()
    )
    taken = F.slice(first, F.lit(1), F.least(F.col("_need"), F.lit(head)).cast("int"))
    cand = need.select(user, F.explode(taken).alias("_c")).select(
        user, F.col(f"_c.{item}").alias(item), F.col(f"_c.{score}").alias(score), F.col(f"_c.{pos}").alias(pos)
    )
    blk = lambda c: F.floor((c - F.lit(head + 1)) / F.lit(block)).cast("bigint")
    tail_users = (
        need.filter(F.col("_need") > head)
        .withColumn("_salt", F.pmod(F.xxhash64(user), F.lit(salts)).cast("int"))
        .withColumn("_blk", F.explode(F.sequence(F.lit(0).cast("bigint"), blk(F.col("_need")))))
    )
    tail = (
        listed.filter((F.col(pos) > head) & (F.col(pos) <= need.agg(F.max("_need")).scalar()))
        .withColumn("_blk", blk(F.col(pos)))
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    )
    more = tail_users.join(tail, ["_blk", "_salt"]).filter(F.col(pos) <= F.col("_need")).select(user, item, score, pos)
    cand = cand.unionByName(more)
    if excl is not None:
        cand = cand.join(excl, [user, item], "left_anti")
    w = Window.partitionBy(user).orderBy(F.asc(pos))
    return (
        cand.withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= k)
        .select(user, item, score, "rank")
    )


def topk_from_factors(user_vector: DataFrame, items: DataFrame, k: int, exclusions: DataFrame | None = None,
                      item: str = ITEM, vec: str = "features", score: str = SCORE) -> DataFrame:
    """F1 from a model: top-k for one user, ``(item, score, rank)``.

    ``user_vector`` is a one-row DataFrame with the user's vector; ``items`` is
    scanned once, every item scored by the dot product, and only the k best
    (ties by item id) leave each task. ``exclusions`` holds the items left out.
    """
    u = user_vector.select(F.col(vec).cast("array<double>")).scalar()
    both = items.select(item, F.col(vec).cast("array<double>").alias("_i"), u.alias("_u"))
    scored = both.select(item, F.aggregate(
        F.zip_with("_i", "_u", lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x).alias(score))
    if exclusions is not None:
        scored = scored.join(exclusions.select(item).distinct(), item, "left_anti")
    best = scored.where(F.col(score).isNotNull()).orderBy(F.desc(score), F.asc(item)).limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(score), F.asc(item))))  # k rows


def nest_recommendations(recs: DataFrame, user: str = USER, item: str = ITEM,
                         score: str = SCORE, rank: str = "rank") -> DataFrame:
    """Flat top-k rows -> ``(user, recommendations array<struct<item_id, rating>>)``
    in rank order, the shape ALS returns. Per user at most k entries."""
    packed = recs.groupBy(user).agg(
        F.sort_array(F.collect_list(F.struct(F.col(rank), F.col(item), F.col(score)))).alias("_r")
    )
    return packed.select(
        user,
        F.transform(
            "_r", lambda r: F.struct(r[item].alias(ITEM), r[score].alias(RATING))
        ).alias("recommendations"),
    )


def explode_recommendations(nested: DataFrame, user: str = USER,
                            score_out: str = "predicted_rating") -> DataFrame:
    """``array<struct<item_id, rating>>`` -> one row per entry with
    ``item_id`` and ``predicted_rating`` (struct fields by name)."""
    return nested.select(user, F.explode("recommendations").alias("rec")).select(
        user,
        F.col("rec.item_id").alias(ITEM),
        F.col("rec.rating").alias(score_out),
    )


def unknown_users(requested: DataFrame, known: DataFrame, user: str = USER) -> DataFrame:
    """Requested users the model does not know; they get no rows from
    :func:`restrict_to_users` (inner semantics) and are listed here."""
    return requested.select(user).distinct().join(known.select(user), user, "left_anti")


def restrict_to_users(recs: DataFrame, users: DataFrame, user: str = USER) -> DataFrame:
    """Keep only rows of the given users (semi join; duplicate user rows
    in ``users`` do not multiply the output)."""
    return recs.join(users.select(user), user, "left_semi")
