"""Collaborative filtering with Spark ML's ALS.

ALS is blocked matrix factorisation in the JVM: ratings are shuffled into
user and item blocks once, each half-iteration exchanges factor blocks.
``checkpointInterval`` cuts the iteration lineage through the shared
checkpoint folder (``spark.checkpoint.dir``), so a lost executor does not
replay all iterations, and the shuffles of the iterations before are deleted.
The fitted model is stored there too. Ids must be in the int range: index them with
:mod:`shelfwise.operators.ids` first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators import scoring
from shelfwise.schema import ITEM, RATING, USER
from shelfwise.session import ensure_checkpoint_dir, release_unused, scratch_path


@dataclass(frozen=True)
class AlsParams:
    """Defaults are the reference's: 10 iterations, regParam 0.1, rank 10,
    explicit feedback, cold-start rows dropped. It sets no seed; ours is
    fixed so refits are reproducible."""

    max_iter: int = 10
    reg_param: float = 0.1
    rank: int = 10
    implicit_prefs: bool = False
    alpha: float = 1.0
    nonnegative: bool = False
    seed: int = 42
    cold_start: str = "drop"
    num_blocks: int | None = None
    checkpoint_interval: int = 2


def fit(train: DataFrame, params: AlsParams = AlsParams(), user: str = USER,
        item: str = ITEM, rating: str = RATING) -> ALSModel:
    """Fit ALS on ``(user int, item int, rating)`` rows."""
    ensure_checkpoint_dir(train.sparkSession)
    als = ALS(
        maxIter=params.max_iter,
        regParam=params.reg_param,
        rank=params.rank,
        implicitPrefs=params.implicit_prefs,
        alpha=params.alpha,
        nonnegative=params.nonnegative,
        seed=params.seed,
        userCol=user,
        itemCol=item,
        ratingCol=rating,
        coldStartStrategy=params.cold_start,
        checkpointInterval=params.checkpoint_interval,
    )
    if params.num_blocks:
        als = als.setNumUserBlocks(params.num_blocks).setNumItemBlocks(params.num_blocks)
    model = _stored(als.fit(train.select(user, item, F.col(rating).cast("float").alias(rating))), train.sparkSession)
    release_unused(train.sparkSession)
    return model


def _stored(model: ALSModel, spark: SparkSession) -> ALSModel:
    """The model with its factors read from files: those of a fit hang on its
    last shuffles and cached blocks, which can go then."""
    path = scratch_path(spark, "als")
    model.write().save(path)
    for side in (model.userFactors, model.itemFactors):
        rdd = side._jdf.rdd()
        while not rdd.getStorageLevel().useMemory() and rdd.dependencies().nonEmpty():
            rdd = rdd.dependencies().head().rdd()  # one to one
        rdd.cleanShuffleDependencies(False)
        rdd.unpersist(False)
    return ALSModel.load(path)


def predict(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """``pairs`` + ``prediction``; with ``coldStartStrategy="drop"``
    pairs of a user or item unseen in training are dropped."""
    return model.transform(pairs)


def recommend_for_users(model: ALSModel, users: DataFrame, k: int,
                        user: str = USER, exclusions: DataFrame | None = None) -> DataFrame:
    """top-k per requested user, ``(user_id, item_id, predicted_rating)``,
    by the blocked scorer (:func:`shelfwise.operators.scoring.topk_vectors`).
    Users unknown to the model get no rows. Items the user rated stay in
    unless ``exclusions`` lists them."""
    user_factors, item_factors = factors(model)
    wanted = user_factors.join(users.select(user).distinct(), user, "left_semi")
    recs = scoring.topk_vectors(wanted, item_factors, k, exclusions=exclusions)
    return recs.select(
        F.col(USER).cast("int").alias(user),
        F.col(ITEM).cast("int").alias(ITEM),
        F.col("score").cast("float").alias("predicted_rating"),
    )


def factors(model: ALSModel) -> tuple[DataFrame, DataFrame]:
    """Learned factors as ``(user_id, features)`` and ``(item_id, features)``
    (``array<float>``), the inputs of the catalogue scorer and the neural
    recommender."""
    return (
        model.userFactors.select(F.col("id").alias(USER), "features"),
        model.itemFactors.select(F.col("id").alias(ITEM), "features"),
    )
