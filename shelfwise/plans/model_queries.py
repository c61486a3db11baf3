"""Registered queries over fitted models.

ALS and the perceptron are iterative solvers: their values have no SQL
equivalent, so the queries that return them get a rows-only check. Beside each
stands a companion that returns what SQL can know of the same result: which
ids have factors, which pairs survive the cold start, how many unseen items
every known user gets and that none of them was seen, that one candidate wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.operators import als, ids, least_squares, metrics, ncf, neural, prep, scoring, split, topk
from shelfwise.plans import fixtures_sql as S
from shelfwise.plans.catalog import K, register
from shelfwise.plans.pipelines import run_als, run_neural, run_serving, stored
from shelfwise.schema import ITEM, RATING, USER
from shelfwise.sources import tables


PRUNED_LEAF = 16


def indexed_parts(spark: SparkSession, sf_dir: str, *columns: str) -> dict[str, DataFrame]:
    """F1 with ids through the J1 dictionaries (ALS needs the int range),
    split 80/20 by pair hash; with ``columns`` no others are stored."""
    raw = tables.raw_interactions(spark, sf_dir)
    raw = stored(raw.select(*columns) if columns else raw)  # one pass over the tables
    user_dict = ids.build_dictionary(raw, USER)
    item_dict = ids.build_dictionary(raw, ITEM)
    return split.train_test_split(ids.index_interactions(raw, user_dict, item_dict), keep=stored)


def fitted(spark: SparkSession, sf_dir: str, rank: int = 10):
    parts = indexed_parts(spark, sf_dir, USER, ITEM, RATING)
    return als.fit(parts["train"], als.AlsParams(rank=rank)), parts


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 end to end; the one-row metric report."""
    return run_als(tables.raw_interactions(spark, sf_dir), K).report


@register("als_metric_report")
def als_metric_report(spark, sf_dir):
    """Metric report of the ALS pipeline."""
    return flagship(spark, sf_dir)


@register("als_factors")
def als_factors(spark, sf_dir):
    """Learned user and item factors ``(side, id, features)``."""
    model, _ = fitted(spark, sf_dir)
    uf, itf = als.factors(model)
    return uf.select(F.lit("user").alias("side"), F.col(USER).alias("id"), "features").unionByName(
        itf.select(F.lit("item").alias("side"), F.col(ITEM).alias("id"), "features")
    )


@register("als_predictions")
def als_predictions(spark, sf_dir):
    """Predicted rating of each test pair; cold pairs dropped."""
    model, parts = fitted(spark, sf_dir)
    return als.predict(model, parts["test"].select(USER, ITEM, RATING))


@register("als_recommendations")
def als_recommendations(spark, sf_dir):
    """F3 + C6 + C4: ALS top-k for the test users, ids restored to strings."""
    run = run_als(tables.raw_interactions(spark, sf_dir), K)
    return run.recommendations


@register("als_topk_unseen")
def als_topk_unseen(spark, sf_dir):
    """C5 + B13 + F2: exact ALS top-k over the whole catalogue for every test
    user, items the user rated in train excluded before the cut."""
    model, parts = fitted(spark, sf_dir)
    uf, itf = als.factors(model)
    return run_serving(parts["test"], uf, itf, K, exclusions=parts["train"].select(USER, ITEM))


_CATALOGUE = (
    f"""SELECT user_id, item_id, round(score, 6) AS score, rank FROM (
  SELECT u.vec_id AS user_id, i.vec_id AS item_id,
         list_dot_product(CAST(u.embedding AS DOUBLE[]), CAST(i.embedding AS DOUBLE[])) AS score,
         CAST(row_number() OVER (PARTITION BY u.vec_id
              ORDER BY list_dot_product(CAST(u.embedding AS DOUBLE[]), CAST(i.embedding AS DOUBLE[])) DESC,
                       i.vec_id) AS INTEGER) AS rank
  FROM embeddings u, embeddings i) WHERE rank <= {K}"""
)


def _catalogue(spark, sf_dir, scorer):
    vec = tables.vectors(spark, sf_dir)
    users = vec.select(F.col("vec_id").alias(USER), F.col("embedding").alias("features"))
    items = vec.select(F.col("vec_id").alias(ITEM), F.col("embedding").alias("features"))
    return scoring.topk_vectors(users, items, K, scorer).withColumn("rank", F.col("rank").cast("int"))


@register("score_catalogue", _CATALOGUE)
def score_catalogue(spark, sf_dir):
    """C5/J5 with a dot product: every vector of ``embeddings`` scored
    against the whole catalogue of vectors, top-k per vector, blocked."""
    return _catalogue(spark, sf_dir, scoring.DotScorer())


@register("score_catalogue_pruned", _CATALOGUE)
def score_catalogue_pruned(spark, sf_dir):
    """The same top-k, scoring only blocks of items whose bound reaches
    the user's k-th best score."""
    return _catalogue(spark, sf_dir, scoring.DotScorer(leaf=PRUNED_LEAF))


def indexed_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 over the dictionary-indexed interactions (the neural path's input)."""
    raw = stored(tables.raw_interactions(spark, sf_dir))
    user_dict = ids.build_dictionary(raw, USER)
    item_dict = ids.build_dictionary(raw, ITEM)
    return prep.user_item_matrix(ids.index_interactions(raw, user_dict, item_dict))


def _neural(spark, sf_dir, candidates=(neural.MlpParams(),)):
    # rank 32: the reference embeds users and items in 32 dimensions.
    run = run_neural(indexed_matrix(spark, sf_dir), candidates, rank=32)
    run.close()
    return run


@register("mlp_score")
def mlp_score(spark, sf_dir):
    """Class-1 probability of every test pair from the perceptron over
    ALS factors (fitted on the train part)."""
    run = _neural(spark, sf_dir)
    feats = neural.with_label(neural.pair_features(run.parts["test"], run.user_factors, run.item_factors))
    return neural.score(run.model, feats).select(USER, ITEM, RATING, "label", "probability", "prediction")


@register("mlp_evaluate")
def mlp_evaluate(spark, sf_dir):
    """Held-out cross-entropy and accuracy of the selected perceptron."""
    return _neural(spark, sf_dir).test_metrics


@register("select_model")
def select_model(spark, sf_dir):
    """Candidates scored on the validation part; the lowest loss wins."""
    candidates = (
        neural.MlpParams(hidden=(64, 32, 16, 8), max_iter=20),
        neural.MlpParams(hidden=(16, 8), max_iter=20),
    )
    return _neural(spark, sf_dir, candidates).candidates


@register("mlp_topk")
def mlp_topk(spark, sf_dir):
    """Every test user's top-k over the whole catalogue by the
    perceptron, items seen in train excluded; blocked NumPy scoring."""
    run = _neural(spark, sf_dir)
    return run_serving(
        run.parts["test"], run.user_factors, run.item_factors, K,
        exclusions=run.parts["train"].select(USER, ITEM), model=run.model,
    )


# ------------------------------------------ companions that SQL can check

_KEYS = """idx_interactions AS (
  SELECT u.idx AS user_id, i.idx AS item_id, r.rating
  FROM raw r
  JOIN (SELECT key, row_number() OVER (ORDER BY key) - 1 AS idx FROM (SELECT DISTINCT user_id AS key FROM raw)) u
    ON r.user_id = u.key
  JOIN (SELECT key, row_number() OVER (ORDER BY key) - 1 AS idx FROM (SELECT DISTINCT item_id AS key FROM raw)) i
    ON r.item_id = i.key)"""
_IDX2 = f"""idx_train AS (SELECT * FROM idx_interactions WHERE {S.split_hash()} < {S.share(0.8)}),
idx_test AS (SELECT * FROM idx_interactions WHERE {S.split_hash()} >= {S.share(0.8)})"""
_IDX3 = f"""idx_matrix AS (SELECT user_id, item_id, avg(CAST(rating AS DOUBLE)) AS rating FROM idx_interactions GROUP BY 1, 2),
idx_train AS (SELECT * FROM idx_matrix WHERE {S.split_hash()} < {S.share(0.8)}),
idx_test AS (SELECT * FROM idx_matrix WHERE {S.split_hash()} >= {S.share(0.9)})"""
_COUNTS = f"""SELECT CAST(user_id AS BIGINT) AS user_id, CAST(least({K}, n_items - n_seen) AS BIGINT) AS n_recs,
       CAST(0 AS BIGINT) AS n_seen
FROM (SELECT user_id, count(DISTINCT item_id) AS n_seen FROM idx_train GROUP BY user_id)
     JOIN (SELECT DISTINCT user_id FROM idx_test) USING (user_id),
     (SELECT count(DISTINCT item_id) AS n_items FROM idx_train)
WHERE n_items > n_seen"""


def _serving_counts(recs: DataFrame, train: DataFrame) -> DataFrame:
    """Per user: recommendations, and how many of them are in train."""
    pairs = recs.select(F.col(USER).cast("bigint").alias(USER), F.col(ITEM).cast("bigint").alias(ITEM))
    seen = train.select(F.col(USER).cast("bigint").alias(USER), F.col(ITEM).cast("bigint").alias(ITEM)).distinct()
    joined = pairs.join(seen.withColumn("_seen", F.lit(1)), [USER, ITEM], "left")
    return joined.groupBy(USER).agg(F.count(F.lit(1)).alias("n_recs"), F.count("_seen").alias("n_seen"))


@register(
    "als_factor_ids",
    S.with_ctes(S.INTERACTIONS, S.RAW, _KEYS, _IDX2)
    + """SELECT 'user' AS side, CAST(user_id AS BIGINT) AS id, 10 AS width FROM (SELECT DISTINCT user_id FROM idx_train)
UNION ALL SELECT 'item', CAST(item_id AS BIGINT), 10 FROM (SELECT DISTINCT item_id FROM idx_train)""",
)
def als_factor_ids(spark, sf_dir):
    """Every user and item of train has a vector of the rank's width."""
    found = als_factors(spark, sf_dir)
    return found.select("side", F.col("id").cast("bigint").alias("id"), F.size("features").alias("width"))


@register(
    "als_prediction_pairs",
    S.with_ctes(S.INTERACTIONS, S.RAW, _KEYS, _IDX2)
    + """SELECT CAST(user_id AS BIGINT) AS user_id, CAST(item_id AS BIGINT) AS item_id, count(*) AS n
FROM idx_test WHERE user_id IN (SELECT user_id FROM idx_train) AND item_id IN (SELECT item_id FROM idx_train)
GROUP BY 1, 2""",
)
def als_prediction_pairs(spark, sf_dir):
    """The test pairs that get a prediction (user and item known)."""
    known = als_predictions(spark, sf_dir).where(F.col("prediction").isNotNull())
    return known.groupBy(F.col(USER).cast("bigint").alias(USER), F.col(ITEM).cast("bigint").alias(ITEM)).agg(
        F.count(F.lit(1)).alias("n"))


@register("als_topk_unseen_counts", S.with_ctes(S.INTERACTIONS, S.RAW, _KEYS, _IDX2) + _COUNTS)
def als_topk_unseen_counts(spark, sf_dir):
    """C5 + B13: each known test user gets min(k, unseen items), none of them seen."""
    model, parts = fitted(spark, sf_dir)
    uf, itf = als.factors(model)
    recs = run_serving(parts["test"], uf, itf, K, exclusions=parts["train"].select(USER, ITEM))
    return _serving_counts(recs, parts["train"])


@register(
    "als_topk_pruned_work",
    S.with_ctes(S.INTERACTIONS, S.RAW, _KEYS, _IDX2)
    + """SELECT (SELECT count(DISTINCT user_id) FROM idx_train WHERE user_id IN (SELECT user_id FROM idx_test))
       * (SELECT count(DISTINCT item_id) FROM idx_train) AS pairs, true AS fewer""",
)
def als_topk_pruned_work(spark, sf_dir):
    """All known test users against the catalogue of ALS factors; whether
    the bounds spare any of the scores."""
    model, parts = fitted(spark, sf_dir)
    uf, itf = als.factors(model)
    wanted = uf.join(parts["test"].select(USER).distinct(), USER, "left_semi")
    work = scoring.scoring_work(wanted, itf, K, scoring.DotScorer(leaf=PRUNED_LEAF), parts["train"].select(USER, ITEM))
    return work.select("pairs", (F.col("scored") < F.col("pairs")).alias("fewer"))


@register(
    "als_topk_single_user",
    S.with_ctes(S.INTERACTIONS, S.RAW, _KEYS, _IDX2)
    + f""", busiest AS (SELECT user_id FROM idx_train GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 1)
SELECT least({K}, (SELECT count(DISTINCT item_id) FROM idx_train)
             - (SELECT count(DISTINCT item_id) FROM idx_train WHERE user_id = (SELECT user_id FROM busiest))) AS n_recs,
       CAST(0 AS BIGINT) AS n_seen, true AS descending""",
)
def als_topk_single_user(spark, sf_dir):
    """F1 from a model: the busiest user's top-k, its train items excluded;
    how many there are, how many of them were seen, and whether in order."""
    model, parts = fitted(spark, sf_dir)
    uf, itf = als.factors(model)
    train = parts["train"]
    busiest = train.groupBy(USER).count().orderBy(F.desc("count"), F.asc(USER)).limit(1).select(USER)
    seen = train.join(busiest, USER, "left_semi").select(ITEM)
    recs = topk.topk_from_factors(uf.join(busiest, USER, "left_semi"), itf, K, seen)
    after = F.lead("score").over(Window.orderBy("rank"))  # k rows
    marked = recs.withColumn("_ok", F.coalesce(after <= F.col("score"), F.lit(True))).join(
        seen.distinct().withColumn("_seen", F.lit(1)), ITEM, "left")
    return marked.agg(F.count(F.lit(1)).alias("n_recs"), F.count("_seen").alias("n_seen"),
                      F.every("_ok").alias("descending"))


@register("mlp_topk_counts", S.with_ctes(S.INTERACTIONS, S.RAW, _KEYS, _IDX3) + _COUNTS)
def mlp_topk_counts(spark, sf_dir):
    """J5 + B13: each known test user gets min(k, unseen items), none of them seen."""
    run = _neural(spark, sf_dir, (neural.MlpParams(hidden=(8,), max_iter=5),))
    train = run.parts["train"].select(USER, ITEM)
    recs = run_serving(run.parts["test"], run.user_factors, run.item_factors, K, exclusions=train, model=run.model)
    return _serving_counts(recs, train)


@register(
    "mlp_score_pairs",
    S.with_ctes(S.INTERACTIONS, S.RAW, _KEYS, _IDX3)
    + """SELECT CAST(user_id AS BIGINT) AS user_id, CAST(item_id AS BIGINT) AS item_id,
       CASE WHEN rating >= 4 THEN 1.0 ELSE 0.0 END::DOUBLE AS label, true AS in_range
FROM idx_test WHERE user_id IN (SELECT user_id FROM idx_train) AND item_id IN (SELECT item_id FROM idx_train)""",
)
def mlp_score_pairs(spark, sf_dir):
    """The test pairs that are scored, their labels, probabilities in (0, 1)."""
    run = _neural(spark, sf_dir, (neural.MlpParams(hidden=(8,), max_iter=5),))
    feats = neural.with_label(neural.pair_features(run.parts["test"], run.user_factors, run.item_factors))
    return neural.score(run.model, feats).select(
        F.col(USER).cast("bigint").alias(USER), F.col(ITEM).cast("bigint").alias(ITEM), "label",
        F.col("probability").between(0.0, 1.0).alias("in_range"))


@register("select_model_winner", "SELECT CAST(2 AS BIGINT) AS candidates, CAST(1 AS BIGINT) AS winners, true AS lowest")
def select_model_winner(spark, sf_dir):
    """Of two candidates exactly one wins, the one of least validation loss."""
    candidates = (neural.MlpParams(hidden=(8,), max_iter=5), neural.MlpParams(hidden=(4,), max_iter=2))
    table = _neural(spark, sf_dir, candidates).candidates
    return table.agg(
        F.count(F.lit(1)).alias("candidates"), F.count_if("best").alias("winners"),
        (F.min("bce") == F.min(F.when(F.col("best"), F.col("bce")))).alias("lowest"))


@register("als_implicit")
def als_implicit(spark, sf_dir):
    """F2 + J2/J3: ALS on implicit feedback; confidence of every seen pair."""
    weights = stored(prep.implicit_matrix(tables.implicit_interactions(spark, sf_dir))).select(
        F.col(USER).cast("int").alias(USER), F.col(ITEM).cast("int").alias(ITEM), RATING)
    model = als.fit(weights, als.AlsParams(implicit_prefs=True, alpha=10.0))
    return als.predict(model, weights)


# ------------------------------------- embeddings learned with the network

#: Fewer, larger steps than the library's defaults.
NCF = ncf.NcfParams(epochs=4, batches=4, learning_rate=0.01)


def _joint(spark, sf_dir):
    parts = split.train_val_test_split(stored(indexed_matrix(spark, sf_dir)))
    return ncf.fit(parts["train"], NCF), parts


@register("ncf_evaluate")
def ncf_evaluate(spark, sf_dir):
    """J4 + J7: held-out cross-entropy and accuracy of the network whose
    embeddings are learned with it."""
    model, parts = _joint(spark, sf_dir)
    return metrics.binary_metrics(ncf.score(model, neural.with_label(parts["test"])))


@register(
    "ncf_score_pairs",
    S.with_ctes(S.INTERACTIONS, S.RAW, _KEYS, _IDX3)
    + """SELECT CAST(user_id AS BIGINT) AS user_id, CAST(item_id AS BIGINT) AS item_id,
       CASE WHEN rating >= 4 THEN 1.0 ELSE 0.0 END::DOUBLE AS label, true AS in_range
FROM idx_test WHERE user_id IN (SELECT user_id FROM idx_train) AND item_id IN (SELECT item_id FROM idx_train)""",
)
def ncf_score_pairs(spark, sf_dir):
    """The test pairs that are scored, their labels, probabilities in (0, 1)."""
    model, parts = _joint(spark, sf_dir)
    return ncf.score(model, neural.with_label(parts["test"])).select(
        F.col(USER).cast("bigint").alias(USER), F.col(ITEM).cast("bigint").alias(ITEM), "label",
        F.col("probability").between(0.0, 1.0).alias("in_range"))


@register("ncf_topk_counts", S.with_ctes(S.INTERACTIONS, S.RAW, _KEYS, _IDX3) + _COUNTS)
def ncf_topk_counts(spark, sf_dir):
    """J5 + B13 by the same network: min(k, unseen items) for each known test user."""
    model, parts = _joint(spark, sf_dir)
    users, items = model.factors()
    train = parts["train"].select(USER, ITEM)
    wanted = users.join(parts["test"].select(USER).distinct(), USER, "left_semi")
    return _serving_counts(scoring.topk_vectors(wanted, items, K, model.scorer(), train), train)


# ------------------------------------------------- ALS with split hot keys

@register(
    "als_split_agreement",
    S.with_ctes(S.INTERACTIONS, S.RAW, _KEYS, _IDX2)
    + """SELECT 'user' AS side, CAST(user_id AS BIGINT) AS id, true AS equal FROM (SELECT DISTINCT user_id FROM idx_train)
UNION ALL SELECT 'item', CAST(item_id AS BIGINT), true FROM (SELECT DISTINCT item_id FROM idx_train)""",
)
def als_split_agreement(spark, sf_dir):
    """Per id, whether ALS with split keys and Spark ML's, from the same
    start and after the same iterations, have the same vector."""
    train = stored(indexed_parts(spark, sf_dir)["train"])
    params = als.AlsParams(max_iter=3)
    start, _ = als.factors(als.fit(train, als.AlsParams(max_iter=0)))
    theirs = als.factors(als.fit(train, params))
    mine = least_squares.fit(train, least_squares.SplitAlsParams(max_iter=params.max_iter), start=start)
    out = None
    for side, column, a, b in zip(("user", "item"), (USER, ITEM), mine, theirs):
        b = b.select(F.col(column).cast("bigint").alias("id"), F.col("features").cast("array<double>").alias("b"))
        apart = F.array_max(F.zip_with("features", "b", lambda x, y: F.abs(x - y)))
        own = (a.withColumnRenamed(column, "id").join(b, "id", "full")
               .select(F.lit(side).alias("side"), "id", F.coalesce(apart < 1e-3, F.lit(False)).alias("equal")))
        out = own if out is None else out.unionByName(own)
    return out
