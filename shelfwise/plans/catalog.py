"""Registered queries: one per operator of the inventory, each a function
``(spark, sf_dir) -> DataFrame`` over the given tables, plus (where SQL can
express it) the equivalent DuckDB query used as the correctness oracle.

Double outputs are rounded to 6 decimals on both sides: sums of many doubles
differ in the last bits between engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.columns import epoch_to_ts, instant_to_ntz
from shelfwise.operators import baselines, ids, metrics, prep, ranking, split, topk
from shelfwise.plans import fixtures_sql as S
from shelfwise.schema import ITEM, RATING, SCORE, TS, USER
from shelfwise.plans.pipelines import stored
from shelfwise.sources import sinks, tables, versioned
from shelfwise.streaming.ingest import run_dir
from shelfwise.streaming.monitor import tumbling_activity
from shelfwise.streaming.upsert import upsert

K = 10
DIGITS = 6

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        _QUERIES[name] = run
        if sql is not None:
            _ORACLE[name] = sql
        return run

    return wrap


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def queries() -> dict[str, QueryFn]:
    _load_extensions()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_extensions()
    return dict(_ORACLE)


def _load_extensions() -> None:
    # Model and streaming queries live in their own modules and register
    # themselves on import.
    from shelfwise.plans import model_queries, stream_queries  # noqa: F401


# ---------------------------------------------------------------- helpers


def parts(spark: SparkSession, sf_dir: str, once: bool = False) -> dict[str, DataFrame]:
    """Train and test of F1; ``once``: stored first, for queries that use them
    several times (one pass over the tables, and no cache left behind)."""
    rows = tables.interactions(spark, sf_dir)
    return split.train_test_split(stored(rows) if once else rows)


def test_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.distinct_values(parts(spark, sf_dir)["test"], USER)


def popular_recs(spark: SparkSession, sf_dir: str, k: int = K,
                 p: dict[str, DataFrame] | None = None) -> DataFrame:
    """Popularity top-k (fitted on train) for every test user, named as the
    reference names model recommendations."""
    p = p or parts(spark, sf_dir)
    recs = baselines.recommend_popular(prep.distinct_values(p["test"], USER), p["train"], k)
    return recs.select(USER, ITEM, F.col(SCORE).alias("predicted_rating"), "rank")


def item_mean_predictions(spark: SparkSession, sf_dir: str,
                          p: dict[str, DataFrame] | None = None) -> DataFrame:
    p = p or parts(spark, sf_dir)
    return baselines.item_mean_predictions(p["test"].select(USER, ITEM, RATING), p["train"])


# ------------------------------------------------------- scans and cleaning


@register("scan_interactions", S.with_ctes(S.INTERACTIONS) + "SELECT * FROM interactions")
def scan_interactions(spark, sf_dir):
    """A1/A2: the interaction fixture, pruned scans joined on the order key."""
    return tables.interactions(spark, sf_dir)


@register(
    "epoch_to_timestamp",
    S.with_ctes(S.INTERACTIONS, S.RAW)
    + """SELECT user_id, item_id, rating, "timestamp",
       make_timestamp(CAST("timestamp" AS BIGINT) * 1000000) AS event_time FROM raw""",
)
def epoch_to_timestamp(spark, sf_dir):
    """B1/H1: epoch seconds -> timestamp without a string round trip."""
    raw = tables.raw_interactions(spark, sf_dir)
    return raw.withColumn("event_time", epoch_to_ts(F.col("timestamp")))


@register(
    "preprocess_interactions",
    S.with_ctes(S.INTERACTIONS, S.DIRTY, S.RAW_DIRTY)
    + """SELECT user_id, item_id, max(rating) AS rating,
       make_timestamp("timestamp" * 1000000) AS "timestamp"
FROM raw_dirty WHERE rating IS NOT NULL
GROUP BY user_id, item_id, "timestamp" """,
)
def preprocess_interactions(spark, sf_dir):
    """P2 cleaning (B1 + B2 + B10) on raw rows with copies and null ratings."""
    clean = prep.preprocess_interactions(tables.raw_form(tables.dirty(spark, sf_dir)))
    return clean.withColumn("timestamp", instant_to_ntz("timestamp"))  # UTC wall clock, as DuckDB has it


@register(
    "dedupe_interactions",
    S.with_ctes(S.INTERACTIONS, S.DIRTY)
    + """SELECT user_id, item_id, rating, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, item_id
                               ORDER BY rating DESC, ts DESC) AS rn
  FROM dirty WHERE rating IS NOT NULL) WHERE rn = 1""",
)
def dedupe_interactions(spark, sf_dir):
    """B2 + B10: one row per (user, item): best rating, then latest time."""
    clean = prep.drop_null(tables.dirty(spark, sf_dir))
    return prep.dedupe(clean, [USER, ITEM], prefer=RATING)


@register(
    "user_item_matrix",
    S.with_ctes(S.INTERACTIONS)
    + """SELECT user_id, item_id, round(avg(CAST(rating AS DOUBLE)), 6) AS rating
FROM interactions GROUP BY user_id, item_id""",
)
def user_item_matrix(spark, sf_dir):
    """Mean rating per (user, item)."""
    return prep.user_item_matrix(tables.interactions(spark, sf_dir))


@register(
    "distinct_users",
    S.with_ctes(S.INTERACTIONS, S.SPLIT2, S.TEST) + "SELECT DISTINCT user_id FROM test",
)
def distinct_users(spark, sf_dir):
    """The users of the test part."""
    return test_users(spark, sf_dir)


# --------------------------------------------------------- id dictionaries

_USER_DICT_SQL = """user_dict AS (
  SELECT key, CAST(row_number() OVER (ORDER BY key) - 1 AS INTEGER) AS idx
  FROM (SELECT DISTINCT 'user_' || CAST(c_custkey AS VARCHAR) AS key FROM customer))"""
_ITEM_DICT_SQL = """item_dict AS (
  SELECT key, CAST(row_number() OVER (ORDER BY key) - 1 AS INTEGER) AS idx
  FROM (SELECT DISTINCT 'item_' || CAST(p_partkey AS VARCHAR) AS key FROM part))"""


def user_dictionary(spark, sf_dir):
    names = tables.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("user_"), F.col("c_custkey").cast("string")).alias("key")
    )
    return ids.build_dictionary(names, "key")


def item_dictionary(spark, sf_dir):
    names = tables.table(spark, sf_dir, "part").select(
        F.concat(F.lit("item_"), F.col("p_partkey").cast("string")).alias("key")
    )
    return ids.build_dictionary(names, "key")


@register(
    "build_dictionary",
    S.with_ctes(S.INTERACTIONS, S.RAW)
    + """SELECT key, CAST(row_number() OVER (ORDER BY key) - 1 AS INTEGER) AS idx
FROM (SELECT DISTINCT user_id AS key FROM raw)""",
)
def build_dictionary(spark, sf_dir):
    """Dense 0-based index of the interaction users, in key order."""
    return ids.build_dictionary(tables.raw_interactions(spark, sf_dir), USER)


@register(
    "index_interactions",
    S.with_ctes(S.INTERACTIONS, S.DIRTY, S.RAW_DIRTY, _USER_DICT_SQL, _ITEM_DICT_SQL)
    + """SELECT CAST(u.idx AS INTEGER) AS user_id, CAST(i.idx AS INTEGER) AS item_id,
       r.rating, r."timestamp"
FROM raw_dirty r JOIN user_dict u ON r.user_id = u.key JOIN item_dict i ON r.item_id = i.key""",
)
def index_interactions(spark, sf_dir):
    """C3 + B3-B5: string ids -> catalogue indexes; unknown ids are dropped."""
    raw = tables.raw_form(tables.dirty(spark, sf_dir))
    return ids.index_interactions(raw, user_dictionary(spark, sf_dir), item_dictionary(spark, sf_dir))


@register(
    "restore_ids",
    S.with_ctes(S.INTERACTIONS, S.SPLIT2, S.TEST, _ITEM_DICT_SQL)
    + """, known AS (
  SELECT DISTINCT d.idx, d.key FROM test t JOIN item_dict d ON d.key = 'item_' || CAST(t.item_id AS VARCHAR)),
beyond AS (SELECT idx + CAST((SELECT count(*) FROM item_dict) AS INTEGER) AS idx FROM known WHERE idx % 10 = 0)
SELECT idx AS item_id, key AS item_name FROM known
UNION ALL SELECT idx, CAST(idx AS VARCHAR) FROM beyond""",
)
def restore_ids(spark, sf_dir):
    """C4 + H5: the test items' names through the item dictionary of all parts
    and back: every index gets its own name again; indexes beyond the
    dictionary become their decimal string."""
    dictionary = item_dictionary(spark, sf_dir)
    names = prep.distinct_values(parts(spark, sf_dir)["test"], ITEM).select(
        F.concat(F.lit("item_"), F.col(ITEM).cast("string")).alias(ITEM))
    known = ids.encode(names, dictionary, ITEM)
    size = dictionary.agg(F.count(F.lit(1)).cast("int")).scalar()
    beyond = known.where(F.col(ITEM) % 10 == 0).select((F.col(ITEM) + size).alias(ITEM))
    return ids.decode(known.unionByName(beyond), dictionary, ITEM, out="item_name")


# ------------------------------------------------------------------ splits


@register(
    "split_train_test",
    S.with_ctes(S.INTERACTIONS, S.SPLIT2) + "SELECT * FROM split2",
)
def split_train_test(spark, sf_dir):
    """80/20 split by a hash of the pair."""
    return split.assign_parts(tables.interactions(spark, sf_dir))


@register(
    "split_three_way",
    S.with_ctes(S.INTERACTIONS, S.SPLIT3) + "SELECT * FROM split3",
)
def split_three_way(spark, sf_dir):
    """80/10/10 split by a hash of the pair."""
    return split.assign_parts(
        tables.interactions(spark, sf_dir), (0.8, 0.1, 0.1), ("train", "val", "test")
    )


@register(
    "split_fine_weights",
    S.with_ctes(S.INTERACTIONS)
    + f"""SELECT *, CASE WHEN {S.split_hash()} < {S.share(0.997)} THEN 'train' ELSE 'test' END AS part
FROM interactions""",
)
def split_fine_weights(spark, sf_dir):
    """B11 with a hold-out of 3 in 1000."""
    return split.assign_parts(tables.interactions(spark, sf_dir), (0.997, 0.003))


# ------------------------------------------------------------------- top-k


@register(
    "recommend_subset",
    S.with_ctes(S.INTERACTIONS, S.SPLIT2, S.TRAIN, S.TEST, S.TEST_USERS, S.popular(K), S.RECS)
    + "SELECT user_id, item_id, predicted_rating, rank FROM recs",
)
def recommend_subset(spark, sf_dir):
    """Recommendations for all users (popularity list of the train part),
    restricted to the users of the test part."""
    p = parts(spark, sf_dir)
    everyone = prep.distinct_values(tables.interactions(spark, sf_dir), USER)
    recs = baselines.recommend_popular(everyone, p["train"], K)
    recs = recs.select(USER, ITEM, F.col(SCORE).alias("predicted_rating"), "rank")
    return topk.restrict_to_users(recs, p["test"])


@register(
    "explode_recommendations",
    S.with_ctes(S.INTERACTIONS, S.SPLIT2, S.TRAIN, S.TEST, S.TEST_USERS, S.popular(K), S.RECS)
    + "SELECT user_id, item_id, predicted_rating FROM recs",
)
def explode_recommendations(spark, sf_dir):
    """Nested per-user lists (the ALS output shape) exploded back
    to rows with struct-field access."""
    nested = topk.nest_recommendations(popular_recs(spark, sf_dir), score="predicted_rating")
    return topk.explode_recommendations(nested)


_MEAN_SCORES_SQL = """scores AS (
  SELECT user_id, item_id, avg(CAST(rating AS DOUBLE)) AS score
  FROM interactions GROUP BY user_id, item_id)"""


def mean_scores(spark, sf_dir):
    m = prep.user_item_matrix(tables.interactions(spark, sf_dir))
    return m.withColumnRenamed(RATING, SCORE)


@register(
    "topk_batch",
    S.with_ctes(S.INTERACTIONS, _MEAN_SCORES_SQL)
    + f"""SELECT user_id, item_id, round(score, 6) AS score, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id)
                 AS INTEGER) AS rank FROM scores) WHERE rank <= {K}""",
)
def topk_batch(spark, sf_dir):
    """F2: top-k per user over given scores (here each user's mean rating of
    an item), all users in one job, ties by item id."""
    return topk.topk_per_user(mean_scores(spark, sf_dir), K)


@register(
    "topk_single_user",
    S.with_ctes(S.INTERACTIONS, _MEAN_SCORES_SQL)
    + f""", busiest AS (
  SELECT user_id FROM interactions GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 1)
SELECT user_id, item_id, round(score, 6) AS score,
       CAST(row_number() OVER (ORDER BY score DESC, item_id) AS INTEGER) AS rank
FROM (SELECT * FROM scores WHERE user_id = (SELECT user_id FROM busiest)
      ORDER BY score DESC, item_id LIMIT {K})""",
)
def topk_single_user(spark, sf_dir):
    """top-k for one user (the user with most interactions)."""
    inter = tables.interactions(spark, sf_dir)
    busiest = (
        inter.groupBy(USER).count().orderBy(F.desc("count"), F.asc(USER)).limit(1).select(USER).first()[0]
    )
    out = topk.topk_single_user(mean_scores(spark, sf_dir), busiest, K)
    return out.withColumn("rank", F.col("rank").cast("int"))


@register(
    "topk_excluding_seen",
    S.with_ctes(S.INTERACTIONS, S.SPLIT2, S.TRAIN, S.TEST, S.TEST_USERS)
    + f""", pop AS (SELECT item_id, CAST(count(*) AS DOUBLE) AS score FROM train GROUP BY item_id),
cand AS (
  SELECT u.user_id, p.item_id, p.score FROM test_users u, pop p
  WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = u.user_id AND t.item_id = p.item_id))
SELECT user_id, item_id, score, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id)
                 AS INTEGER) AS rank FROM cand) WHERE rank <= {K}""",
)
def topk_excluding_seen(spark, sf_dir):
    """B13 + F2: most popular items each test user has not rated in train.
    Exact; a user gets as many candidates as k plus the items they have seen."""
    p = parts(spark, sf_dir, once=True)
    ranked = ids.dense_index(
        baselines.item_popularity(p["train"]), [F.desc(SCORE), F.asc(ITEM)], out="pos"
    ).withColumn("pos", F.col("pos") + 1)
    users = prep.distinct_values(p["test"], USER)
    out = topk.topk_from_ranked_list(users, ranked, p["train"].select(USER, ITEM), K)
    return out.withColumn("rank", F.col("rank").cast("int"))


@register(
    "unknown_users",
    S.with_ctes(S.INTERACTIONS, S.SPLIT2, S.TRAIN)
    + """SELECT c_custkey AS user_id FROM customer
WHERE c_custkey NOT IN (SELECT user_id FROM train WHERE ts >= (SELECT max(ts) FROM train) - INTERVAL 30 DAY)""",
)
def unknown_users(spark, sf_dir):
    """Customers that a model of the latest 30 days of train rows cannot
    know (they get no recommendation rows)."""
    customers = tables.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias(USER))
    train = parts(spark, sf_dir)["train"]
    since = train.agg((F.max(TS) - F.expr("INTERVAL 30 DAYS")).alias("t")).scalar()
    recent = train.where(F.col(TS) >= since)
    return topk.unknown_users(customers, recent)


@register(
    "vector_topk_single",
    f"""SELECT item_id, round(score, 6) AS score, CAST(row_number() OVER (ORDER BY score DESC, item_id) AS INTEGER) AS rank
FROM (SELECT i.vec_id AS item_id,
             list_dot_product(CAST(u.embedding AS DOUBLE[]), CAST(i.embedding AS DOUBLE[])) AS score
      FROM embeddings i, (SELECT embedding, label FROM embeddings WHERE vec_id = 0) u
      WHERE i.label <> u.label ORDER BY score DESC, item_id LIMIT {K})""",
)
def vector_topk_single(spark, sf_dir):
    """F1 + B13 from vectors: one user's top-k over the catalogue, the vectors
    of its own label excluded."""
    vec = tables.vectors(spark, sf_dir)
    user = vec.where("vec_id = 0")
    items = vec.select(F.col("vec_id").alias(ITEM), F.col("embedding").alias("features"), "label")
    seen = items.where(F.col("label") == user.select("label").scalar())
    out = topk.topk_from_factors(user.select(F.col("embedding").alias("features")), items, K, seen)
    return out.withColumn("rank", F.col("rank").cast("int"))


# ------------------------------------------------------ ranks and metrics


@register(
    "rank_recommendations",
    S.with_ctes(S.INTERACTIONS, S.SPLIT2, S.TRAIN, S.TEST, S.TEST_USERS, S.popular(K), S.RECS,
                S.top_recs(K))
    + "SELECT * FROM top_recs",
)
def rank_recommendations(spark, sf_dir):
    """E1 + B8: rank() of recommendations per user, rank <= k."""
    recs = popular_recs(spark, sf_dir).drop("rank")
    out = metrics.top_ranked(recs, K)
    return out.withColumn("rec_rank", F.col("rec_rank").cast("int"))


@register(
    "rank_truth",
    S.with_ctes(S.INTERACTIONS, S.SPLIT2, S.TEST)
    + f"""SELECT * FROM (
  SELECT *, CAST(rank() OVER (PARTITION BY user_id ORDER BY rating DESC) AS INTEGER) AS test_rank
  FROM test) WHERE test_rank <= {K}""",
)
def rank_truth(spark, sf_dir):
    """E2 + B8: rank() of test rows per user by rating; ties can let more
    than k rows pass."""
    out = ranking.rank_rows_upto(parts(spark, sf_dir)["test"], RATING, K, out="test_rank")
    return out.withColumn("test_rank", F.col("test_rank").cast("int"))


@register(
    "relevant_items",
    S.with_ctes(S.INTERACTIONS, S.SPLIT2, S.TEST, S.relevant()) + "SELECT * FROM relevant",
)
def relevant_items(spark, sf_dir):
    """Test rows with rating >= 4."""
    return metrics.relevant_items(parts(spark, sf_dir)["test"])


@register(
    "hits",
    S.with_ctes(S.INTERACTIONS, S.SPLIT2, S.TRAIN, S.TEST, S.TEST_USERS, S.popular(K), S.RECS,
                S.top_recs(K), S.relevant())
    + """SELECT r.user_id, r.item_id, r.predicted_rating, r.rec_rank, v.rating, v.ts
FROM top_recs r JOIN relevant v ON r.user_id = v.user_id AND r.item_id = v.item_id""",
)
def hits(spark, sf_dir):
    """Top-k recommendations matching a relevant test row."""
    recs = popular_recs(spark, sf_dir).drop("rank")
    top = metrics.top_ranked(recs, K).withColumn("rec_rank", F.col("rec_rank").cast("int"))
    return metrics.hits(top, metrics.relevant_items(parts(spark, sf_dir)["test"]))


@register(
    "dcg_gains",
    S.with_ctes(S.INTERACTIONS, S.SPLIT2, S.TRAIN, S.TEST, S.TEST_USERS, S.popular(K), S.RECS,
                S.top_recs(K))
    + """SELECT r.user_id, r.item_id, r.rec_rank,
       round(CASE WHEN t.rating IS NOT NULL THEN 1.0 / log2(r.rec_rank + 1) ELSE 0 END, 6) AS gain
FROM top_recs r LEFT JOIN test t ON r.user_id = t.user_id AND r.item_id = t.item_id""",
)
def dcg_gains(spark, sf_dir):
    """C2 + B9 + H2: top-k recommendations left-joined to the test rows;
    a matched row gains 1/log2(rank + 1), an unmatched one 0."""
    recs = popular_recs(spark, sf_dir).drop("rank")
    out = metrics.dcg(recs, parts(spark, sf_dir)["test"], K)
    return out.withColumn("rec_rank", F.col("rec_rank").cast("int"))


_PR_SQL = f"""SELECT hits, total_recs, total_relevant,
       CASE WHEN total_recs > 0 THEN round(hits / total_recs, 6) ELSE 0.0 END AS precision_at_k,
       CASE WHEN total_relevant > 0 THEN round(hits / total_relevant, 6) ELSE 0.0 END AS recall_at_k
FROM (SELECT
  (SELECT count(*) FROM top_recs r JOIN relevant v USING (user_id, item_id)) AS hits,
  (SELECT count(*) FROM top_recs) AS total_recs,
  (SELECT count(*) FROM relevant) AS total_relevant)"""


@register(
    "precision_recall_at_k",
    S.with_ctes(S.INTERACTIONS, S.SPLIT2, S.TRAIN, S.TEST, S.TEST_USERS, S.popular(K), S.RECS,
                S.top_recs(K), S.relevant())
    + _PR_SQL,
)
def precision_recall_at_k(spark, sf_dir):
    """Pooled precision@k and recall@k of popularity recommendations."""
    recs = popular_recs(spark, sf_dir).drop("rank")
    return metrics.precision_recall(recs, parts(spark, sf_dir)["test"], K)


_NDCG_SQL = f""", ranked_test AS (
  SELECT *, rank() OVER (PARTITION BY user_id ORDER BY rating DESC) AS test_rank FROM test),
d AS (SELECT coalesce(sum(CASE WHEN t.rating IS NOT NULL THEN 1.0 / log2(r.rec_rank + 1) ELSE 0 END), 0)
             AS dcg
      FROM top_recs r LEFT JOIN ranked_test t USING (user_id, item_id)),
i AS (SELECT coalesce(sum(1.0 / log2(test_rank + 1)), 0) AS idcg
      FROM ranked_test WHERE test_rank <= {K})
SELECT round(dcg, 6) AS dcg, round(idcg, 6) AS idcg,
       CASE WHEN idcg > 0 THEN round(dcg / idcg, 6) ELSE 0.0 END AS ndcg_at_k
FROM d, i"""


@register(
    "ndcg_at_k",
    S.with_ctes(S.INTERACTIONS, S.SPLIT2, S.TRAIN, S.TEST, S.TEST_USERS, S.popular(K), S.RECS,
                S.top_recs(K))
    + _NDCG_SQL,
)
def ndcg_at_k(spark, sf_dir):
    """Pooled NDCG@k with binary gain."""
    recs = popular_recs(spark, sf_dir).drop("rank")
    return metrics.ndcg(recs, parts(spark, sf_dir)["test"], K)


_ERR_SQL = """SELECT round(sqrt(avg((rating - prediction) * (rating - prediction))), 6) AS rmse,
       round(avg(abs(rating - prediction)), 6) AS mae, count(*) AS n
FROM pred WHERE prediction IS NOT NULL AND rating IS NOT NULL"""


@register(
    "rating_errors",
    S.with_ctes(S.INTERACTIONS, S.SPLIT2, S.TRAIN, S.TEST, S.ITEM_MEAN_PRED) + _ERR_SQL,
)
def rating_errors(spark, sf_dir):
    """RMSE and MAE of item-mean predictions on the test part."""
    return metrics.rating_errors(item_mean_predictions(spark, sf_dir))


@register(
    "binary_metrics",
    S.with_ctes(S.INTERACTIONS, S.SPLIT2, S.TRAIN, S.TEST)
    + """, probs AS (
  SELECT CASE WHEN t.rating >= 4 THEN 1 ELSE 0 END AS label,
         (coalesce(s.pos, 0) + 1.0) / (coalesce(s.n, 0) + 2.0) AS probability
  FROM test t LEFT JOIN (SELECT item_id, sum(CASE WHEN rating >= 4 THEN 1 ELSE 0 END) AS pos,
                                count(*) AS n FROM train GROUP BY item_id) s USING (item_id)),
c AS (SELECT label, least(greatest(probability, 1e-7), 1 - 1e-7) AS p, probability FROM probs)
SELECT round(avg(-(label * ln(p) + (1 - label) * ln(1 - p))), 6) AS bce,
       round(avg(CASE WHEN (probability > 0.5) = (label = 1) THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       count(*) AS n
FROM c""",
)
def binary_metrics(spark, sf_dir):
    """Cross-entropy and accuracy of the item's smoothed share of
    ratings >= 4, label = rating >= 4."""
    p = parts(spark, sf_dir)
    scored = baselines.positive_share_probabilities(p["test"], p["train"]).withColumn(
        "label", (F.col(RATING) >= 4).cast("int")
    )
    return metrics.binary_metrics(scored)


@register(
    "metric_report",
    S.with_ctes(S.INTERACTIONS, S.SPLIT2, S.TRAIN, S.TEST, S.TEST_USERS, S.popular(K), S.RECS,
                S.top_recs(K), S.relevant(), S.ITEM_MEAN_PRED)
    + f""", ranked_test AS (
  SELECT *, rank() OVER (PARTITION BY user_id ORDER BY rating DESC) AS test_rank FROM test),
e AS (SELECT sqrt(avg((rating - prediction) * (rating - prediction))) AS rmse,
             avg(abs(rating - prediction)) AS mae FROM pred WHERE prediction IS NOT NULL),
h AS (SELECT (SELECT count(*) FROM top_recs r JOIN relevant v USING (user_id, item_id)) AS hits,
             (SELECT count(*) FROM top_recs) AS total_recs,
             (SELECT count(*) FROM relevant) AS total_relevant),
d AS (SELECT coalesce(sum(CASE WHEN t.rating IS NOT NULL THEN 1.0 / log2(r.rec_rank + 1) ELSE 0 END), 0)
             AS dcg
      FROM top_recs r LEFT JOIN ranked_test t USING (user_id, item_id)),
i AS (SELECT coalesce(sum(1.0 / log2(test_rank + 1)), 0) AS idcg
      FROM ranked_test WHERE test_rank <= {K})
SELECT round(rmse, 6) AS rmse, round(mae, 6) AS mae,
       CASE WHEN total_recs > 0 THEN round(hits / total_recs, 6) ELSE 0.0 END AS precision_at_k,
       CASE WHEN total_relevant > 0 THEN round(hits / total_relevant, 6) ELSE 0.0 END AS recall_at_k,
       CASE WHEN idcg > 0 THEN round(dcg / idcg, 6) ELSE 0.0 END AS ndcg_at_k,
       {K} AS k
FROM e, h, d, i""",
)
def metric_report(spark, sf_dir):
    """The five metrics in one row (popularity recommendations,
    item-mean predictions)."""
    p = parts(spark, sf_dir, once=True)
    recs = popular_recs(spark, sf_dir, p=p).drop("rank")
    return metrics.metric_report(recs, p["test"], item_mean_predictions(spark, sf_dir, p), K)


_PER_USER_SQL = f""", judged AS (
  SELECT r.user_id, r.item_id, r.rank,
         EXISTS (SELECT 1 FROM relevant v WHERE v.user_id = r.user_id AND v.item_id = r.item_id) AS hit
  FROM recs r),
seen AS (SELECT *, sum(CAST(hit AS INT)) OVER (PARTITION BY user_id ORDER BY rank) AS hits_so_far FROM judged),
own AS (SELECT user_id, count(*) AS n_recs, sum(CAST(hit AS INT)) AS hits, min(CASE WHEN hit THEN rank END) AS first_hit,
               sum(CASE WHEN hit THEN hits_so_far / rank ELSE 0 END) AS precisions,
               sum(CASE WHEN hit THEN 1.0 / log2(rank + 1) ELSE 0 END) AS dcg FROM seen GROUP BY user_id),
truth AS (SELECT user_id, count(DISTINCT item_id) AS n_rel FROM relevant GROUP BY user_id),
ideal AS (SELECT user_id, sum(1.0 / log2(i + 1)) AS idcg
          FROM (SELECT user_id, unnest(range(1, least(n_rel, {K}) + 1)) AS i FROM truth) GROUP BY user_id),
per_user AS (
  SELECT truth.user_id, n_rel, coalesce(hits, 0) AS hits,
         CASE WHEN n_recs > 0 THEN hits / n_recs ELSE 0.0 END AS precision_at_k,
         coalesce(hits, 0) / n_rel AS recall_at_k,
         coalesce(precisions, 0) / least(n_rel, {K}) AS average_precision,
         coalesce(1.0 / first_hit, 0.0) AS reciprocal_rank,
         coalesce(dcg, 0) / idcg AS ndcg_at_k
  FROM truth LEFT JOIN own USING (user_id) JOIN ideal USING (user_id))"""


@register(
    "per_user_metrics",
    S.with_ctes(S.INTERACTIONS, S.SPLIT2, S.TRAIN, S.TEST, S.TEST_USERS, S.popular(K), S.RECS, S.relevant())
    + _PER_USER_SQL
    + """SELECT user_id, CAST(n_rel AS BIGINT) AS n_rel, CAST(hits AS BIGINT) AS hits,
  round(precision_at_k, 6) AS precision_at_k, round(recall_at_k, 6) AS recall_at_k,
  round(average_precision, 6) AS average_precision, round(reciprocal_rank, 6) AS reciprocal_rank,
  round(ndcg_at_k, 6) AS ndcg_at_k FROM per_user""",
)
def per_user_metrics(spark, sf_dir):
    """Ranking metrics of each user with a relevant test item."""
    p = parts(spark, sf_dir, once=True)
    return metrics.per_user_ranking(popular_recs(spark, sf_dir, p=p), p["test"], K)


@register(
    "mean_ranking_metrics",
    S.with_ctes(S.INTERACTIONS, S.SPLIT2, S.TRAIN, S.TEST, S.TEST_USERS, S.popular(K), S.RECS, S.relevant())
    + _PER_USER_SQL
    + """SELECT count(*) AS users, round(avg(precision_at_k), 6) AS mean_precision, round(avg(recall_at_k), 6) AS mean_recall,
  round(avg(average_precision), 6) AS map_at_k, round(avg(reciprocal_rank), 6) AS mrr_at_k,
  round(avg(ndcg_at_k), 6) AS mean_ndcg, round(avg(CASE WHEN hits > 0 THEN 1.0 ELSE 0.0 END), 6) AS hit_rate
FROM per_user""",
)
def mean_ranking_metrics(spark, sf_dir):
    """The per-user metrics averaged over users."""
    p = parts(spark, sf_dir, once=True)
    return metrics.mean_ranking(metrics.per_user_ranking(popular_recs(spark, sf_dir, p=p), p["test"], K))


# ------------------------------------------------------- implicit feedback


@register(
    "implicit_matrix",
    """SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
       CAST(sum(CASE event_type WHEN 'purchase' THEN 5 WHEN 'click' THEN 2 WHEN 'view' THEN 1 ELSE 0 END) AS DOUBLE) AS rating
FROM events GROUP BY 1, 2
HAVING sum(CASE event_type WHEN 'purchase' THEN 5 WHEN 'click' THEN 2 WHEN 'view' THEN 1 ELSE 0 END) > 0""",
)
def implicit_matrix(spark, sf_dir):
    """F2 + D1: events as implicit feedback, one weight per (user, item)."""
    return prep.implicit_matrix(tables.implicit_interactions(spark, sf_dir))


# ------------------------------------------------------- sink round trips


@register("roundtrip_table", S.with_ctes(S.INTERACTIONS) + "SELECT * FROM interactions")
def roundtrip_table(spark, sf_dir):
    """A4 + A5: interactions written partitioned by user bucket, then the table
    overwritten from its own copy, and read back."""
    out = run_dir(spark, "table")
    sinks.write_table(tables.interactions(spark, sf_dir), f"{out}/by_user", bucket_user=USER, buckets=8)
    sinks.write_parquet(spark.read.parquet(f"{out}/by_user").drop("user_bucket"), f"{out}/plain")
    return spark.read.parquet(f"{out}/plain")


@register(
    "roundtrip_dictionary",
    """SELECT key, CAST(row_number() OVER (ORDER BY key) - 1 AS INTEGER) AS idx
FROM (SELECT DISTINCT 'item_' || CAST(p_partkey AS VARCHAR) AS key FROM part)""",
)
def roundtrip_dictionary(spark, sf_dir):
    """A6 + A3: the item dictionary written as a table and read back."""
    path = f"{run_dir(spark, 'dictionary')}/items"
    sinks.write_dictionary(item_dictionary(spark, sf_dir), path)
    return sinks.read_dictionary(spark, path)


@register(
    "roundtrip_metrics",
    S.with_ctes(S.INTERACTIONS, S.SPLIT2, S.TRAIN, S.TEST, S.ITEM_MEAN_PRED)
    + """SELECT round(sqrt(avg((rating - prediction) * (rating - prediction))), 6) AS rmse,
       round(avg(abs(rating - prediction)), 6) AS mae, '2.0' AS model_version
FROM pred WHERE prediction IS NOT NULL AND rating IS NOT NULL""",
)
def roundtrip_metrics(spark, sf_dir):
    """A metric row appended with its run time and version, read back."""
    path = f"{run_dir(spark, 'metrics')}/report"
    sinks.append_metrics(metrics.rating_errors(item_mean_predictions(spark, sf_dir)).select("rmse", "mae"), path, "2.0")
    back = spark.read.schema("rmse double, mae double, timestamp string, model_version string").json(path)
    return back.where(F.col("timestamp").rlike(r"^\d{8}_\d{6}$")).select("rmse", "mae", "model_version")


# --------------------------------------------------------------- monitoring


@register(
    "daily_activity",
    S.with_ctes(S.INTERACTIONS)
    + """SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, count(*) AS n,
       round(avg(CAST(rating AS DOUBLE)), 6) AS mean_rating, count(DISTINCT user_id) AS users
FROM interactions GROUP BY 1""",
)
def daily_activity(spark, sf_dir):
    """K5 in batch: tumbling one-day windows of interactions."""
    return tumbling_activity(tables.interactions(spark, sf_dir), "1 day", exact_users=True)


_LATEST = (
    S.with_ctes(S.INTERACTIONS, S.SPLIT3)
    + """SELECT user_id, item_id, rating, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, item_id ORDER BY ts DESC, rating DESC) AS rn
  FROM (SELECT user_id, item_id, rating, ts FROM split3 WHERE part IN ('train', 'val')
        UNION ALL
        SELECT user_id, item_id, rating, ts FROM split3 WHERE part IN ('val', 'test'))) WHERE rn = 1"""
)


@register("upsert_latest", _LATEST)
def upsert_latest(spark, sf_dir):
    """K4 in batch: a snapshot (train + val) upserted with a change set
    (val + test): latest row per (user, item) wins."""
    tagged = split.assign_parts(
        tables.interactions(spark, sf_dir), (0.8, 0.1, 0.1), ("train", "val", "test")
    )
    base = tagged.filter(F.col("part").isin("train", "val")).drop("part")
    changes = tagged.filter(F.col("part").isin("val", "test")).drop("part")
    return upsert(base, changes, [USER, ITEM], order=[TS, RATING])


@register("merge_buckets", _LATEST)
def merge_buckets(spark, sf_dir):
    """K4 at rest: the same upsert as two merges into a bucketed table, each
    rewriting the touched buckets only; the last snapshot."""
    tagged = stored(split.assign_parts(
        tables.interactions(spark, sf_dir), (0.8, 0.1, 0.1), ("train", "val", "test")
    ))
    path = run_dir(spark, "merge")
    versioned.create(tagged.filter(F.col("part").isin("train", "val")).drop("part"), path, [USER, ITEM], [TS, RATING], 16)
    for part in ("val", "test"):
        versioned.merge(tagged.filter(F.col("part") == part).drop("part"), path)
    return versioned.read(spark, path)


@register(
    "grow_dictionary",
    S.with_ctes(S.INTERACTIONS, S.RAW)
    + """, day AS (SELECT user_id, "timestamp" AS t, ("timestamp" - (SELECT min("timestamp") FROM raw)) // 259200 AS d FROM raw),
first AS (SELECT user_id, min(d) AS d, min(t) AS t FROM day GROUP BY user_id),
step AS (SELECT *, CASE WHEN d < 10 THEN 0 WHEN d < 30 THEN 1 ELSE 2 END AS s FROM first)
SELECT user_id AS key, CAST(row_number() OVER (ORDER BY s, t, user_id) - 1 AS INTEGER) AS idx FROM step""",
)
def grow_dictionary(spark, sf_dir):
    """J1 in three increments of time: ids in order of first appearance, unseen
    ones behind the largest index."""
    raw = stored(tables.raw_interactions(spark, sf_dir))
    day = F.floor((F.col("timestamp") - raw.agg(F.min("timestamp")).scalar()) / 259200)
    found = ids.dictionary_by_appearance(raw.where(day < 10), USER, ["timestamp"])
    for step in ((day >= 10) & (day < 30), day >= 30):
        found = ids.extend_dictionary(stored(found), raw.where(step), USER, ["timestamp"])
    return found


@register(
    "split_exact",
    S.with_ctes(S.INTERACTIONS, S.RAW)
    + """SELECT user_id, item_id, rating, "timestamp",
       CASE WHEN rn <= floor(n * 0.8::DOUBLE) THEN 'train'
            WHEN rn <= floor(n * 0.8::DOUBLE) + floor(n * 0.1::DOUBLE) THEN 'val' ELSE 'test' END AS part
FROM (SELECT *, row_number() OVER (ORDER BY md5(concat_ws(',', user_id, item_id, rating, "timestamp"))) AS rn,
             count(*) OVER () AS n FROM raw)""",
)
def split_exact(spark, sf_dir):
    """B12 with exact sizes: the raw rows with their part."""
    return split.exact_parts(stored(tables.raw_interactions(spark, sf_dir)))
