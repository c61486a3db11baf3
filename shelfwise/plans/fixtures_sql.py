"""DuckDB forms of the fixtures, for the oracle queries.

Each constant is a list of ``name AS (...)`` common table expressions over
the driver's pre-registered views; :func:`with_ctes` joins the ones a query
needs into one ``WITH`` clause.
"""

from __future__ import annotations

INTERACTIONS = """interactions AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id,
         CAST(floor((l_quantity - 1) / 10) + 1 AS INTEGER) AS rating,
         l_shipdate AS ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

RAW = """raw AS (
  SELECT 'user_' || CAST(user_id AS VARCHAR) AS user_id,
         'item_' || CAST(item_id AS VARCHAR) AS item_id,
         CAST(rating AS BIGINT) AS rating,
         CAST(epoch(ts) AS BIGINT) AS "timestamp"
  FROM interactions)"""

DIRTY = """dirty AS (
  SELECT * FROM interactions
  UNION ALL SELECT * FROM interactions WHERE item_id % 7 = 0
  UNION ALL SELECT user_id, item_id, CAST(NULL AS INTEGER) AS rating, ts
            FROM interactions WHERE item_id % 11 = 0
  UNION ALL SELECT user_id, CAST(-1 AS BIGINT) AS item_id, rating, ts
            FROM interactions WHERE item_id % 13 = 0)"""

RAW_DIRTY = """raw_dirty AS (
  SELECT 'user_' || CAST(user_id AS VARCHAR) AS user_id,
         'item_' || CAST(item_id AS VARCHAR) AS item_id,
         CAST(rating AS BIGINT) AS rating,
         CAST(epoch(ts) AS BIGINT) AS "timestamp"
  FROM dirty)"""


def split_hash(cols: str = "user_id, item_id") -> str:
    return f"('0x' || substr(md5(concat_ws(',', {cols})), 1, 8))::BIGINT"


def share(x: float) -> int:
    """Hash bound of a cumulative weight."""
    return round(x * 2**32)


SPLIT2 = f"""split2 AS (
  SELECT *, CASE WHEN {split_hash()} < {share(0.8)} THEN 'train' ELSE 'test' END AS part
  FROM interactions)"""

SPLIT3 = f"""split3 AS (
  SELECT *, CASE WHEN {split_hash()} < {share(0.8)} THEN 'train'
                 WHEN {split_hash()} < {share(0.9)} THEN 'val' ELSE 'test' END AS part
  FROM interactions)"""

TRAIN = "train AS (SELECT user_id, item_id, rating, ts FROM split2 WHERE part = 'train')"
TEST = "test AS (SELECT user_id, item_id, rating, ts FROM split2 WHERE part = 'test')"
TEST_USERS = "test_users AS (SELECT DISTINCT user_id FROM test)"


def popular(k: int) -> str:
    return f"""popular AS (
  SELECT item_id, score, CAST(row_number() OVER (ORDER BY score DESC, item_id) AS INTEGER) AS rank
  FROM (SELECT item_id, CAST(count(*) AS DOUBLE) AS score FROM train GROUP BY item_id)
  ORDER BY score DESC, item_id LIMIT {k})"""


RECS = """recs AS (
  SELECT u.user_id, p.item_id, p.score AS predicted_rating, p.rank
  FROM test_users u, popular p)"""


def top_recs(k: int) -> str:
    return f"""top_recs AS (
  SELECT * FROM (
    SELECT user_id, item_id, predicted_rating,
           CAST(rank() OVER (PARTITION BY user_id ORDER BY predicted_rating DESC) AS INTEGER) AS rec_rank
    FROM recs) WHERE rec_rank <= {k})"""


def relevant(threshold: float = 4.0) -> str:
    return f"relevant AS (SELECT * FROM test WHERE rating >= {threshold})"


ITEM_MEAN_PRED = """pred AS (
  SELECT t.user_id, t.item_id, t.rating,
         coalesce(m.item_mean, (SELECT avg(CAST(rating AS DOUBLE)) FROM train)) AS prediction
  FROM test t LEFT JOIN (SELECT item_id, avg(CAST(rating AS DOUBLE)) AS item_mean
                         FROM train GROUP BY item_id) m USING (item_id))"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
