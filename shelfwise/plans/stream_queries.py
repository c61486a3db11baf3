"""Registered streaming queries.

Each one derives its input files from the given tables with Spark, runs the
stream to completion (``availableNow``) into a sink under the shared
checkpoint folder, and returns the sink's contents as a DataFrame. Rows arrive
in several micro-batches of ascending event time; results equal the batch
operators', which is what the oracles check, with late rows left out.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.columns import epoch_to_ts, instant_to_ntz, ntz_to_instant, split_hash, ts_to_epoch
from shelfwise.operators import als
from shelfwise.plans.catalog import K, register
from shelfwise.plans import fixtures_sql as S
from shelfwise.plans.model_queries import _COUNTS, _IDX2, _KEYS, _serving_counts, indexed_parts
from shelfwise.plans.pipelines import stored
from shelfwise.schema import ITEM, RAW_INTERACTIONS, USER
from shelfwise.sources import tables
from shelfwise.streaming import ingest


SLICES = 4


def _landed(spark: SparkSession, df: DataFrame, name: str, by, late: DataFrame | None = None,
            slices: int = SLICES) -> tuple[str, str, int]:
    """Write ``df``, read several times, to a landing folder in ``slices`` steps of ascending
    ``by`` (a number), the ``late`` rows with the last; returns (landing path, run
    folder, files per step). Each step is a job of its own, so file times
    ascend; a step has as many files as there are shuffle partitions."""
    run = ingest.run_dir(spark, name)
    landing = os.path.join(run, "landing")
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.withColumn("_by", by)
    cuts = rows.approxQuantile("_by", [i / slices for i in range(1, slices)], 0.01)
    for low, high in zip([None, *cuts], [*cuts, None]):
        keep = F.lit(True)
        if low is not None:
            keep &= F.col("_by") > low
        if high is not None:
            keep &= F.col("_by") <= high
        part = rows.where(keep).drop("_by")
        if high is None and late is not None:
            part = part.unionByName(late)
        part.repartition(files).write.mode("append").parquet(landing)
    return landing, run, files


@register(
    "stream_dedupe",
    S.with_ctes(S.INTERACTIONS, S.DIRTY, S.RAW_DIRTY)
    + """SELECT user_id, item_id, max(rating) AS rating, "timestamp" FROM raw_dirty
WHERE rating IS NOT NULL GROUP BY user_id, item_id, "timestamp" """,
)
def stream_dedupe(spark, sf_dir):
    """K1 + K2: raw interactions with copies and null ratings arrive as files
    over several batches; one row per key survives (highest rating), copies
    combined map-side. The last batch brings rows of the first days with a
    rating that would win: the watermark drops them."""
    raw = stored(tables.raw_form(tables.dirty(spark, sf_dir)))  # one pass over the tables
    early = raw.where(F.col("timestamp") <= raw.agg(F.min("timestamp") + 30 * 86400).scalar())
    late = early.withColumn("rating", F.lit(99).cast("bigint"))
    landing, run, files = _landed(spark, raw, "dedupe", F.col("timestamp"), late)
    stream = ingest.with_event_time(ingest.interaction_stream(
        spark, landing, RAW_INTERACTIONS, max_files_per_trigger=files))
    deduped = ingest.dedupe_stream_combined(stream, [USER, ITEM, "timestamp"], delay="1 hour")
    out = os.path.join(run, "out")
    q = ingest.write_stream_batches(deduped, out, os.path.join(run, "checkpoint"))
    q.awaitTermination()
    final = ingest.latest_per_key(spark, out, [USER, ITEM, "timestamp"])
    return final.select(USER, ITEM, "rating", "timestamp")


@register(
    "stream_activity",
    S.with_ctes(S.INTERACTIONS)
    + """SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, count(*) AS n,
       round(avg(CAST(rating AS DOUBLE)), 6) AS mean_rating
FROM interactions GROUP BY 1""",
)
def stream_activity(spark, sf_dir):
    """K5 streaming: one-day tumbling windows with a watermark, update mode,
    final value per window; rows of the first month that come again in the
    last batch are too late to count."""
    raw = stored(tables.raw_interactions(spark, sf_dir))
    late = raw.where(F.col("timestamp") <= raw.agg(F.min("timestamp") + 30 * 86400).scalar())
    landing, run, files = _landed(spark, raw, "activity", F.col("timestamp"), late)
    stream = ingest.with_event_time(ingest.interaction_stream(
        spark, landing, RAW_INTERACTIONS, max_files_per_trigger=files))
    agg = ingest.activity_stream(stream, "1 day", delay="1 day").drop("users")
    out = os.path.join(run, "out")
    q = ingest.write_stream_batches(agg, out, os.path.join(run, "checkpoint"))
    q.awaitTermination()
    final = ingest.latest_per_key(spark, out, ["window_start"])
    # The window start is an instant; report it as UTC wall-clock time
    # whatever the session time zone.
    return final.select(
        epoch_to_ts(F.unix_seconds(F.col("window_start"))).alias("window_start"),
        "n",
        "mean_rating",
    )


def _refreshed(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(recommendations, train) of the refresh stream."""
    parts = indexed_parts(spark, sf_dir)
    model = als.fit(parts["train"])
    uf, itf = als.factors(model)
    landing, run, files = _landed(spark, stored(parts["test"]), "refresh", F.col("timestamp"))
    stream = spark.readStream.schema(spark.read.parquet(landing).schema).option(
        "maxFilesPerTrigger", files
    ).parquet(landing)
    out = os.path.join(run, "recs")
    q = ingest.refresh_topk(
        stream, uf, itf, K, parts["train"].select(USER, ITEM), out, os.path.join(run, "checkpoint")
    )
    q.awaitTermination()
    return ingest.latest_recommendations(spark, out), parts["train"]


@register("stream_topk_refresh")
def stream_topk_refresh(spark, sf_dir):
    """K3: test interactions stream in; each micro-batch refreshes the exact
    top-k (train items excluded) of the users it touched."""
    return _refreshed(spark, sf_dir)[0]


@register("stream_topk_refresh_counts", S.with_ctes(S.INTERACTIONS, S.RAW, _KEYS, _IDX2) + _COUNTS)
def stream_topk_refresh_counts(spark, sf_dir):
    """K3: each known test user ends with min(k, unseen items), none of them seen."""
    return _serving_counts(*_refreshed(spark, sf_dir))


_NEW_USER = f"{S.split_hash('user_id')} < {S.share(0.2)}"


def _folded(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(recommendations, seen pairs) of a refresh stream whose model has not
    seen a fifth of the users."""
    parts = indexed_parts(spark, sf_dir)
    new = split_hash(USER) < F.lit(S.share(0.2))
    known = stored(parts["train"].where(~new))
    uf, itf = als.factors(als.fit(known))
    landing, run, files = _landed(spark, stored(parts["test"]), "fold-in", F.col("timestamp"))
    stream = spark.readStream.schema(spark.read.parquet(landing).schema).option("maxFilesPerTrigger", files).parquet(landing)
    out = os.path.join(run, "recs")
    q = ingest.refresh_topk(stream, uf, itf, K, known.select(USER, ITEM), out, os.path.join(run, "checkpoint"),
                            fold_in=als.AlsParams().reg_param)
    q.awaitTermination()
    seen = known.select(USER, ITEM).unionByName(parts["test"].where(new).select(USER, ITEM))
    return ingest.latest_recommendations(spark, out), seen


@register(
    "stream_topk_fold_in",
    S.with_ctes(S.INTERACTIONS, S.RAW, _KEYS, _IDX2)
    + f""", known AS (SELECT * FROM idx_train WHERE NOT ({_NEW_USER})),
seen AS (
  SELECT user_id, item_id FROM known
  UNION ALL SELECT user_id, item_id FROM idx_test WHERE {_NEW_USER} AND item_id IN (SELECT item_id FROM known))
SELECT CAST(user_id AS BIGINT) AS user_id, CAST(least({K}, n_items - n_seen) AS BIGINT) AS n_recs, CAST(0 AS BIGINT) AS n_seen
FROM (SELECT user_id, count(DISTINCT item_id) AS n_seen FROM seen GROUP BY user_id)
     JOIN (SELECT DISTINCT user_id FROM idx_test) USING (user_id),
     (SELECT count(DISTINCT item_id) AS n_items FROM known)
WHERE n_items > n_seen""",
)
def stream_topk_fold_in(spark, sf_dir):
    """K3: users the model has not seen are folded in from the ratings that
    streamed in; every test user ends with min(k, unseen items)."""
    return _serving_counts(*_folded(spark, sf_dir))


@register(
    "stream_event_activity",
    """SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n,
       round(avg(value), 6) AS mean_value
FROM events GROUP BY 1, 2""",
)
def stream_event_activity(spark, sf_dir):
    """K1 + K5 on the ``events`` table as the stream source: hourly events
    and mean value per event type, watermarked, update mode."""
    from shelfwise.streaming.monitor import event_activity

    events = tables.table(spark, sf_dir, "events")
    landing, run, files = _landed(spark, events, "events", ts_to_epoch("ts"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(landing).withColumn(
        "event_time", ntz_to_instant(F.col("ts"))
    )
    agg = event_activity(stream.withWatermark("event_time", "1 hour"), "1 hour", ts="event_time")
    out = os.path.join(run, "out")
    q = ingest.write_stream_batches(agg, out, os.path.join(run, "checkpoint"))
    q.awaitTermination()
    final = ingest.latest_per_key(spark, out, ["window_start", "event_type"])
    return final.select(
        instant_to_ntz(F.col("window_start")).alias("window_start"), "event_type", "n", "mean_value"
    )
