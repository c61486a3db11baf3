"""Structured Streaming versions of ingest and monitoring (K1-K3, K5).

The reference claims real-time processing but has no streaming code; these
are the Spark-native forms of its batch steps. State is bounded by
watermarks; sinks are idempotent per micro-batch (``foreachBatch`` writes
keyed by the batch id), and progress lives in a checkpoint location under
the shared ``spark.checkpoint.dir``, so a restarted query resumes where it
stopped.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from shelfwise.functions.columns import epoch_to_ts
from shelfwise.operators import least_squares, scoring
from shelfwise.schema import ITEM, RATING, USER
from shelfwise.session import ensure_checkpoint_dir, release_unused
from shelfwise.sources.sinks import user_bucket, write_table
from shelfwise.streaming.monitor import tumbling_activity

EXCLUSION_BUCKETS = 64


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one streaming run under the shared checkpoint dir."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "streams", f"{name}-{uuid.uuid4().hex[:12]}")


def interaction_stream(spark: SparkSession, path: str, schema: StructType,
                       fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """K1: new files under ``path`` as a stream with a declared schema."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def with_event_time(stream: DataFrame, epoch_col: str = "timestamp",
                    out: str = "event_time") -> DataFrame:
    """Event time as a ``timestamp`` (a watermark cannot sit on
    ``timestamp_ntz``) from epoch seconds."""
    return stream.withColumn(out, epoch_to_ts(F.col(epoch_col), ntz=False))


def dedupe_stream(stream: DataFrame, keys: Sequence[str], event_time: str = "event_time",
                  delay: str = "10 minutes", rating: str | None = "rating") -> DataFrame:
    """K2: drop null ratings, then duplicates of ``keys`` arriving within the
    watermark delay; rows later than the watermark are dropped. Key state is
    evicted once the watermark passes it."""
    out = stream
    if rating is not None:
        out = out.filter(F.col(rating).isNotNull())
    return out.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def dedupe_stream_combined(stream: DataFrame, keys: Sequence[str], event_time: str = "event_time",
                           delay: str = "10 minutes", rating: str = "rating") -> DataFrame:
    """K2, skew-safe form: one row per key with the highest rating, as a
    watermarked streaming aggregation. Copies are combined by the partial
    aggregate on each map task before the shuffle, so a row copied a third of
    a micro-batch never lands whole on one task; the survivor is the same as
    the batch rule (B10). Run it in ``update`` mode into
    :func:`write_stream_batches` and read it with :func:`latest_per_key`
    (``append`` mode would hold each key until the watermark passes it).
    Late rows are dropped and key state is evicted by the watermark."""
    grouped = (
        stream.filter(F.col(rating).isNotNull())
        .withWatermark(event_time, delay)
        .groupBy(*keys, event_time)
    )
    return grouped.agg(F.max(rating).alias(rating))


def activity_stream(stream: DataFrame, width: str = "1 day", event_time: str = "event_time",
                    delay: str = "1 day") -> DataFrame:
    """K5: tumbling-window rows / mean rating / approximate active users."""
    return tumbling_activity(stream.withWatermark(event_time, delay), width, ts=event_time)


def write_stream_batches(stream: DataFrame, path: str, checkpoint: str, mode: str = "update",
                         available_now: bool = True) -> StreamingQuery:
    """``foreachBatch`` sink for update-mode aggregates: each micro-batch is
    written under ``batch_id=<n>``, overwriting that folder only, so a
    replayed batch replaces its own output (idempotent)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(path, f"batch_id={batch_id}"))

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode(mode)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def latest_per_key(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Final values of an update-mode sink: per key the row of the highest
    ``batch_id`` (an aggregate of ``max(struct(batch_id, ...))``)."""
    df = spark.read.parquet(path)
    rest = [c for c in df.columns if c not in keys and c != "batch_id"]
    # a batch writes a key once, so each column's value at the highest batch
    # is that of the same row; fixed-width buffers make this a hash aggregate
    return df.groupBy(*keys).agg(*[F.max_by(c, "batch_id").alias(c) for c in rest])


def compact(spark: SparkSession, path: str, keys: Sequence[str], into: str) -> DataFrame:
    """Write the final values so far as batch -1 of a fresh sink ``into``, so
    that readers of a long-lived stream don't read every batch again."""
    latest_per_key(spark, path, keys).write.mode("overwrite").parquet(os.path.join(into, "batch_id=-1"))
    return spark.read.parquet(into)


def refresh_topk(stream: DataFrame, user_factors: DataFrame, item_factors: DataFrame, k: int,
                 exclusions: DataFrame | None, path: str, checkpoint: str,
                 available_now: bool = True, fold_in: float | None = None) -> StreamingQuery:
    """K3: for the users seen in each micro-batch, recompute their exact
    top-k from the model's factors (minus their exclusions) and write them
    as that batch's slice of the recommendation table. Readers take each
    user's rows of the latest batch (:func:`latest_recommendations`).

    Exclusions are reduced to distinct pairs once and stored by user bucket
    (A5), so that a batch reads its users' buckets and not the whole history.
    A known user's list follows from factors and exclusions, which stay the same
    while the stream runs: a user who comes again gets the rows that an earlier
    batch of this run wrote, and the catalogue is scored once per user.

    With ``fold_in`` (the model's ridge) users the model has not seen get
    vectors too: least squares of all their ratings so far against the fixed item
    factors (:func:`shelfwise.operators.least_squares.fold_in`). Their ratings are
    kept by batch and user bucket beside the recommendations, a replayed batch
    replacing its own; the items they rated are excluded. Without it they get
    nothing."""
    store, heard = path + "-exclusions", path + "-unseen"
    spark = user_factors.sparkSession
    done: list[int] = []  # batches of this run
    if exclusions is not None:
        write_table(exclusions.distinct(), store, bucket_user=USER, buckets=EXCLUSION_BUCKETS)

    def refresh(batch: DataFrame, batch_id: int) -> None:
        users = batch.select(USER).distinct()
        wanted = user_factors.join(users, USER, "left_semi")
        own = copied = None
        if earlier := [b for b in done if b != batch_id]:
            before = latest_recommendations(spark, path, batches=earlier)
            copied = before.join(wanted.select(USER), USER, "left_semi")
            wanted = wanted.join(before.select(USER).distinct(), USER, "left_anti")
        wanted = first = wanted.persist()
        if exclusions is not None:
            ids = first.select(F.col(USER).cast(exclusions.schema[USER].dataType).alias(USER))  # hashed as they were stored
            hit = ids.select(user_bucket(USER, EXCLUSION_BUCKETS).alias("b")).distinct().collect()  # few buckets
            own = spark.read.parquet(store).where(F.col("user_bucket").isin([r["b"] for r in hit])).drop("user_bucket")
        if fold_in is not None:
            unseen = batch.select(USER, ITEM, RATING).join(user_factors, USER, "left_anti").withColumn(
                "user_bucket", user_bucket(USER, EXCLUSION_BUCKETS))
            unseen.write.mode("overwrite").partitionBy("user_bucket").parquet(os.path.join(heard, f"batch_id={batch_id}"))
            new = unseen.select(USER, "user_bucket").distinct().persist()
            hit = [r["user_bucket"] for r in new.select("user_bucket").distinct().collect()]  # few buckets
            ratings = (spark.read.schema(f"{unseen.schema.simpleString()[7:-1].replace(':', ' ')}, batch_id bigint").parquet(heard)
                       .where(F.col("user_bucket").isin(hit) & (F.col("batch_id") <= batch_id))
                       .join(new.select(USER), USER, "left_semi").select(USER, ITEM, RATING))
            known = wanted.select(USER, F.col("features").cast("array<double>").alias("features"))
            wanted = known.unionByName(least_squares.fold_in(ratings, item_factors, fold_in).select(
                F.col(USER).cast(known.schema[USER].dataType).alias(USER), "features"))
            rated = ratings.select(USER, ITEM).distinct()
            own = rated if own is None else own.select(USER, ITEM).unionByName(rated)
            new.unpersist()
        recs = scoring.topk_vectors(wanted, item_factors, k, exclusions=own)
        if copied is not None:
            recs = recs.unionByName(copied)
        recs.write.mode("overwrite").parquet(os.path.join(path, f"batch_id={batch_id}"))
        first.unpersist()
        done.append(batch_id)
        release_unused(spark)

    writer = stream.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def latest_recommendations(spark: SparkSession, path: str, user: str = USER,
                           batches: Sequence[int] | None = None) -> DataFrame:
    """Each user's recommendation rows from the latest batch (of ``batches``,
    if given) that refreshed that user (semi join on ``(user, last batch)``)."""
    df = spark.read.parquet(path)
    if batches is not None:
        df = df.where(F.col("batch_id").isin(list(batches)))
    last = df.groupBy(user).agg(F.max("batch_id").alias("batch_id"))
    return df.join(last, [user, "batch_id"], "left_semi").drop("batch_id")
