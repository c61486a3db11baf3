"""Tumbling-window monitoring of interactions (K5), batch or streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.schema import RATING, TS, USER


def tumbling_activity(
    df: DataFrame,
    width: str = "1 day",
    ts: str = TS,
    exact_users: bool = False,
) -> DataFrame:
    """Rows, mean rating and active users per tumbling window.

    Works on a batch DataFrame and, unchanged, on a streaming one that has a
    watermark on ``ts``. Streams cannot count exact distinct values, so
    ``exact_users=False`` uses ``approx_count_distinct`` (HyperLogLog++,
    mergeable partial state); the batch oracle uses the exact count.
    """
    users = F.countDistinct(USER) if exact_users else F.approx_count_distinct(USER)
    return (
        df.groupBy(F.window(F.col(ts), width).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(F.col(RATING).cast("double")).alias("mean_rating"),
            users.alias("users"),
        )
        .select(F.col("w.start").alias("window_start"), "n", "mean_rating", "users")
    )


def event_activity(events: DataFrame, width: str = "1 hour", ts: str = TS) -> DataFrame:
    """Raw activity monitoring: events and mean ``value`` per tumbling
    window and ``event_type`` (batch, or streaming with a watermark)."""
    return (
        events.groupBy(F.window(F.col(ts), width).alias("w"), F.col("event_type"))
        .agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value"))
        .select(F.col("w.start").alias("window_start"), "event_type", "n", "mean_value")
    )
