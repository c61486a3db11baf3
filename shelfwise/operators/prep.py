"""Cleaning, de-duplication and the long-form user-item matrix.

All of these are aggregates, so a key that holds a third of the rows (a
hot user, or one row copied a million times) is combined map-side by the
partial aggregate before the shuffle instead of landing whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.columns import epoch_to_ts
from shelfwise.operators.latest import best_row
from shelfwise.schema import ITEM, RATING, USER


def drop_null(df: DataFrame, column: str = RATING) -> DataFrame:
    """B2: rows whose ``column`` is null are dropped."""
    return df.filter(F.col(column).isNotNull())


def dedupe(
    df: DataFrame,
    keys: Sequence[str],
    prefer: str | None = RATING,
) -> DataFrame:
    """One row per ``keys``.

    The survivor is deterministic: the row with the largest ``prefer`` value
    (then the largest remaining columns), see
    :func:`shelfwise.operators.latest.best_row`. With no non-key column this
    is ``distinct`` on the keys.
    """
    rest = [c for c in df.columns if c not in keys]
    if prefer is not None and prefer in rest:
        rest = [prefer] + [c for c in rest if c != prefer]
    return best_row(df, keys, rest)


def preprocess_interactions(
    df: DataFrame,
    keys: Sequence[str] = (USER, ITEM, "timestamp"),
    epoch_col: str | None = "timestamp",
    rating_col: str = RATING,
    ntz: bool = False,
) -> DataFrame:
    """P2's cleaning step: epoch seconds -> ``timestamp`` (B1; ``ntz`` for the
    wall-clock type, which cannot carry a watermark), drop null ratings (B2),
    then one row per key (B10).

    The null filter runs *before* the de-duplication: the other order can
    drop a key entirely when the arbitrary survivor is the null-rated copy.
    """
    out = df
    if epoch_col is not None:
        out = out.withColumn(epoch_col, epoch_to_ts(F.col(epoch_col), ntz=ntz))
    out = drop_null(out, rating_col)
    return dedupe(out, keys, prefer=rating_col)


def user_item_matrix(df: DataFrame, user: str = USER, item: str = ITEM,
                     rating: str = RATING) -> DataFrame:
    """Mean rating per ``(user, item)`` as a long-form sparse matrix."""
    return df.groupBy(user, item).agg(F.avg(F.col(rating)).alias(RATING))


def distinct_values(df: DataFrame, column: str = USER) -> DataFrame:
    """Distinct values of one column (e.g. the users of a test set)."""
    return df.select(column).distinct()


#: Confidence of one event of each type; other types carry none.
EVENT_WEIGHTS = {"purchase": 5.0, "click": 2.0, "view": 1.0}


def implicit_matrix(events: DataFrame, user: str = USER, item: str = ITEM,
                    kind: str = "event_type") -> DataFrame:
    """D1 on implicit feedback: ``(user, item, rating)`` with the summed
    weights of a pair's events; pairs without weight are left out."""
    weight = F.lit(0.0)
    for name, value in EVENT_WEIGHTS.items():
        weight = F.when(F.col(kind) == name, value).otherwise(weight)
    return events.groupBy(user, item).agg(F.sum(weight).alias(RATING)).where(F.col(RATING) > 0)
