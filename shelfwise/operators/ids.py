"""Id dictionaries: dense 0-based indexes, lookups and reverse lookups
(J1, C3, C4, B3-B5, H5).

The dictionary is a DataFrame ``(key, idx)``, never a driver-side dict, and
lookups are joins: the optimizer broadcasts a dictionary when AQE measures
it under the broadcast threshold. For a larger one :func:`encode` hashes its side
of each shuffle partition (its keys are unique and spread evenly), so that the
interactions are not sorted by their string ids. AQE's skew handling splits a
hot key on the interaction side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.schema import ITEM, USER
from shelfwise.session import ensure_checkpoint_dir

MAX_INT_INDEX = 2**31 - 1
#: Dictionaries of so many keys are some 10 MB, Spark's default for a broadcast.
BROADCAST_KEYS = 250_000


def dense_index(
    df: DataFrame,
    order: Sequence[str | Column],
    out: str = "idx",
    num_partitions: int | None = None,
) -> DataFrame:
    """Give every row its 0-based position in the total order ``order``.

    Equals ``row_number() OVER (ORDER BY order) - 1`` but never moves all
    rows into one task: rows are range-partitioned and sorted within
    partitions; each row's offset inside its partition comes from
    ``monotonically_increasing_id`` and each partition's start from a running
    sum over the per-partition counts (one row per partition, so that small
    table is broadcast on a proven bound). The range-partitioned rows are
    checkpointed to the shared checkpoint folder first, so that a lost
    executor cannot re-run the range sampling with different bounds between
    the count and the numbering; with
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` (which the session
    helper sets) Spark deletes it once nothing refers to it any more.
    ``order`` must be a total order.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    # The range sampling and the checkpoint both read the input: keep it
    # cached for those two passes only, and leave a caller's cache alone.
    level = df.storageLevel
    cached = level.useMemory or level.useDisk
    source = df if cached else df.persist()
    # Without an explicit count AQE sizes the range partitions (it only
    # merges neighbouring ranges, so partition order is still key order).
    ranged = (source.repartitionByRange(num_partitions, *order_cols) if num_partitions
              else source.repartitionByRange(*order_cols))
    placed = (
        ranged.sortWithinPartitions(*order_cols)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    if not cached:
        source.unpersist()
    starts = placed.groupBy("_pid").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first")
    )
    # One row per partition: the running sum is over at most n rows.
    starts = starts.withColumn(
        "_offset",
        F.coalesce(
            F.sum("_n").over(
                Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ),
    ).select("_pid", "_first", "_offset")
    return (
        placed.join(F.broadcast(starts), "_pid")
        .withColumn(out, F.col("_offset") + F.col("_pos") - F.col("_first"))
        .drop("_pid", "_pos", "_first", "_offset")
    )


def build_dictionary(
    df: DataFrame,
    key: str,
    num_partitions: int | None = None,
) -> DataFrame:
    """``(key, idx int)`` with idx dense from 0 in sorted key order.

    Null keys are not indexed. Stable across runs and partitionings: the
    same keys always get the same indexes.
    """
    keys = df.select(F.col(key).alias("key")).where(F.col("key").isNotNull()).distinct()
    indexed = dense_index(keys, ["key"], out="idx", num_partitions=num_partitions)
    return indexed.select("key", _int_index(F.col("idx")).alias("idx"))


def _int_index(idx: Column) -> Column:
    return F.when(idx <= MAX_INT_INDEX, idx.cast("int")).otherwise(
        F.raise_error(F.lit("dictionary exceeds the int index range")))


def dictionary_by_appearance(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """``(key, idx int)`` with idx dense from 0 in order of first appearance:
    by the least ``order`` columns of a key's rows (nulls first), ties by the key.
    Null keys are not indexed."""
    return extend_dictionary(None, df, key, order)


def extend_dictionary(dictionary: DataFrame | None, df: DataFrame, key: str, order: Sequence[str] = ()) -> DataFrame:
    """J1 for data that keeps coming: ``dictionary`` with the unseen keys of
    ``df`` behind its largest index, in order of first appearance (of the key,
    without ``order``). Old keys keep their indexes, so models and tables
    written with them stay valid.

    A key's rows are combined map-side to one, so a hot key costs one row per
    task; old keys leave by an anti join on unique keys before the numbering."""
    names = [f"_o{i}" for i in range(len(order))]
    rows = df.select(F.col(key).alias("key"), *[F.col(c).alias(n) for c, n in zip(order, names)]).where("key is not null")
    seen = F.min(F.struct(*names)).alias("_seen") if names else F.lit(0).alias("_seen")
    keys = rows.groupBy("key").agg(seen)
    if dictionary is not None:
        keys = keys.join(dictionary.select("key"), "key", "left_anti")
    placed = dense_index(keys, ["_seen", "key"], out="idx").select("key", "idx")
    if dictionary is None:
        return placed.select("key", _int_index(F.col("idx")).alias("idx"))
    ahead = dictionary.agg(F.coalesce(F.max("idx"), F.lit(-1)).cast("bigint") + 1).scalar()
    return dictionary.select("key", "idx").unionByName(
        placed.select("key", _int_index(F.col("idx") + ahead).alias("idx")))


def encode(df: DataFrame, dictionary: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Replace ``column`` by its dictionary index (inner join, so rows
    whose key is missing from the dictionary are dropped: B3)."""
    out = out or column
    lookup = dictionary.select(F.col("key").alias("_key"), F.col("idx").alias("_idx"))
    if dictionary.count() > BROADCAST_KEYS:
        lookup = lookup.hint("shuffle_hash")
    joined = df.join(lookup, df[column] == lookup["_key"], "inner")
    return joined.drop(column, "_key").withColumnRenamed("_idx", out)


def index_interactions(
    df: DataFrame,
    user_dictionary: DataFrame,
    item_dictionary: DataFrame,
    user: str = USER,
    item: str = ITEM,
) -> DataFrame:
    """C3 + B3-B5: string ids -> int indexes under the same column names;
    rows with an unknown user or item are dropped."""
    cols = df.columns
    out = encode(df, user_dictionary, user)
    out = encode(out, item_dictionary, item)
    return out.select(*cols)


def decode(df: DataFrame, dictionary: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """C4 + H5: index -> original key; an index missing from the dictionary
    becomes its decimal string (left join + coalesce)."""
    out = out or column
    lookup = dictionary.select(F.col("key").alias("_key"), F.col("idx").alias("_idx"))
    joined = df.join(lookup, df[column] == lookup["_idx"], "left")
    restored = F.coalesce(F.col("_key"), df[column].cast("string"))
    cols = [restored.alias(out) if c == column else F.col(c) for c in df.columns]
    if out != column and out not in df.columns:
        cols = [F.col(c) for c in df.columns] + [restored.alias(out)]
    return joined.select(*cols)


def dictionary_from_json(json_text: DataFrame, column: str = "value") -> DataFrame:
    """A3: a JSON object ``{key: idx}`` held in a string column (one object
    per row, e.g. ``spark.read.text(path, wholetext=True)``) -> ``(key, idx)``."""
    parsed = json_text.select(F.from_json(F.col(column), "map<string,int>").alias("m"))
    return parsed.select(F.explode("m").alias("key", "idx"))
