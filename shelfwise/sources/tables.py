"""Scans of the given tables and the interaction fixtures derived from them.

Every fixture is a lazy DataFrame over the parquet tables, so Catalyst
prunes columns and pushes filters into the scans (``ReadSchema`` holds only
the columns a query uses).
"""

from __future__ import annotations

import logging
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfwise.functions.columns import ts_to_epoch
from shelfwise.schema import ITEM, RATING, TS, USER

log = logging.getLogger(__name__)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: StructType | None = None,
) -> DataFrame:
    """Generic table scan (A1/A2). ``fmt`` is any Spark data source name;
    a declared ``schema`` avoids inference. Failures are logged and re-raised."""
    try:
        reader = spark.read.format(fmt)
        if schema is not None:
            reader = reader.schema(schema)
        return reader.load(path)
    except Exception:
        log.exception("could not read %s table at %s", fmt, path)
        raise


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables (columns are pruned by the queries)."""
    return read_table(spark, table_path(sf_dir, name))


def rating_from_quantity(quantity: Column) -> Column:
    """1..5 from the line quantity 1..50 (FIXTURES F1)."""
    return (F.floor((quantity - F.lit(1)) / F.lit(10)) + F.lit(1)).cast("int")


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(user_id bigint, item_id bigint, rating int, ts timestamp_ntz)``.

    One row per line item: the order's customer rates the part. The join is
    on ``orderkey`` (sort-merge at scale, broadcast only if AQE measures the
    orders side under its threshold); both sides are pruned to their keys.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_shipdate"
    )
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.col("o_custkey").alias(USER),
        F.col("l_partkey").alias(ITEM),
        rating_from_quantity(F.col("l_quantity")).alias(RATING),
        F.col("l_shipdate").alias(TS),
    )


def raw_form(df: DataFrame) -> DataFrame:
    """F1-shaped rows in the reference's raw shape: string ids
    ``user_<n>``/``item_<n>``, ``rating`` bigint, ``timestamp`` bigint epoch
    seconds."""
    return df.select(
        F.concat(F.lit("user_"), F.col(USER).cast("string")).alias(USER),
        F.concat(F.lit("item_"), F.col(ITEM).cast("string")).alias(ITEM),
        F.col(RATING).cast("bigint").alias(RATING),
        ts_to_epoch(F.col(TS)).alias("timestamp"),
    )


def raw_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 in the reference's raw shape (see :func:`raw_form`)."""
    return raw_form(interactions(spark, sf_dir))


def implicit_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as implicit feedback. ``item_id`` is ``$.k`` of ``props``."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id"),
        F.col(USER),
        F.get_json_object("props", "$.k").cast("bigint").alias(ITEM),
        F.col("event_type"),
        F.col("value"),
        F.col(TS),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` as ``(vec_id, embedding array<double>, label)``."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.col("embedding").cast("array<double>").alias("embedding"),
        "label",
    )


def planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1's pairs with a learnable low-rank rating (model tests only)."""
    return interactions(spark, sf_dir).withColumn(
        RATING,
        (F.lit(1) + ((F.col(USER) % 5 + F.col(ITEM) % 5) % 5)).cast("int"),
    )


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 plus exact copies, copies with a null rating and rows whose
    item is unknown (-1); for the cleaning, lookup and null rules."""
    one = lambda item, rating: F.struct(item.alias(ITEM), rating.alias(RATING))
    item, rating, none = F.col(ITEM), F.col(RATING), F.lit(None).cast("int")
    made = F.array(  # one pass: each row and the rows made from it
        one(item, rating),
        F.when(item % 7 == 0, one(item, rating)),
        F.when(item % 11 == 0, one(item, none)),
        F.when(item % 13 == 0, one(F.lit(-1).cast("bigint"), rating)),
    )
    rows = interactions(spark, sf_dir).select(USER, TS, F.explode(made).alias("_r")).where("_r is not null")
    return rows.select(USER, F.col("_r")[ITEM].alias(ITEM), F.col("_r")[RATING].alias(RATING), TS)
