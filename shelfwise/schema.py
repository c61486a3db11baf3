"""Declared schemas and column names shared by all operators."""

from __future__ import annotations

from pyspark.sql import types as T

USER = "user_id"
ITEM = "item_id"
RATING = "rating"
TS = "ts"
SCORE = "score"
RANK = "rank"

# Interactions as the operators see them (FIXTURES F1).
INTERACTIONS = T.StructType(
    [
        T.StructField(USER, T.LongType()),
        T.StructField(ITEM, T.LongType()),
        T.StructField(RATING, T.IntegerType()),
        T.StructField(TS, T.TimestampNTZType()),
    ]
)

# Interactions in the raw form of the reference: string ids, epoch seconds.
RAW_INTERACTIONS = T.StructType(
    [
        T.StructField(USER, T.StringType()),
        T.StructField(ITEM, T.StringType()),
        T.StructField(RATING, T.LongType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

# An id dictionary: original key -> dense 0-based index.
DICTIONARY = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("idx", T.IntegerType())]
)

# Flat recommendations.
RECOMMENDATIONS = T.StructType(
    [
        T.StructField(USER, T.LongType()),
        T.StructField(ITEM, T.LongType()),
        T.StructField(SCORE, T.DoubleType()),
        T.StructField(RANK, T.IntegerType()),
    ]
)

# Nested recommendations, the shape Spark ML's ALS returns.
NESTED_RECOMMENDATIONS = T.StructType(
    [
        T.StructField(USER, T.IntegerType()),
        T.StructField(
            "recommendations",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField(ITEM, T.IntegerType()),
                        T.StructField(RATING, T.FloatType()),
                    ]
                )
            ),
        ),
    ]
)

METRICS = T.StructType(
    [
        T.StructField("rmse", T.DoubleType()),
        T.StructField("mae", T.DoubleType()),
        T.StructField("precision_at_k", T.DoubleType()),
        T.StructField("recall_at_k", T.DoubleType()),
        T.StructField("ndcg_at_k", T.DoubleType()),
        T.StructField("k", T.IntegerType()),
    ]
)
