"""Table sinks and model persistence.

Writers are plain DataFrame writers run by the executors; nothing is
gathered on the driver. The format is a parameter (``parquet`` by default;
``delta`` or any other source whose jar is on the classpath works the same).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.util import MLReadable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.columns import run_stamp
from shelfwise.operators.ids import dictionary_from_json
from shelfwise.schema import DICTIONARY, USER
from shelfwise.sources import versioned


def write_parquet(df: DataFrame, path: str) -> None:
    """A4: full overwrite as Parquet."""
    df.write.mode("overwrite").parquet(path)


def user_bucket(user: str = USER, buckets: int = 64):
    """Stable hash bucket of a user id: the partition column that replaces
    one directory per user (millions of tiny files at scale)."""
    return F.pmod(F.xxhash64(F.col(user)), F.lit(buckets)).cast("int")


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] | None = None,
    bucket_user: str | None = None,
    buckets: int = 64,
) -> None:
    """A5: overwrite a table, optionally partitioned.

    ``bucket_user`` adds a ``user_bucket`` partition column (hash of the user
    id) and partitions by it; readers prune with
    ``user_bucket = pmod(xxhash64(id), n)``.

    Rows are range-partitioned on the partition columns followed by row
    keys, not hash-partitioned on the partition columns alone: each task then
    writes a contiguous slice of one or two directories (few files per
    directory, balanced tasks), and a user holding a third of the rows is
    still cut into many slices by the trailing keys.
    """
    out = df
    cols = list(partition_by or [])
    if bucket_user is not None:
        out = out.withColumn("user_bucket", user_bucket(bucket_user, buckets))
        cols.append("user_bucket")
    writer = out
    if cols:
        simple = [f.name for f in df.schema.fields
                  if f.dataType.simpleString() in ("bigint", "int", "string", "double", "timestamp",
                                                   "timestamp_ntz", "date", "float")]
        tail = [c for c in simple if c not in cols][:3]
        writer = out.repartitionByRange(*[F.col(c) for c in cols + tail])
    w = writer.write.format(fmt).mode("overwrite")
    if cols:
        w = w.partitionBy(*cols)
    w.save(path)


def write_dictionary(dictionary: DataFrame, path: str) -> None:
    """The id dictionary as a table ``(key, idx)``."""
    dictionary.select("key", "idx").write.mode("overwrite").parquet(path)


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """A3: a dictionary written by :func:`write_dictionary`."""
    return spark.read.schema(DICTIONARY).parquet(path)


def read_json_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """A3: a JSON object file ``{key: idx}`` as the reference writes it."""
    return dictionary_from_json(spark.read.text(path, wholetext=True))


def append_metrics(report: DataFrame, path: str, model_version: str = "1.0") -> DataFrame:
    """Append a metric row stamped with the run time (H6) and model
    version as JSON; returns the stamped row."""
    stamped = report.withColumn("timestamp", run_stamp()).withColumn(
        "model_version", F.lit(model_version)
    )
    stamped.coalesce(1).write.mode("append").json(path)
    return stamped


def save_model(model, path: str, latest_path: str | None = None) -> str:
    """A10: save a Spark ML model; optionally publish it as the latest one,
    which the serving step reads. The pointer is switched atomically (see
    :mod:`shelfwise.sources.versioned`); give each run a path of its own, so that
    the model it pointed to stays whole."""
    model.write().overwrite().save(path)
    if latest_path is not None:
        versioned.set_pointer(SparkSession.active(), latest_path, path)
    return path


def latest_model_path(spark: SparkSession, latest_path: str) -> str:
    return versioned.pointer(spark, latest_path)


def load_model(cls: type[MLReadable], path: str):
    """A10: ``ALSModel.load``, ``PipelineModel.load``..."""
    return cls.load(path)


def served(recs: DataFrame) -> DataFrame:
    """Served recommendations: ``(user_id, item_id, score, timestamp)``,
    one timestamp per query (H7)."""
    return recs.select(
        F.col(USER).cast("string").alias(USER),
        F.col("item_id").cast("string").alias("item_id"),
        F.col("score").cast("double").alias("score"),
        F.current_timestamp().alias("timestamp"),
    )

