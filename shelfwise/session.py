"""Session helpers.

Library functions never create a session: every operator takes DataFrames
(and, where it reads, a ``SparkSession``). These helpers are for tests,
``bench.py`` and command-line runs.
"""

from __future__ import annotations

import gc
import tempfile
import threading
import time
import uuid
from contextlib import suppress

from pyspark.sql import SparkSession

RELEASE_AFTER = (1.2, 1.0, 2.0)


def build_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app_name: str = "shelfwise",
    driver_memory: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    return spark.conf.get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``. Only a local-mode session
    with nothing configured (tests) falls back to a fresh scratch folder; on
    a cluster a machine-local folder would not survive a lost executor, so an
    unset setting is an error there."""
    configured = checkpoint_dir(spark)
    if configured:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(configured)
        return spark.sparkContext.getCheckpointDir()
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, S3, ...)")
    local = tempfile.mkdtemp(prefix="shelfwise-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder; what is written there
    goes when the driver's JVM exits."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/shelfwise-{name}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def release_unused(spark: SparkSession) -> None:
    """Spark deletes the shuffle files (and cached blocks) of frames that nothing
    refers to any more when the driver collects its garbage, which a driver with
    little to do may not do before the disks are full. Call it after a large step
    whose intermediate frames are gone. The JVM learns with a delay what Python let
    go, and needs more than one collection: they run beside the caller,
    ``RELEASE_AFTER`` seconds after the call."""
    def collect() -> None:
        with suppress(Exception):  # the session may have ended
            for seconds in RELEASE_AFTER:
                time.sleep(seconds)
                spark._jvm.System.gc()

    gc.collect()
    threading.Thread(target=collect, daemon=True).start()
