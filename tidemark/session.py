"""Session building and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings every plan here assumes.

    Nothing sizes memory or picks executors: that belongs to spark-submit. ``master`` is only for
    tests and local benches.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        # deduplication and session state may exceed executor memory
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        # sessions of a hot key are merged inside each task first
        .config("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
        # checks make many small plans; keep all their generated classes
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A machine-local folder is made only for a local master that names none.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set(CHECKPOINT_CONF, root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """Fresh, unique folder name under the shared root (not created)."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes a result to the shared folder and reads it again: one evaluation, whoever loses an executor."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    """Partition count for the explicit repartitions in this package."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
