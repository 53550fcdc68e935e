"""Session settings and the shared scratch location."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Whether shuffle files go when the write or query that made them ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(name: str = "tidewatch", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators rely on; `conf` entries win."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    `spark.checkpoint.dir` decides. A session without it uses a folder on the default filesystem of its Hadoop settings,
    and is told about it so that later calls agree. A local disk (`file:`) is refused then, unless the master is local:
    executors elsewhere would not see what is written there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        named = _default_dir(spark)
        spark.conf.set("spark.checkpoint.dir", named)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def _default_dir(spark: SparkSession) -> str:
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    base = hadoop.get("fs.defaultFS", "file:///").rstrip("/")
    local = spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"
    if base.startswith("file:") and not local:
        raise ValueError("Name a folder that all executors share in spark.checkpoint.dir: the default filesystem is a local disk")
    if base.startswith("file:"):
        return f"{hadoop.get('hadoop.tmp.dir', '/tmp/hadoop').rstrip('/')}/tidewatch"
    return f"{base}/tmp/tidewatch-{spark.sparkContext.sparkUser()}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """Written to `path` and read from there. The shuffle files of the write go when it ends; else they stay until the driver
    happens to collect its garbage, and the larger the table, the more of them lie beside each other."""
    spark = df.sparkSession
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.parquet(path)


def discard(spark: SparkSession, paths: Iterable[str]) -> None:
    """Removes work tables below the shared folder that nothing reads any more."""
    for path in paths:
        there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(there, True)


def pinned(df: DataFrame) -> DataFrame:
    """Materialise a small derived table once, on reliable storage, and cut its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
