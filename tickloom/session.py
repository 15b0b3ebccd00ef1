"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings every job wants.  Shuffle width is left to the cluster: AQE coalesces small
#: partitions and splits skewed join partitions at run time.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # long streams keep their window state off-heap and on local disk, not in the JVM heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

_LOCAL_DIRS: dict[str, str] = {}


def job_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """Session for a batch or streaming job; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in JOB_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """All time arithmetic here is in UTC whatever zone the caller's session had."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir`` that every executor can reach.

    Only a local-mode session without that setting gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL_DIRS:
            _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="tickloom-")
        base = _LOCAL_DIRS[app]
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def cut_lineage(df, name: str):
    """Write ``df`` to the shared folder and read it back.

    Used where a frame feeds two branches of one plan: both then read the written table instead
    of computing the frame twice, and a lost executor costs a re-read, not a re-run.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def measured(df, name: str):
    """Store a small aggregate before a join, so that the planner knows its size.

    Spark cannot tell the size of an aggregate in advance and would shuffle the large side too.  A
    stored table is broadcast if its files are below ``spark.sql.autoBroadcastJoinThreshold`` and
    joined by shuffle, with skewed partitions split, if not.
    """
    return cut_lineage(df, name)
