"""Session helpers: one place for the configuration the library relies on."""

from __future__ import annotations

import os
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter for correctness (time zone) and for scale (AQE,
# skew handling, partition sizing).  Values are conservative defaults that a
# cluster deployment overrides with its own spark-defaults.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
    # 10 MB: broadcast joins only for sides the planner has sized.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    # checkpointed frames that nothing refers to any more are deleted
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "caseflow") -> SparkSession:
    """Return the active session or build a local one with DEFAULT_CONF."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    builder = builder.master(master or os.environ.get("CASEFLOW_MASTER", "local[*]"))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str = "/tmp/caseflow-checkpoints") -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; set ``fallback`` only on a local master.

    On a cluster the setting names a shared folder (HDFS/S3/ABFS); without it
    this is an error, since a machine-local folder would lose data.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not sc.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    target = configured or fallback
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir() or target


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """``values`` hold for the statements inside, then what was set before."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


#: Shuffle files of a statement are removed when it ends, instead of when the JVM happens to collect its plan.
FREED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def freed(spark: SparkSession):
    """Statements inside leave no shuffle files behind; for writes, whose plans nobody runs again."""
    return settings(spark, FREED)


def materialize(df):
    """Cut lineage with a reliable checkpoint in the shared ``spark.checkpoint.dir``.

    The frame is persisted first so the checkpoint job reads the computed rows
    instead of recomputing the plan (an unpersisted reliable checkpoint runs
    the plan twice); the cache is dropped once the files exist.  Never a
    local checkpoint: the files must survive the loss of an executor.
    """
    from pyspark import StorageLevel
    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out
