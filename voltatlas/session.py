"""Session settings and the shared scratch folder."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


# Settings that only count when the session starts.
LAUNCH_CONF = {
    # Without the Python stack of every Column call a plan is built several times faster.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every job here relies on."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def setting(spark: SparkSession, key: str) -> str | None:
    """A session setting, or the one given at launch, or None."""
    return spark.conf.get(key, None) or spark.sparkContext.getConf().get(key)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``.  A folder
    of this machine is only good enough when all executors live on it.
    """
    shared = setting(spark, "spark.checkpoint.dir")
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="voltatlas-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def checkpointed(df, spark: SparkSession | None = None):
    """Reliable checkpoint of ``df`` in the shared folder."""
    spark = spark or df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_dir(spark, "checkpoint"))
    return df.checkpoint()


def release(spark: SparkSession) -> None:
    """Let the shuffle files of finished phases go now: Spark drops them once nothing refers to their plan.

    The first round frees the plans, which Spark's cleaner then notices in the next.
    """
    for _ in range(3):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def spread(df: DataFrame) -> DataFrame:
    """Enough partitions for every core, for CPU-heavy work on a table of few row groups.

    A table large enough to fill the cluster is left as it is read.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
