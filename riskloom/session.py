"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.driver.memory": "16g",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.showConsoleProgress": "false",
}


# Suggested settings for a large cluster (100 TB inputs): many shuffle
# partitions that AQE coalesces to ~256 MB, skew splitting of hot join keys,
# 256 MB scan splits, a shared checkpoint folder (given by the cluster).
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
}


def get_spark(master: str = "local[8]", app: str = "riskloom",
              shuffle_partitions: int = 8, conf: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    for k, v in {**DEFAULT_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions),
                 **(conf or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is used as is (an
    unset value is an error there).  Only in local mode, when it is unset
    (tests), is a private scratch folder created.
    """
    current = spark.sparkContext.getCheckpointDir()
    d = spark.conf.get("spark.checkpoint.dir", None) or current
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        d = tempfile.mkdtemp(prefix="riskloom-ckpt-")   # local mode (tests) only
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001 - some deployments reject core confs at run time
            pass
    if not current:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), name)


def materialize(df):
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder
    (survives executor loss; never a local checkpoint)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df):
    """``df`` written under the checkpoint folder and read again.  A checkpoint keeps its plan's estimate of size, which
    every join multiplies; where a loop joins what it made before, the estimate has more digits each round until planning
    takes longer than the job.  A table that is read has the size of its files."""
    path = scratch_path(df.sparkSession, f"stored-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
