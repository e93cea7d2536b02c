"""Shared folder and the session settings the plans are designed for."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings worth having on a cluster. Nothing here is needed for right results.
CLUSTER_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    # Split hot join partitions even where that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Upper bound; adaptive execution merges small partitions down from here.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    "spark.sql.files.maxPartitionBytes": "256m",
    # A landing task holds few months: write them side by side instead of sorting first.
    "spark.sql.maxConcurrentOutputFileWriters": "32",
    "spark.sql.parquet.compression.codec": "zstd",
}


def tune(spark: SparkSession) -> None:
    """Apply the cluster settings the session leaves open. Runs never do this by themselves."""
    for key, value in CLUSTER_CONF.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir`` of the session.

    Only a local session may go without; it then gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="tripmill-")
    return _local_folders[context.applicationId]


def scratch_folder(spark: SparkSession) -> str:
    """The part of the shared folder that this application writes intermediate tables to."""
    return f"{shared_folder(spark)}/scratch-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the scratch folder."""
    return f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application.

    Results that are not written or collected yet may still read them: call it after.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(scratch_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def ensure_checkpoints(spark: SparkSession) -> None:
    """Let iterative training cut its lineage in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
