"""Keep an intermediate result for several readers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.storagelevel import StorageLevel

from tripmill.session import scratch_path


@contextmanager
def persisted(df: DataFrame) -> Iterator[DataFrame]:
    """Keep ``df`` on executor disks for the block; a lost executor's part is recomputed."""
    kept = df.persist(StorageLevel.DISK_ONLY)
    try:
        yield kept
    finally:
        kept.unpersist()


def materialised(df: DataFrame, label: str, parts: Sequence[str] = ()) -> DataFrame:
    """``df`` written to the shared folder and read back: no lineage left to recompute.

    Readers that filter by columns of ``parts`` open only the files of their values.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.partitionBy(*parts).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def written(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``materialised`` for a block, after which the copy is deleted."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
