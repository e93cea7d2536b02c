"""Land new raw files as they arrive, each file once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tripmill.operators.conform import feed_label
from tripmill.sources.landing import land_feed
from tripmill.sources.tables import TRIP_PARTITIONS, write_partitions
from tripmill.specs import FeedSpec

# Columns of Spark's binary file source; the content is never selected, so never read.
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def land_new_files(
    spark: SparkSession,
    root: str,
    spec: FeedSpec,
    target: str,
    checkpoint: str,
    files_per_batch: int = 1_000,
) -> StreamingQuery:
    """Land the files not landed yet, then stop.

    The stream carries file names, so files of differing schemas can arrive in
    one batch. A batch writes partitions of its own number; if it is repeated
    after a failure it replaces them, so no row is landed twice.
    """

    def land(batch: DataFrame, number: int) -> None:
        paths = [row["path"] for row in batch.select("path").collect()]
        if not paths:
            return
        own = F.col(spec.feed_column).cast("string") if spec.feed_column else F.lit(spec.name)
        landed = land_feed(batch.sparkSession, paths, spec).withColumns(
            {"vehicle_type": feed_label(own, spec), "landing_batch": F.lit(number)}
        )
        write_partitions(landed, target, (*TRIP_PARTITIONS, "landing_batch"), gather=False)

    return (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(root)
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
