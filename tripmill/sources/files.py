"""Files as data: listings, manifests and Parquet footers."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.functions.periods import source_name

FOOTER_SCHEMA = "path string, position int, name string, type string"


def list_files(spark: SparkSession, root: str | list[str], glob: str) -> DataFrame:
    """Path, size and time of every matching file; no content is read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "length", "modificationTime")
    )


# Names of stores in paths that Hadoop and Arrow spell differently.
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs", "wasbs": "abfs"}


def arrow_uri(path: str) -> str:
    """A path as Spark lists it in the spelling that Arrow knows."""
    scheme, sep, rest = path.partition("://")
    return f"{SCHEMES.get(scheme, scheme)}://{rest}" if sep else path


def _opener():
    """A function for tasks: path as listed by Spark -> open file, on any Arrow file system."""

    def open_file(path: str):
        from urllib.parse import unquote, urlparse

        import pyarrow.fs as pafs

        parts = urlparse(path)
        if parts.scheme in ("", "file"):
            return pafs.LocalFileSystem().open_input_file(unquote(parts.path))
        filesystem, location = pafs.FileSystem.from_uri(arrow_uri(path))
        return filesystem.open_input_file(location)

    return open_file


def file_manifest(
    spark: SparkSession, root: str, glob: str, prefix: str = "", media_type: str = "image/jpeg"
) -> DataFrame:
    """Name, path, label, size, MD5 and media type of files.

    The label is the file stem without ``prefix``. Spark reads and hashes the contents, so
    any store that it reads will do.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(root)
    )
    name = F.element_at(F.split("path", "/"), -1)
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    label = F.replace(stem, F.lit(prefix), F.lit("")) if prefix else stem
    return files.select(
        name.alias("file_name"),
        F.col("path").alias("file_path"),
        label.alias("borough"),
        F.col("length").alias("file_size_bytes"),
        F.md5("content").alias("content_hash"),
        F.lit(media_type).alias("media_type"),
    )


def footer_columns(files: DataFrame) -> DataFrame:
    """One row per column of each Parquet file, read from the footers by the executors."""
    open_file = _opener()

    def read_footers(batches: Iterator) -> Iterator:
        import pandas as pd
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_type

        def spark_type(arrow_type) -> str:
            try:
                return from_arrow_type(arrow_type, prefer_timestamp_ntz=True).simpleString()
            except Exception:
                return str(arrow_type)

        for batch in batches:
            rows = []
            for path in batch["path"]:
                with open_file(path) as handle:
                    schema = pq.read_schema(handle)
                rows += [(path, i, f.name, spark_type(f.type)) for i, f in enumerate(schema)]
            yield pd.DataFrame(rows, columns=["path", "position", "name", "type"])

    return files.select("path").mapInPandas(read_footers, FOOTER_SCHEMA)


def with_source(columns: DataFrame) -> DataFrame:
    """Footer rows with the name of the source (file, or directory of parts) they belong to."""
    return columns.withColumn("file", source_name(F.col("path")))
