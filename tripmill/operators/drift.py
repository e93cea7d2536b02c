"""How the columns of a feed change from file to file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def schema_drift(columns: DataFrame) -> DataFrame:
    """Per feed and column: files analysed, files having it, types and spellings seen.

    Input rows are ``(feed, file, name, type)``, one per column of each file.
    Spellings that differ in case only are one column.
    """
    files = columns.groupBy("feed").agg(F.count_distinct("file").alias("files_analyzed"))
    per_column = columns.groupBy("feed", F.lower("name").alias("column_name")).agg(
        F.count_distinct("file").alias("files_with_column"),
        F.array_join(F.array_sort(F.collect_set("type")), ",").alias("types"),
        F.array_join(F.array_sort(F.collect_set("name")), ",").alias("spellings"),
    )
    same = F.col("files_with_column") == F.col("files_analyzed")
    single = (F.locate(",", F.col("types")) == 0) & (F.locate(",", F.col("spellings")) == 0)
    return per_column.join(files, "feed").withColumn("drifts", ~(same & single))


def file_columns(columns: DataFrame) -> DataFrame:
    """Per feed and file: its columns in file order and their number."""
    listed = F.array_sort(F.collect_list(F.struct("position", "name")))
    return columns.groupBy("feed", "file").agg(
        F.array_join(listed["name"], ",").alias("columns"),
        F.count(F.lit(1)).alias("column_count"),
    )


def union_columns(columns: DataFrame) -> DataFrame:
    """Per feed: every column name seen, sorted, and the number of files."""
    return columns.groupBy("feed").agg(
        F.array_join(F.array_sort(F.collect_set("name")), ",").alias("union_columns"),
        F.count_distinct("file").alias("files_analyzed"),
    )
