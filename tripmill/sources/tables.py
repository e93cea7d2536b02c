"""Layered Parquet tables: partitioned writes, reads, optional inputs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tripmill.functions.ordering import by

TRIP_PARTITIONS: tuple[str, ...] = ("vehicle_type", "year_month")


def write_partitions(
    df: DataFrame,
    path: str,
    keys: Sequence[str] = TRIP_PARTITIONS,
    whole: bool = False,
    gather: bool = True,
) -> None:
    """Replace exactly the partitions present in ``df``, or the ``whole`` table.

    ``gather`` brings a partition's rows together for few large files: one
    exchange, in which adaptive execution splits a partition past the advisory
    size, so a month holding a third of all trips is still written by many
    tasks. Without it each task writes what it holds, which costs no exchange and
    is right where the input files already lie by partition.
    """
    rows = df.hint("rebalance", *keys) if gather else df
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace a table. Adaptive execution merges small output partitions."""
    df.write.mode("overwrite").format(fmt).save(path)


def write_compact(df: DataFrame, path: str) -> None:
    """Replace a table with as few files as the advisory partition size allows."""
    df.hint("rebalance").write.mode("overwrite").parquet(path)


def write_sorted(df: DataFrame, path: str, keys: Sequence[str], fmt: str = "parquet") -> None:
    """Replace a table laid out by its lookup keys.

    Range partitioning on the keys and all other columns keeps files disjoint and
    splits even a single hot key over several files; sorted rows let a reader of
    one key skip row groups.
    """
    names = [k.lstrip("-") for k in keys]
    rest = [c for c, kind in df.dtypes if c not in names and not kind.startswith("map")]
    order = by(*keys, *rest)
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").format(
        fmt
    ).save(path)


def read_feeds(
    spark: SparkSession, path: str, feeds: Sequence[str] | None = None
) -> DataFrame:
    """Landed rows of the given feeds, or of all; only their directories are listed.

    Feeds have different columns, so reading several merges their schemas. Values of the
    partition columns are text, as they were written.
    """
    paths = [path] if feeds is None else [f"{path}/vehicle_type={feed}" for feed in feeds]
    several = "false" if len(paths) == 1 and feeds is not None else "true"
    return spark.read.option("basePath", path).option("mergeSchema", several).parquet(*paths)


def if_found(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``read`` declares, or None where there is no such path. Other failures are raised."""
    try:
        return read()
    except FileNotFoundError:
        return None
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None where nothing was written yet."""
    return if_found(lambda: spark.read.parquet(path))
