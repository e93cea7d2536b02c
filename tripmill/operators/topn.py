"""First n rows under a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def cut_off(df: DataFrame, n: int, bucket: Column) -> DataFrame:
    """The rows up to the bucket that holds the n-th row: at least n, if there are as many.

    Rows are counted per bucket (combined before the exchange), the last bucket needed is
    found among the buckets, and the rows beyond it are filtered out where they are read.
    """
    counts = df.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    seen = F.sum("_n").over(Window.orderBy("_bucket")) - F.col("_n")  # one row per bucket
    last = counts.select("_bucket", seen.alias("_before")).filter(F.col("_before") < n)
    return df.filter(bucket <= last.agg(F.max("_bucket")).scalar())


def top_n(df: DataFrame, order: Sequence[Column], n: int, bucket: Column | None = None) -> DataFrame:
    """The first ``n`` rows. ``order`` must leave no ties.

    Every task hands over up to ``n`` rows, so a large ``n`` needs a ``bucket``: a coarse
    number that never falls along the order, with a bounded number of values and never
    null. Then only rows that can be among the first are sorted. ``df`` is read twice.
    """
    if bucket is not None:
        df = cut_off(df, n, bucket)
    return df.orderBy(*order).limit(n)
