"""Which rows are valid trips, and how many are not."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.functions.numbers import rounded
from tripmill.functions.ordering import total_order
from tripmill.specs import TRIP_IDENTITY, QualityBounds


def quality_predicate(bounds: QualityBounds) -> Column:
    """Pickup time and both zones known and in range, fare unknown or in range. Never null."""
    fare = F.col("fare_amount")
    zones = [
        F.col(name).isNotNull() & F.col(name).between(bounds.min_zone, bounds.max_zone)
        for name in ("pu_location_id", "do_location_id")
    ]
    return (
        F.col("pickup_ts").isNotNull()
        & zones[0]
        & zones[1]
        & (fare.isNull() | fare.between(bounds.min_fare, bounds.max_fare))
    )


def apply_quality(trips: DataFrame, bounds: QualityBounds) -> DataFrame:
    return trips.filter(quality_predicate(bounds))


def keep_latest(
    trips: DataFrame,
    keys: Sequence[str] = TRIP_IDENTITY,
    newest: Sequence[str] = ("-ingestion_ts",),
    drop: Sequence[str] = (),
) -> DataFrame:
    """The newest row per key, ties broken by all other columns; null keys are equal.

    Spark limits each key to one row before the exchange (WindowGroupLimit), so
    even a key held by a third of all rows sends one row per input partition.
    That needs a sort, which compares the first eight bytes of the first key
    before anything else: text keys, alike in their first letters, go last.
    """
    types = dict(trips.dtypes)
    keys = sorted(keys, key=lambda k: types[k] == "string")
    rank = Window.partitionBy(*keys).orderBy(*total_order(trips, newest, skip=keys))
    return trips.withColumn("_rank", F.row_number().over(rank)).filter("_rank = 1").drop("_rank", *drop)


#: Partitions of a table that holds the trips that were kept and those that were rejected.
VERDICT_PARTITIONS = ("verdict", "vehicle_type", "year_month")
KEPT, REJECTED = "kept", "rejected"


def judge(
    trips: DataFrame,
    bounds: QualityBounds,
    keys: Sequence[str] = TRIP_IDENTITY,
    newest: Sequence[str] = ("-ingestion_ts",),
    drop: Sequence[str] = (),
) -> DataFrame:
    """Every rejected row and the newest valid row per key, told apart by ``verdict``.

    One pass for both: a rejected row has a number of its own beside the key, so it is
    the only one of its group, whatever its key, and many of them spread over all tasks.
    The numbers need only differ, so a retried task may give others. Rows still are
    limited to one per key before the exchange.
    """
    valid = quality_predicate(bounds)
    numbered = trips.withColumns(
        {
            "verdict": F.when(valid, KEPT).otherwise(REJECTED),
            "_row": F.when(~valid, F.monotonically_increasing_id()),
        }
    )
    return keep_latest(numbered, (*keys, "_row"), newest, ("_row", *drop))


def report_of_parts(landed: DataFrame, rejected: DataFrame | None, kept: DataFrame) -> DataFrame:
    """Quality report from the rows landed, rejected and kept, each counted per feed.

    ``landed`` and ``kept`` are counted by their partitions, which Spark reads from file
    footers; of ``rejected`` (None if there are none) the pickup times are read too, as a
    row without one is never kept. Feeds without a name are one feed.
    """
    columns = ("rows_read", "invalid_records", "_no_pickup", "rows_kept")

    def counted(rows: DataFrame, *found: Column) -> DataFrame:
        by_feed = rows.groupBy("vehicle_type").agg(*found)
        zero = F.lit(0).cast("bigint")
        given = [c if c in by_feed.columns else zero.alias(c) for c in columns]
        return by_feed.select(F.col("vehicle_type").cast("string"), *given)

    n = F.count(F.lit(1))
    parts = [counted(landed, n.alias("rows_read")), counted(kept, n.alias("rows_kept"))]
    if rejected is not None:
        missing = F.count_if(F.col("pickup_ts").isNull()).alias("_no_pickup")
        parts.append(counted(rejected, n.alias("invalid_records"), missing))
    sums = reduce(DataFrame.unionByName, parts).groupBy("vehicle_type").agg(
        *[F.sum(c).alias(c) for c in columns]
    )
    read = F.col("rows_read")
    return sums.select(
        "vehicle_type",
        "rows_read",
        rounded(F.col("_no_pickup") / F.greatest(read, F.lit(1)), 4).alias("null_rate"),
        "invalid_records",
        (read - F.col("invalid_records") - F.col("rows_kept")).alias("duplicates_removed"),
        "rows_kept",
    )


def profile(trips: DataFrame) -> DataFrame:
    """Rows, rows without a pickup time and their rate, per feed before filtering."""
    return trips.groupBy("vehicle_type").agg(*_profile_columns())


def _profile_columns() -> list[Column]:
    missing = F.count_if(F.col("pickup_ts").isNull())
    n = F.count(F.lit(1))
    return [
        n.alias("rows_read"),
        missing.alias("null_pickup"),
        rounded(missing / F.greatest(n, F.lit(1)), 4).alias("null_rate"),
    ]


def rejects(trips: DataFrame, bounds: QualityBounds) -> DataFrame:
    """The profile and the rejected rows per feed; no key is exchanged for it."""
    invalid = F.count_if(~quality_predicate(bounds))
    return trips.groupBy("vehicle_type").agg(*_profile_columns(), invalid.alias("invalid_records"))


def report_of(rejected: DataFrame, kept: DataFrame) -> DataFrame:
    """Quality report from the rejects of the input and the trips that were written.

    What was neither rejected nor written was a duplicate, so a written table
    saves counting keys. Both sides are one row per feed.
    """
    written = kept.groupBy("vehicle_type").agg(F.count(F.lit(1)).alias("rows_kept"))
    rows_kept = F.coalesce("rows_kept", F.lit(0))
    return rejected.join(written, "vehicle_type", "left").select(
        "vehicle_type",
        "rows_read",
        "null_rate",
        "invalid_records",
        (F.col("rows_read") - F.col("invalid_records") - rows_kept).alias("duplicates_removed"),
        rows_kept.alias("rows_kept"),
    )


def quality_counts(
    trips: DataFrame, bounds: QualityBounds, keys: Sequence[str] = TRIP_IDENTITY
) -> DataFrame:
    """Per feed: rows read, null-pickup rate, rows rejected, duplicates dropped, rows kept.

    Rows are first counted per key, with all rejected rows of a feed under one
    empty key; both counts combine on the map side, so no key travels with more
    than one row per input partition.
    """
    valid = quality_predicate(bounds)
    inner = [k for k in keys if k != "vehicle_type"]
    marked = trips.select(
        "vehicle_type",
        valid.alias("_valid"),
        F.col("pickup_ts").isNull().cast("bigint").alias("_no_pickup"),
        *[F.when(valid, F.col(k)).alias(f"_key{i}") for i, k in enumerate(inner)],
    )
    per_key = marked.groupBy(
        "vehicle_type", "_valid", *[f"_key{i}" for i in range(len(inner))]
    ).agg(F.count(F.lit(1)).alias("_n"), F.sum("_no_pickup").alias("_no_pickup"))
    kept = F.count_if("_valid")
    total = F.sum("_n")
    rejected = F.sum(F.when(~F.col("_valid"), F.col("_n")).otherwise(0))
    return per_key.groupBy("vehicle_type").agg(
        total.alias("rows_read"),
        rounded(F.sum("_no_pickup") / F.greatest(total, F.lit(1)), 4).alias("null_rate"),
        rejected.alias("invalid_records"),
        (total - rejected - kept).alias("duplicates_removed"),
        kept.alias("rows_kept"),
    )
