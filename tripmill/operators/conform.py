"""Give feeds of different shapes one shape."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.specs import TRIP_COLUMNS, FeedSpec


def columns_by_role(df: DataFrame) -> dict[str, str]:
    """Lower-case name to actual name; two names differing in case only are an error."""
    found: dict[str, str] = {}
    for name in df.columns:
        if name.lower() in found:
            raise ValueError(f"columns {found[name.lower()]!r} and {name!r} differ in case only")
        found[name.lower()] = name
    return found


def feed_label(column: Column, spec: FeedSpec) -> Column:
    """The feed a row belongs to: its label, or the name of the spec if it has none."""
    return F.coalesce(column, F.lit(spec.name))


def conform(raw: DataFrame, spec: FeedSpec, derive_duration: bool = False) -> DataFrame:
    """One select that maps the raw columns of a feed to the trip columns.

    A column the feed lacks becomes a null of the right type; a value that does
    not fit its type becomes null. ``derive_duration`` fills a missing duration
    from the two timestamps (off by default: only a reported duration counts).
    """
    actual = columns_by_role(raw)
    types = dict(raw.dtypes)

    def present(name: str | None) -> bool:
        return name is not None and name.lower() in actual

    def typed(name: str | None, kind: str) -> Column:
        if not present(name):
            return F.lit(None).cast(kind)
        column = actual[name.lower()]
        value = F.col(f"`{column}`")
        return value if types[column] == kind else value.try_cast(kind)

    required = (spec.pickup, spec.dropoff, spec.pickup_zone, spec.dropoff_zone, spec.feed_column)
    missing = [name for name in required if name is not None and not present(name)]
    if missing:
        raise ValueError(f"feed {spec.name!r} lacks {missing}")

    fares = [typed(name, "double") for name in spec.fares if present(name)]
    total = next((name for name in spec.totals if present(name)), None)
    duration = typed(spec.duration, "int")
    pickup, dropoff = typed(spec.pickup, "timestamp_ntz"), typed(spec.dropoff, "timestamp_ntz")
    if derive_duration:
        elapsed = F.timestamp_diff("SECOND", pickup, dropoff).try_cast("int")
        duration = F.coalesce(duration, elapsed)

    values = {
        "vehicle_type": feed_label(typed(spec.feed_column, "string"), spec),
        "pickup_ts": pickup,
        "dropoff_ts": dropoff,
        "pu_location_id": typed(spec.pickup_zone, "int"),
        "do_location_id": typed(spec.dropoff_zone, "int"),
        "trip_distance": typed(spec.distance, "double"),
        "fare_amount": F.coalesce(*fares) if fares else typed(None, "double"),
        "total_amount": typed(total, "double"),
        "payment_type": typed(spec.payment, "int"),
        "passenger_count": typed(spec.passengers, "double"),
        "trip_duration_sec": duration,
        "shared_match_flag": typed(spec.shared_flag, "string"),
        "year_month": typed("year_month", "string"),
        "ingestion_ts": typed("_ingestion_ts", "timestamp_ntz"),
        "source_file": typed("_source_file", "string"),
    }
    carried = [F.col(f"`{actual[name.lower()]}`").alias(name) for name in spec.carry]
    return raw.select(*[values[name].alias(name) for name in TRIP_COLUMNS], *carried)


def union_feeds(feeds: Iterable[DataFrame]) -> DataFrame:
    """All feeds by column name; a column some feed lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)


def only_feeds(trips: DataFrame, feeds: Iterable[str] | None) -> DataFrame:
    """Trips of the given feeds (a partition filter on layered tables); None keeps all."""
    return trips if feeds is None else trips.filter(F.col("vehicle_type").isin(*feeds))


def add_time_parts(trips: DataFrame, ts: str = "pickup_ts") -> DataFrame:
    """Hour, day of week (Sunday is 1) and date of the wall-clock pickup time."""
    return trips.withColumns(
        {
            "pickup_hour": F.hour(ts),
            "pickup_dow": F.dayofweek(ts),
            "trip_date": F.to_date(F.col(ts)),
        }
    )
