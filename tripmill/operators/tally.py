"""Counts and totals that can be added up again: the shared base of KPIs and flows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.numbers import exact, mean_of
from tripmill.functions.ordering import by
from tripmill.operators.topn import top_n

# Measure name -> trip column.
MEASURES: dict[str, str] = {
    "fare": "fare_amount",
    "total": "total_amount",
    "distance": "trip_distance",
    "duration": "trip_duration_sec",
}

PU: tuple[str, ...] = ("pu_location_id", "pu_borough", "pu_zone_name")
DO: tuple[str, ...] = ("do_location_id", "do_borough", "do_zone_name")

# Everything the pickup-side KPIs group by. Day of week follows from the date.
ROLLUP_KEYS: tuple[str, ...] = (
    "vehicle_type",
    "year_month",
    "trip_date",
    *PU,
    "pickup_hour",
)

# What the remaining KPIs group by. Apart from the first, because the keys of both
# together would make nearly one group per trip.
SIDE_KEYS: tuple[str, ...] = (
    "vehicle_type",
    "payment_type",
    "shared_match_flag",
    *DO,
)

TALLY_COLUMNS: tuple[str, ...] = (
    "trip_count",
    *[f"{m}_{part}" for m in MEASURES for part in ("sum", "n")],
)


def tally(trips: DataFrame) -> DataFrame:
    """Each trip as a tally of one. Unused measures are pruned away.

    Fractions are summed as exact decimals, whole numbers as BIGINT. A value that does not
    fit counts as unknown: it is in ``trip_count`` but not in its measure's ``n``.
    """
    columns: dict[str, Column] = {"trip_count": F.lit(1).cast("bigint")}
    types = dict(trips.dtypes)
    for measure, column in MEASURES.items():
        fraction = types[column] in ("double", "float")
        units = exact(F.col(column)) if fraction else F.col(column).cast("bigint")
        columns[f"{measure}_sum"] = units
        columns[f"{measure}_n"] = F.when(units.isNull(), 0).otherwise(1).cast("bigint")
    return trips.withColumns(columns)


def rollup(trips: DataFrame) -> DataFrame:
    """Trips added up to the grain every pickup-side KPI can be read from."""
    return tally(trips).groupBy(*ROLLUP_KEYS).agg(
        *[F.try_sum(name).alias(name) for name in TALLY_COLUMNS]
    )


def side_rollup(trips: DataFrame) -> DataFrame:
    """Trips counted per dropoff zone, payment type and share flag."""
    return group_total(tally(trips), SIDE_KEYS, "trip_count")


def from_rollup(rolled: DataFrame) -> DataFrame:
    """A rollup read back, with the day of week restored."""
    return rolled.withColumn("pickup_dow", F.dayofweek("trip_date"))


@dataclass(frozen=True)
class Summary:
    """Group keys, means to take, and how the result is ordered or cut.

    ``present`` names a measure that must be known: rows without it are neither
    counted nor kept as groups; ``known`` does the same for a key. A leading minus
    in ``order`` means descending.
    """

    keys: tuple[str, ...]
    means: Mapping[str, str] = field(default_factory=dict)
    present: str | None = None
    order: tuple[str, ...] = ()
    top: int | None = None
    known: str | None = None


def summarise(tallied: DataFrame, spec: Summary) -> DataFrame:
    """Group a tally or a rollup; both give the same digits."""
    if spec.known:
        tallied = tallied.filter(F.col(spec.known).isNotNull())
    counted = f"{spec.present}_n" if spec.present else "trip_count"
    if spec.present:
        tallied = tallied.filter(F.col(counted) > 0)
    means = [
        mean_of(F.try_sum(f"{m}_sum"), F.sum(f"{m}_n")).alias(name)
        for name, m in spec.means.items()
    ]
    grouped = tallied.groupBy(*spec.keys).agg(F.sum(counted).alias("trip_count"), *means)
    if spec.top is not None:
        return top_n(grouped, by(*spec.order), spec.top)
    return grouped.orderBy(*by(*spec.order)) if spec.order else grouped


def group_total(tallied: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Trips per key under the given column name."""
    return tallied.groupBy(*keys).agg(F.sum("trip_count").alias(name))
