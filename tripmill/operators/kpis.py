"""The KPI catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.operators.tally import DO, PU, Summary, from_rollup, group_total, summarise, tally

# Readable from the rollup: their keys are pickup-side and time columns.
ROLLED: dict[str, Summary] = {
    "trips_by_zone_hour": Summary(
        keys=(*PU, "pickup_hour"), order=("-trip_count", *PU, "pickup_hour")
    ),
    "trips_by_zone_day": Summary(
        keys=(*PU, "pickup_dow"), order=("-trip_count", *PU, "pickup_dow")
    ),
    "avg_fare_by_feed": Summary(
        keys=("vehicle_type",), means={"avg_fare": "fare", "avg_total": "total"}
    ),
    "avg_fare_by_hour": Summary(
        keys=("vehicle_type", "pickup_hour"),
        means={"avg_fare": "fare"},
        order=("vehicle_type", "pickup_hour"),
    ),
    "avg_distance": Summary(
        keys=("vehicle_type", "pu_location_id", "pu_zone_name"),
        means={"avg_distance": "distance"},
        present="distance",
    ),
    "monthly_trend": Summary(
        keys=("vehicle_type", "year_month"),
        means={"avg_fare": "fare"},
        order=("vehicle_type", "year_month"),
    ),
    "top_pickup": Summary(keys=PU, order=("-trip_count", *PU), top=10),
    "avg_duration": Summary(
        keys=("vehicle_type",), means={"avg_duration_sec": "duration"}, present="duration"
    ),
}

# Readable from the side rollup: dropoff zones and payment types.
SIDE: dict[str, Summary] = {
    "top_dropoff": Summary(keys=DO, order=("-trip_count", *DO), top=10),
    "payment_distribution": Summary(
        keys=("vehicle_type", "payment_type"),
        known="payment_type",
        order=("vehicle_type", "payment_type"),
    ),
}


def kpi(trips: DataFrame, name: str) -> DataFrame:
    """One KPI straight from the trips."""
    return summarise(tally(trips), ROLLED.get(name) or SIDE[name])


def shared_rate(tallied: DataFrame, feeds: tuple[str, ...]) -> DataFrame:
    """Trips, matched shared trips (flag ``Y``) and their share, for the given feeds."""
    count = F.col("trip_count")
    total = F.sum(count)
    shared = F.sum(F.when(F.col("shared_match_flag") == "Y", count).otherwise(0))
    return (
        tallied.filter(F.col("vehicle_type").isin(*feeds))
        .groupBy("vehicle_type")
        .agg(
            total.alias("total_trips"),
            shared.alias("shared_trips"),
            F.try_divide(shared, total).alias("shared_rate"),
        )
    )


def weather_daily(tallied: DataFrame, weather: DataFrame) -> DataFrame:
    """Trips per day next to that day's weather; days without weather drop out.

    Trips are added up per day before the join, so both sides are one row a day.
    """
    daily = group_total(tallied, ("trip_date",), "trips")
    days = daily.join(weather, daily["trip_date"] == weather["date"])
    keys = ("date", "temp_max", "temp_min", "precipitation_sum", "weather_code")
    return days.groupBy(*keys).agg(F.sum("trips").alias("trip_count")).orderBy("date")


def all_kpis(
    rolled: DataFrame, side: DataFrame, weather: DataFrame, shared_feeds: tuple[str, ...]
) -> dict[str, DataFrame]:
    """The whole catalogue from the two rollups: the trips are scanned twice, not per KPI."""
    base = from_rollup(rolled)
    tables = {name: summarise(base, spec) for name, spec in ROLLED.items()}
    tables |= {name: summarise(side, spec) for name, spec in SIDE.items()}
    tables["shared_rate"] = shared_rate(side, shared_feeds)
    tables["weather_daily"] = weather_daily(base, weather)
    return tables
