"""What dashboards read: snapshots by lookup key, capped where the caller asks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tripmill.functions.ordering import total_order
from tripmill.operators.topn import top_n

# Lookup keys of each served table (a leading minus is descending).
KPI_KEYS: dict[str, tuple[str, ...]] = {
    "trips_by_zone_hour": ("pu_location_id", "pickup_hour"),
    "trips_by_zone_day": ("pu_location_id", "pickup_dow"),
    "avg_fare_by_feed": ("vehicle_type",),
    "avg_fare_by_hour": ("vehicle_type", "pickup_hour"),
    "avg_distance": ("vehicle_type", "pu_location_id"),
    "monthly_trend": ("vehicle_type", "year_month"),
    "top_pickup": ("-trip_count",),
    "top_dropoff": ("-trip_count",),
    "payment_distribution": ("vehicle_type", "payment_type"),
    "avg_duration": ("vehicle_type",),
    "shared_rate": ("vehicle_type",),
    "weather_daily": ("date",),
}
LAKE_KEYS: dict[str, tuple[str, ...]] = {
    "top_routes": ("-trip_count",),
    "zone_heatmap": ("pu_location_id", "pickup_hour"),
    "anomaly_trips": ("vehicle_type", "anomaly_reason"),
    "incident_correlation": ("borough", "crash_month"),
    "duration_model": ("model",),
    "schema_drift": ("feed", "column_name"),
}
#: The cap that dashboards use.
SERVED_ROWS = 500


def capped(df: DataFrame, order: Sequence[str], n: int | None = None) -> DataFrame:
    """The first ``n`` rows by lookup key, ties broken by all other columns; None keeps all."""
    return df if n is None else top_n(df, total_order(df, order), n)
