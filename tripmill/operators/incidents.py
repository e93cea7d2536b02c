"""Incidents next to trips by area and month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.operators.tally import group_total


def incidents_by_area_month(incidents: DataFrame) -> DataFrame:
    """Incidents per borough and month; records without a borough are left out."""
    return (
        incidents.filter(F.col("borough").isNotNull())
        .groupBy("borough", "crash_month")
        .agg(F.count(F.lit(1)).alias("collision_count"))
    )


def trips_by_area_month(tallied: DataFrame) -> DataFrame:
    """Trips per upper-case pickup borough and month, from a tally or the rollup."""
    known = tallied.filter(F.col("pu_borough").isNotNull())
    named = known.withColumns(
        {"borough": F.upper("pu_borough"), "crash_month": F.col("year_month")}
    )
    return group_total(named, ("borough", "crash_month"), "taxi_trip_count")


def incident_trip_join(incidents: DataFrame, tallied: DataFrame) -> DataFrame:
    """Both counts where an area and month has both. Each side is added up before joining."""
    return incidents_by_area_month(incidents).join(
        trips_by_area_month(tallied), ["borough", "crash_month"]
    )
