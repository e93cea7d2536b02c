"""Zone names on trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def unique_zones(zones: DataFrame) -> DataFrame:
    """One row per readable ``LocationID``: the first in the order of borough and zone.

    A zone listed twice would otherwise multiply the trips of its place.
    """
    known = zones.select(
        F.col("LocationID").try_cast("int").alias("LocationID"), "Borough", "Zone"
    ).filter(F.col("LocationID").isNotNull())
    rank = Window.partitionBy("LocationID").orderBy(
        F.col("Borough").asc_nulls_last(), F.col("Zone").asc_nulls_last()
    )
    return known.withColumn("_rank", F.row_number().over(rank)).filter("_rank = 1").drop("_rank")


def add_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Borough and zone name of pickup and dropoff; unknown zones give null.

    Trips stay as many as they are, however often a zone is listed. No broadcast hint: Spark compares
    the size of the dimension with its broadcast threshold, and past it sorts
    and merges with hot zones split by adaptive execution.
    """
    zones = unique_zones(zones)
    for side in ("pu", "do"):
        named = zones.select(
            F.col("LocationID").alias(f"{side}_location_id"),
            F.col("Borough").alias(f"{side}_borough"),
            F.col("Zone").alias(f"{side}_zone_name"),
        )
        columns = [*trips.columns, f"{side}_borough", f"{side}_zone_name"]
        trips = trips.join(named, f"{side}_location_id", "left").select(*columns)
    return trips
