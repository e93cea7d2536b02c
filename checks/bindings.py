"""Test tables in the roles of feeds, zones, weather, incidents and step records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.functions.numbers import fixed_point
from tripmill.functions.periods import month_of
from tripmill.operators.conform import add_time_parts, conform, union_feeds
from tripmill.operators.quality import apply_quality, keep_latest
from tripmill.operators.zones import add_zones
from tripmill.specs import FeedSpec, QualityBounds

FREIGHT_FEEDS = ("freight_A", "freight_N", "freight_R")
APP_FEEDS = ("app_click", "app_error", "app_purchase", "app_signup", "app_view")
ALL_FEEDS = FREIGHT_FEEDS + APP_FEEDS

FREIGHT = FeedSpec(
    name="freight",
    pickup="o_orderdate",
    dropoff="l_shipdate",
    pickup_zone="from_zone",
    dropoff_zone="to_zone",
    distance="l_quantity",
    fares=("l_extendedprice",),
    totals=("charge",),
    payment="l_linenumber",
    feed_column="feed",
    labels=FREIGHT_FEEDS,
    carry=("l_orderkey", "l_linenumber"),
    identity=("vehicle_type", "l_orderkey", "l_linenumber"),
)

APP = FeedSpec(
    name="app",
    pickup="ts",
    dropoff="ended",
    pickup_zone="from_zone",
    dropoff_zone="to_zone",
    fares=("fare_amount", "base_passenger_fare"),
    feed_column="feed",
    labels=APP_FEEDS,
    carry=("event_id",),
    identity=("vehicle_type", "event_id"),
)

FREIGHT_BOUNDS = QualityBounds(max_zone=24, max_fare=100_000.0)
APP_BOUNDS = QualityBounds(max_zone=24)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def freight_raw(spark: SparkSession, sf: str) -> DataFrame:
    items, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    customers, suppliers = table(spark, sf, "customer"), table(spark, sf, "supplier")
    # Customers meet the orders, not the several times as many items.
    placed = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return (
        items.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.concat(F.lit("freight_"), "l_returnflag").alias("feed"),
            "o_orderdate",
            "l_shipdate",
            (F.col("c_nationkey") + 1).alias("from_zone"),
            (F.col("s_nationkey") + 1).alias("to_zone"),
            "l_quantity",
            "l_extendedprice",
            (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias(
                "charge"
            ),
            "l_orderkey",
            "l_linenumber",
            month_of(F.col("o_orderdate")).alias("year_month"),
            F.col("l_shipdate").alias("_ingestion_ts"),
            F.lit("lineitem").alias("_source_file"),
        )
    )


def app_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Events without distance, payment and total; the value is the base fare."""
    return table(spark, sf, "events").select(
        F.concat(F.lit("app_"), "event_type").alias("feed"),
        "ts",
        F.lit(None).cast("timestamp_ntz").alias("ended"),
        (F.col("user_id") % 25 + 1).alias("from_zone"),
        (F.col("event_id") % 25 + 1).alias("to_zone"),
        F.col("value").alias("base_passenger_fare"),
        F.floor(F.col("value") * 60).cast("int").alias("trip_time"),
        F.when(F.col("event_id") % 3 == 0, "Y").otherwise("N").alias("shared_match_flag"),
        "event_id",
        month_of(F.col("ts")).alias("year_month"),
        F.col("ts").alias("_ingestion_ts"),
        F.lit("events").alias("_source_file"),
    )


def zones(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        (F.col("n_nationkey") + 1).alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
    )


def freight(spark: SparkSession, sf: str) -> DataFrame:
    valid = apply_quality(conform(freight_raw(spark, sf), FREIGHT), FREIGHT_BOUNDS)
    return keep_latest(valid, FREIGHT.identity, drop=FREIGHT.carry)


def app(spark: SparkSession, sf: str) -> DataFrame:
    valid = apply_quality(conform(app_raw(spark, sf), APP), APP_BOUNDS)
    return keep_latest(valid, APP.identity, drop=APP.carry)


def silver(spark: SparkSession, sf: str) -> DataFrame:
    """Both feed families conformed, filtered, deduplicated and enriched."""
    trips = union_feeds([freight(spark, sf), app(spark, sf)])
    return add_time_parts(add_zones(trips, zones(spark, sf)))


def weather(spark: SparkSession, sf: str) -> DataFrame:
    """Orders by day in the role of daily weather."""
    return (
        table(spark, sf, "orders")
        .groupBy(F.to_date("o_orderdate").alias("date"))
        .agg(
            F.max("o_totalprice").alias("temp_max"),
            F.min("o_totalprice").alias("temp_min"),
            (F.sum(fixed_point(F.col("o_totalprice"), 2)) / F.lit(100.0)).alias(
                "precipitation_sum"
            ),
            F.count(F.lit(1)).cast("int").alias("weather_code"),
        )
    )


def incidents_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Urgent orders as incident records: areas in untidy case and spacing, some times unreadable."""
    orders, customers = table(spark, sf, "orders"), table(spark, sf, "customer")
    places = zones(spark, sf).select(F.col("LocationID"), F.lower("Borough").alias("area"))
    return (
        orders.filter(F.col("o_orderpriority") == "1-URGENT")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(places, F.col("c_nationkey") + 1 == F.col("LocationID"))
        .select(
            F.concat(F.lit(" "), "area", F.lit(" ")).alias("borough"),
            F.when(F.col("o_totalprice") < 5000, "n/a")
            .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS"))
            .alias("crash_date"),
            F.substring("o_orderstatus", 1, 1).alias("number_of_persons_injured"),
            F.col("o_orderkey").cast("string").alias("collision_id"),
        )
    )


def steps(spark: SparkSession, sf: str) -> DataFrame:
    """Events in the role of step records."""
    return table(spark, sf, "events").select(
        F.col("event_type").alias("layer"),
        F.concat(F.lit("op_"), (F.col("user_id") % 10).cast("string")).alias("operation"),
        F.when(F.col("event_id") % 7 == 0, "error").otherwise("success").alias("status"),
        F.col("user_id").alias("rows_read"),
        (F.col("event_id") % 5).alias("rows_written"),
        F.col("value").alias("duration_ms"),
        ((F.col("event_id") % 4) / F.lit(4.0)).alias("null_rate"),
        (F.col("event_id") % 3).alias("duplicates_removed"),
        (F.col("user_id") % 2).alias("invalid_records"),
        F.create_map(F.lit("props"), F.col("props")).alias("extra"),
        F.col("ts").alias("timestamp"),
        F.col("event_id").alias("sequence"),
    )
