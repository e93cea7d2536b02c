"""The four declared feeds (fixed values: raw column names, types and roles)."""

from __future__ import annotations

from tripmill.specs import FeedSpec

YELLOW = FeedSpec(
    name="yellow",
    pickup="tpep_pickup_datetime",
    dropoff="tpep_dropoff_datetime",
    pickup_zone="PULocationID",
    dropoff_zone="DOLocationID",
    distance="trip_distance",
    contract="""
        VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz,
        passenger_count double, trip_distance double, RatecodeID double,
        store_and_fwd_flag string, PULocationID int, DOLocationID int, payment_type int,
        fare_amount double, extra double, mta_tax double, tip_amount double,
        tolls_amount double, improvement_surcharge double, total_amount double,
        congestion_surcharge double, airport_fee double, cbd_congestion_fee double
    """,
)

GREEN = FeedSpec(
    name="green",
    pickup="lpep_pickup_datetime",
    dropoff="lpep_dropoff_datetime",
    pickup_zone="PULocationID",
    dropoff_zone="DOLocationID",
    distance="trip_distance",
    contract="""
        VendorID int, lpep_pickup_datetime timestamp_ntz, lpep_dropoff_datetime timestamp_ntz,
        store_and_fwd_flag string, RatecodeID double, PULocationID int, DOLocationID int,
        passenger_count double, trip_distance double, fare_amount double, extra double,
        mta_tax double, tip_amount double, tolls_amount double,
        improvement_surcharge double, total_amount double, payment_type int, trip_type int,
        congestion_surcharge double, cbd_congestion_fee double
    """,
)

FHV = FeedSpec(
    name="fhv",
    pickup="pickup_datetime",
    dropoff="dropOff_datetime",
    pickup_zone="PUlocationID",
    dropoff_zone="DOlocationID",
    contract="""
        dispatching_base_num string, pickup_datetime timestamp_ntz,
        dropOff_datetime timestamp_ntz, PUlocationID int, DOlocationID int,
        SR_Flag string, Affiliated_base_number string
    """,
)

FHVHV = FeedSpec(
    name="fhvhv",
    pickup="pickup_datetime",
    dropoff="dropoff_datetime",
    pickup_zone="PULocationID",
    dropoff_zone="DOLocationID",
    distance="trip_miles",
    contract="""
        hvfhs_license_num string, dispatching_base_num string, originating_base_num string,
        request_datetime timestamp_ntz, on_scene_datetime timestamp_ntz,
        pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz,
        PULocationID int, DOLocationID int, trip_miles double, trip_time int,
        base_passenger_fare double, tolls double, bcf double, sales_tax double,
        congestion_surcharge double, airport_fee double, tips double, driver_pay double,
        shared_request_flag string, shared_match_flag string, access_a_ride_flag string,
        wav_request_flag string, wav_match_flag string, cbd_congestion_fee double
    """,
)

FEEDS: tuple[FeedSpec, ...] = (YELLOW, GREEN, FHV, FHVHV)
