"""Conform, quality, deduplication, zones and time parts on small cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripmill.feeds import FEEDS, FHV, FHVHV, GREEN, YELLOW
from tripmill.operators.conform import add_time_parts, conform, only_feeds, union_feeds
from tripmill.operators.quality import (
    apply_quality,
    judge,
    keep_latest,
    profile,
    quality_counts,
)
from tripmill.operators.zones import add_zones
from tripmill.specs import TRIP_COLUMNS, TRIP_IDENTITY, QualityBounds

T = dt.datetime(2025, 4, 1, 8, 30)
TRIP_SCHEMA = ", ".join(f"{n} {t}" for n, t in TRIP_COLUMNS.items())


def trip(**values):
    base = dict.fromkeys(TRIP_COLUMNS)
    base |= dict(
        vehicle_type="yellow",
        pickup_ts=T,
        dropoff_ts=T + dt.timedelta(minutes=9),
        pu_location_id=10,
        do_location_id=20,
        trip_distance=1.5,
        fare_amount=12.5,
        year_month="2025-04",
        ingestion_ts=T,
        source_file="f",
    )
    return tuple((base | values).values())


def trips(spark, *rows):
    return spark.createDataFrame(list(rows), TRIP_SCHEMA)


def empty(spark, spec, lineage=True):
    tail = ", _ingestion_ts timestamp_ntz, _source_file string, year_month string"
    return spark.createDataFrame([], spec.contract + (tail if lineage else ""))


@pytest.mark.parametrize("spec", FEEDS, ids=lambda s: s.name)
def test_every_feed_conforms_to_the_trip_columns(spark, spec):
    assert conform(empty(spark, spec), spec).dtypes == list(TRIP_COLUMNS.items())


def test_missing_columns_become_typed_nulls(spark):
    raw = spark.createDataFrame(
        [("B1", T, T, 3, 4)],
        "dispatching_base_num string, pickup_datetime timestamp_ntz, "
        "dropoff_datetime timestamp_ntz, PULocationID int, DOLocationID int",
    )
    row = conform(raw, FHV).first()  # spelled differently from the declared names
    assert (row.vehicle_type, row.pu_location_id, row.do_location_id) == ("fhv", 3, 4)
    assert row.fare_amount is row.total_amount is row.trip_distance is row.payment_type is None


def test_base_fare_stands_in_for_fare_and_total(spark):
    raw = empty(spark, FHVHV).unionByName(
        spark.createDataFrame([(T, 7.25, 600, "Y")], "pickup_datetime timestamp_ntz, "
                              "base_passenger_fare double, trip_time int, shared_match_flag string"),
        allowMissingColumns=True,
    )
    row = conform(raw, FHVHV).first()
    assert (row.fare_amount, row.total_amount, row.trip_duration_sec) == (7.25, 7.25, 600)
    assert row.shared_match_flag == "Y"


def test_total_is_chosen_by_column_not_by_row(spark):
    raw = spark.createDataFrame(
        [(T, T, 1, 2, None, 5.0, None)],
        "lpep_pickup_datetime timestamp_ntz, lpep_dropoff_datetime timestamp_ntz, "
        "PULocationID int, DOLocationID int, fare_amount double, base_passenger_fare double, "
        "total_amount double",
    )
    row = conform(raw, GREEN).first()
    assert row.fare_amount == 5.0 and row.total_amount is None


def test_values_that_do_not_fit_become_null(spark):
    raw = spark.createDataFrame(
        [("2025-04-01 08:30:00", "soon", "12", "x", 2**40)],
        "tpep_pickup_datetime string, tpep_dropoff_datetime string, PULocationID string, "
        "DOLocationID string, payment_type bigint",
    )
    row = conform(raw, YELLOW).first()
    assert row.pickup_ts == T and row.dropoff_ts is None
    assert row.pu_location_id == 12 and row.do_location_id is None and row.payment_type is None


def test_columns_differing_in_case_only_are_an_error(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        raw = spark.createDataFrame([(1, 2)], "PULocationID int, PUlocationID int")
        with pytest.raises(ValueError, match="case only"):
            conform(raw, FHV)
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_missing_required_column_is_an_error(spark):
    with pytest.raises(ValueError, match="lacks"):
        conform(spark.createDataFrame([(1,)], "PULocationID int"), YELLOW)


def test_duration_is_derived_only_on_request(spark):
    raw = empty(spark, GREEN).unionByName(
        spark.createDataFrame(
            [(T, T + dt.timedelta(seconds=95))],
            "lpep_pickup_datetime timestamp_ntz, lpep_dropoff_datetime timestamp_ntz",
        ),
        allowMissingColumns=True,
    )
    assert conform(raw, GREEN).first().trip_duration_sec is None
    assert conform(raw, GREEN, derive_duration=True).first().trip_duration_sec == 95


def test_wall_clock_time_does_not_depend_on_the_session_zone(spark):
    gap = dt.datetime(2025, 3, 9, 2, 30)  # skipped by the clocks of New York
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = add_time_parts(trips(spark, trip(pickup_ts=gap))).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (row.pickup_hour, row.pickup_dow, row.trip_date) == (2, 1, dt.date(2025, 3, 9))


def test_quality_bounds_are_inclusive_and_null_fares_stay(spark):
    good = [
        trip(pu_location_id=1, do_location_id=265, fare_amount=0.0),
        trip(pu_location_id=265, do_location_id=1, fare_amount=500.0),
        trip(fare_amount=None),
        trip(dropoff_ts=None),
    ]
    bad = [
        trip(pickup_ts=None),
        trip(pu_location_id=None),
        trip(do_location_id=None),
        trip(pu_location_id=0),
        trip(do_location_id=266),
        trip(fare_amount=-0.01),
        trip(fare_amount=500.01),
        trip(fare_amount=float("nan")),
    ]
    assert apply_quality(trips(spark, *good, *bad), QualityBounds()).count() == len(good)


def test_keep_latest_prefers_the_newest_and_treats_nulls_as_equal(spark):
    later = T + dt.timedelta(days=1)
    kept = keep_latest(
        trips(
            spark,
            trip(dropoff_ts=None, fare_amount=None, source_file="old"),
            trip(dropoff_ts=None, fare_amount=None, ingestion_ts=later, source_file="new"),
            trip(source_file="other"),
        )
    )
    assert sorted(r.source_file for r in kept.collect()) == ["new", "other"]


def test_keep_latest_breaks_ties_the_same_way_in_any_order(spark):
    rows = [trip(total_amount=float(i % 50), source_file=f"f{i % 7}") for i in range(400)]
    found = {
        tuple(keep_latest(trips(spark, *order).repartition(n)).first())
        for order in (rows, rows[::-1])
        for n in (1, 6)
    }
    assert len(found) == 1


def test_keep_latest_with_a_third_of_rows_in_one_key(spark):
    same = [trip(ingestion_ts=T + dt.timedelta(seconds=i)) for i in range(1_000)]
    rest = [trip(pickup_ts=T + dt.timedelta(minutes=i + 1)) for i in range(2_000)]
    kept = keep_latest(trips(spark, *same, *rest).repartition(8))
    assert kept.count() == 2_001
    assert kept.agg(F.max("ingestion_ts").alias("m")).first().m == T + dt.timedelta(seconds=999)


def test_profile_and_counts(spark):
    df = trips(
        spark,
        trip(),
        trip(ingestion_ts=T + dt.timedelta(days=1)),
        trip(pickup_ts=None),
        trip(fare_amount=900.0),
        trip(fare_amount=900.0),
        trip(vehicle_type="fhv", pickup_ts=None),
    )
    rows = {r.vehicle_type: r for r in profile(df).collect()}
    assert (rows["yellow"].rows_read, rows["yellow"].null_pickup) == (5, 1)
    assert rows["yellow"].null_rate == 0.2 and rows["fhv"].null_rate == 1.0
    counts = {r.vehicle_type: r.asDict() for r in quality_counts(df, QualityBounds()).collect()}
    assert counts["yellow"] == dict(
        vehicle_type="yellow",
        rows_read=5,
        null_rate=0.2,
        invalid_records=3,
        duplicates_removed=1,
        rows_kept=1,
    )
    assert counts["fhv"]["rows_kept"] == 0 and counts["fhv"]["duplicates_removed"] == 0


def test_counts_agree_with_the_filter_and_dedup(spark):
    rows = [
        trip(
            pu_location_id=i % 5,
            do_location_id=None if i % 11 == 0 else 3,
            fare_amount=None if i % 3 == 0 else float(i % 4),
            vehicle_type="yellow" if i % 2 else "green",
        )
        for i in range(600)
    ]
    df, bounds = trips(spark, *rows), QualityBounds(max_zone=3)
    kept = keep_latest(apply_quality(df, bounds))
    expected = {r.vehicle_type: r["count"] for r in kept.groupBy("vehicle_type").count().collect()}
    found = quality_counts(df, bounds, TRIP_IDENTITY).collect()
    assert {r.vehicle_type: r.rows_kept for r in found} == expected
    for r in found:
        assert r.rows_read == r.rows_kept + r.invalid_records + r.duplicates_removed


def test_unknown_zones_are_null(spark):
    zones = spark.createDataFrame(
        [(10, "Queens", "Astoria"), (11, "Bronx", "Belmont")],
        "LocationID int, Borough string, Zone string",
    )
    row = add_zones(trips(spark, trip(do_location_id=99)), zones).first()
    assert (row.pu_borough, row.pu_zone_name) == ("Queens", "Astoria")
    assert row.do_borough is None and row.do_zone_name is None


def test_union_and_subset(spark):
    a = trips(spark, trip())
    b = trips(spark, trip(vehicle_type="fhv")).drop("trip_distance")
    both = union_feeds([a, b])
    assert only_feeds(both, None).count() == 2
    row = only_feeds(both, ("fhv",)).first()
    assert row.vehicle_type == "fhv" and row.trip_distance is None


def test_judged_rows_are_the_kept_and_every_rejected_one(spark):
    """Rejected rows of one key all stay, valid ones once; a third of all rows has one key."""
    same = [trip(ingestion_ts=T + dt.timedelta(hours=i)) for i in range(30)]
    bad = [trip(pu_location_id=400)] * 20 + [trip(pickup_ts=None)] * 5 + [trip(fare_amount=-1.0)]
    other = [trip(source_file="g", pickup_ts=T + dt.timedelta(days=i)) for i in range(1, 9)]
    df = trips(spark, *same, *bad, *other).repartition(5)
    judged = judge(df, QualityBounds())
    assert judged.columns == [*df.columns, "verdict"]
    kept = judged.filter("verdict = 'kept'").drop("verdict")
    want = keep_latest(apply_quality(df, QualityBounds()))
    assert sorted(map(str, kept.collect())) == sorted(map(str, want.collect()))
    assert judged.filter("verdict = 'rejected'").count() == len(bad)
    assert "WindowGroupLimit" in judged._jdf.queryExecution().executedPlan().toString()
    assert judge(df.limit(0), QualityBounds()).count() == 0
