"""KPIs, flows, anomalies and top-n on small cases."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from test_silver import T, trip, trips
from tripmill.functions.ordering import by
from tripmill.operators.anomalies import attach_stats, cap_anomalies, group_stats, tag_anomalies
from tripmill.operators.conform import add_time_parts
from tripmill.operators.flows import od_flows, top_routes_of
from tripmill.operators.incidents import incident_trip_join
from tripmill.operators.kpis import ROLLED, SIDE, kpi, shared_rate, weather_daily
from tripmill.operators.tally import from_rollup, rollup, side_rollup, summarise, tally
from tripmill.operators.topn import cut_off, top_n


def enriched(spark, *rows):
    df = trips(spark, *rows)
    for side in ("pu", "do"):
        number = F.col(f"{side}_location_id")
        df = df.withColumns(
            {
                f"{side}_borough": F.concat(F.lit("B"), (number % 3).cast("string")),
                f"{side}_zone_name": F.concat(F.lit("Z"), number.cast("string")),
            }
        )
    return add_time_parts(df)


def many(spark, n=500, seed=3):
    rng = random.Random(seed)
    return enriched(
        spark,
        *[
            trip(
                vehicle_type=rng.choice(["yellow", "fhv", "fhvhv"]),
                pickup_ts=T + dt.timedelta(minutes=rng.randrange(60 * 24 * 40)),
                pu_location_id=rng.randrange(1, 9),
                do_location_id=rng.randrange(1, 9),
                fare_amount=rng.choice([None, round(rng.uniform(1, 90), 2)]),
                total_amount=round(rng.uniform(1, 90), 2),
                trip_distance=rng.choice([None, round(rng.uniform(0, 30), 2)]),
                trip_duration_sec=rng.choice([None, rng.randrange(3_000)]),
                payment_type=rng.choice([None, 1, 2]),
                shared_match_flag=rng.choice([None, "Y", "N"]),
            )
            for _ in range(n)
        ],
    )


@pytest.mark.parametrize("name", ROLLED)
def test_rollup_gives_the_same_kpi(spark, name):
    df = many(spark)
    direct = sorted(map(str, kpi(df, name).collect()))
    assert direct == sorted(map(str, summarise(from_rollup(rollup(df)), ROLLED[name]).collect()))


@pytest.mark.parametrize("name", SIDE)
def test_side_rollup_gives_the_same_kpi(spark, name):
    df = many(spark)
    side = summarise(side_rollup(df), SIDE[name])
    assert sorted(map(str, kpi(df, name).collect())) == sorted(map(str, side.collect()))


@pytest.mark.parametrize("name,mean", [("avg_fare_by_feed", "fare_amount"), ("avg_distance", "trip_distance")])
def test_means_skip_nulls(spark, name, mean):
    df = many(spark)
    spec = ROLLED[name]
    source = df.filter(F.col(mean).isNotNull()) if spec.present else df
    plain = source.groupBy(*spec.keys).agg(F.avg(mean).alias("m"), F.count(F.lit(1)).alias("n"))
    expected = {tuple(r[k] for k in spec.keys): (r.m, r.n) for r in plain.collect()}
    column = next(c for c, m in spec.means.items() if mean.split("_")[-1] in c or m in mean)
    for r in kpi(df, name).collect():
        m, n = expected.pop(tuple(r[k] for k in spec.keys))
        assert r[column] == pytest.approx(m, abs=1e-9) and r.trip_count == n
    assert not expected


def test_mean_of_a_group_without_values_is_null(spark):
    row = kpi(enriched(spark, trip(fare_amount=None)), "avg_fare_by_feed").first()
    assert row.avg_fare is None and row.trip_count == 1


def test_nan_is_an_unknown_value(spark):
    df = enriched(spark, trip(trip_distance=2.0), trip(trip_distance=float("nan")))
    row = kpi(df, "avg_distance").first()
    assert (row.avg_distance, row.trip_count) == (2.0, 1)


def test_shared_rate_counts_only_matched_flags(spark):
    df = enriched(
        spark, *[trip(vehicle_type="fhvhv", shared_match_flag=f) for f in ("Y", "N", None, "y")]
    )
    for counted in (tally(df), side_rollup(df)):
        row = shared_rate(counted, ("fhvhv",)).first()
        assert (row.total_trips, row.shared_trips, row.shared_rate) == (4, 1, 0.25)
        assert shared_rate(counted, ("yellow",)).count() == 0


def test_days_without_weather_drop_out(spark):
    df = enriched(spark, trip(), trip(pickup_ts=T + dt.timedelta(days=1)))
    weather = spark.createDataFrame(
        [(dt.date(2025, 4, 1), 20.0, 9.0, 0.5, 3)],
        "date date, temp_max double, temp_min double, precipitation_sum double, weather_code int",
    )
    rows = weather_daily(tally(df), weather).collect()
    assert [(r.date, r.trip_count) for r in rows] == [(dt.date(2025, 4, 1), 1)]


def test_a_route_may_appear_once_per_hour(spark):
    hours = [trip(pickup_ts=T + dt.timedelta(hours=h)) for h in (0, 0, 0, 1, 1, 2)]
    rows = top_routes_of(enriched(spark, *hours), 2).collect()
    assert [r.trip_count for r in rows] == [3, 2]
    assert len({(r.pu_zone_name, r.do_zone_name) for r in rows}) == 1


def test_flows_need_both_zones(spark):
    df = enriched(spark, trip(), trip(do_location_id=None))
    assert od_flows(df).count() == 1


def spread_fares(n=200):
    return [trip(fare_amount=10.0 + i % 3, trip_distance=1.0 + i % 2) for i in range(n)]


def test_inversion_and_equal_zones_only_tag_outliers(spark):
    early = T - dt.timedelta(hours=1)
    df = enriched(
        spark,
        *spread_fares(),
        trip(dropoff_ts=early, do_location_id=10),
        trip(fare_amount=400.0, dropoff_ts=early, do_location_id=10),
        trip(trip_distance=90.0, fare_amount=None),
    )
    rows = tag_anomalies(df, feeds=("yellow",)).collect()
    assert sorted(r.anomaly_reason for r in rows) == [
        "distance_outlier",
        "fare_outlier,time_inversion,same_zone",
    ]


def test_no_spread_means_no_anomaly(spark):
    assert tag_anomalies(enriched(spark, trip(fare_amount=400.0))).count() == 0
    same = [trip(fare_amount=400.0, trip_distance=2.0)] * 20
    assert tag_anomalies(enriched(spark, *same)).count() == 0


def test_listed_feeds_leave_others_out(spark):
    df = enriched(spark, *spread_fares(), trip(fare_amount=400.0), trip(vehicle_type="green"))
    assert tag_anomalies(df, feeds=("green",)).count() == 0
    assert tag_anomalies(df, feeds=("green", "yellow")).count() == 1


def test_a_long_list_of_feeds_leaves_out_the_same_rows(spark):
    df = many(spark).repartition(9)
    stats = group_stats(df)
    short = attach_stats(df, stats, ("yellow", "fhv"))
    long = attach_stats(df, stats, ("yellow", "fhv", *[f"feed{i}" for i in range(10_000)]))
    assert sorted(map(str, short.collect())) == sorted(map(str, long.collect()))
    assert {r.vehicle_type for r in short.select("vehicle_type").distinct().collect()} == {
        "yellow",
        "fhv",
    }
    every = attach_stats(df, stats, ("yellow", "fhv", "fhvhv"))
    assert attach_stats(df, stats).count() == every.count() == df.count()


def test_corrupt_amounts_stop_nothing(spark):
    """Unbounded columns: two huge totals, infinity and an unreadable one beside good ones."""
    totals = [1e18, 1e18, float("inf"), float("nan"), 1e300, 12.00004, 13.00004]
    df = enriched(spark, *[trip(total_amount=t, trip_distance=t) for t in totals])
    row = kpi(df, "avg_fare_by_feed").first()
    assert row.avg_total == pytest.approx(5e17) and row.trip_count == 7
    rolled = summarise(from_rollup(rollup(df)), ROLLED["avg_distance"]).first()
    assert rolled.avg_distance == pytest.approx(5e17) and rolled.trip_count == 4
    assert od_flows(df).first().trip_count == 7
    assert group_stats(df).first().mean_distance == pytest.approx(12.50004)


def test_means_keep_small_fractions(spark):
    df = enriched(spark, trip(fare_amount=1.00004, trip_distance=0.00004), trip(fare_amount=1.00004, trip_distance=0.00004))
    assert kpi(df, "avg_fare_by_feed").first().avg_fare == pytest.approx(1.00004, abs=1e-12)
    assert kpi(df, "avg_distance").first().avg_distance == pytest.approx(0.00004, abs=1e-12)


def test_cap_keeps_the_most_extreme(spark):
    fares = [trip(fare_amount=300.0 + i, source_file=str(i)) for i in range(4)]
    flagged = tag_anomalies(enriched(spark, *spread_fares(400), *fares), feeds=("yellow",))
    assert flagged.count() == 4
    assert {r.fare_amount for r in cap_anomalies(flagged, 2).collect()} == {302.0, 303.0}
    assert cap_anomalies(flagged).count() == 4 == cap_anomalies(flagged, 100).count()


@pytest.mark.parametrize("n", [5, 1_500, 20_000])
def test_top_n_by_buckets(spark, n):
    rows = spark.range(12_000).select(F.pmod(F.xxhash64("id"), F.lit(500)).alias("v"), "id")
    found = top_n(rows.repartition(16), by("-v", "id"), n, bucket=-F.floor(F.col("v") / 7)).collect()
    everything = sorted(((r.v, r.id) for r in rows.collect()), key=lambda r: (-r[0], r[1]))
    assert [(r.v, r.id) for r in found] == everything[:n]
    assert top_n(rows.limit(0), by("-v", "id"), n, bucket=F.col("v")).collect() == []


def test_a_large_top_n_sorts_only_what_can_be_among_it(spark):
    rows = spark.range(1_000_000).select(F.pmod(F.xxhash64("id"), F.lit(100_000)).alias("v"), "id")
    kept = cut_off(rows, 5_000, F.floor(F.col("v") / 100))
    assert 5_000 <= kept.count() < 8_000
    plan = top_n(rows, by("v", "id"), 5_000, F.floor(F.col("v") / 100))._jdf.queryExecution()
    assert "rangepartitioning" not in plan.executedPlan().toString()


def test_incidents_meet_trips_by_upper_case_area(spark):
    incidents = spark.createDataFrame(
        [("B1", "2025-04"), ("B1", "2025-04"), (None, "2025-04"), ("B1", "2025-05")],
        "borough string, crash_month string",
    )
    df = enriched(spark, trip()).withColumn("pu_borough", F.lit("b1"))
    rows = incident_trip_join(incidents, tally(df)).collect()
    assert [tuple(r) for r in rows] == [("B1", "2025-04", 2, 1)]
