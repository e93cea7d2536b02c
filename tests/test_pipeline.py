"""The whole run on four small raw feeds."""

import datetime as dt
import json
import random
from dataclasses import replace

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tripmill.feeds import FEEDS
from tripmill.operators import models
from tripmill.operators.anomalies import group_stats
from tripmill.plans.layers import Pipeline, RawSources
from tripmill.specs import FeedSpec, LakeOptions, PeriodFilter, RunOptions

MONTHS = ("2025-04", "2025-05")


def raw_table(feed, month, rng, n=120):
    year, number = map(int, month.split("-"))
    start = dt.datetime(year, number, 1)
    pickups = [start + dt.timedelta(minutes=rng.randrange(28 * 24 * 60)) for _ in range(n)]
    ends = [p + dt.timedelta(minutes=rng.randrange(1, 60)) for p in pickups]
    zones = [[rng.randrange(1, 7) for _ in range(n)] for _ in range(2)]
    zones[0][0] = 400  # out of range
    fares = [round(rng.uniform(3, 60), 2) for _ in range(n)]
    fares[1] = 480.0
    time = pa.timestamp("us")
    ids = pa.int32() if month == MONTHS[0] else pa.int64()
    names = {
        "yellow": ("tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID"),
        "green": ("lpep_pickup_datetime", "lpep_dropoff_datetime", "PULocationID", "DOLocationID"),
        "fhv": ("pickup_datetime", "dropOff_datetime", "PUlocationID", "DOlocationID"),
        "fhvhv": ("pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID"),
    }[feed]
    columns = {
        names[0]: pa.array(pickups, time),
        names[1]: pa.array(ends, time),
        names[2]: pa.array(zones[0], ids),
        names[3]: pa.array(zones[1], ids),
    }
    miles = [round(rng.uniform(0.5, 15), 2) for _ in range(n)]
    if feed in ("yellow", "green"):
        columns |= {
            "fare_amount": fares,
            "total_amount": [f + 2.5 for f in fares],
            "trip_distance": miles,
            "payment_type": pa.array([rng.choice([1, 2]) for _ in range(n)], pa.int64()),
        }
    if feed == "fhvhv":
        columns |= {
            "base_passenger_fare": fares,
            "trip_miles": miles,
            "trip_time": pa.array([int(m * 180) + 60 for m in miles], pa.int64()),
            "shared_match_flag": [rng.choice("YN") for _ in range(n)],
        }
    table = pa.table(columns)
    return pa.concat_tables([table, table.slice(5, 10)])  # ten trips delivered twice


@pytest.fixture(scope="module", autouse=True)
def few_rounds():
    """The production model with fewer rounds: the run is what is tested here."""
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(models, "ROUNDS", 10)
        yield


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("pipeline")
    rng = random.Random(11)
    roots = {}
    for spec in FEEDS:
        folder = base / "raw" / spec.name
        folder.mkdir(parents=True)
        roots[spec.name] = str(folder)
        for month in MONTHS:
            table = raw_table(spec.name, month, rng)
            pq.write_table(table, folder / f"{spec.name}_tripdata_{month}.parquet")
    zones = base / "zones.csv"
    areas = ["Manhattan", "Queens", "Bronx"]
    lines = [f"{i},{areas[i % 3]},Zone {i},x" for i in range(1, 7)]
    zones.write_text("LocationID,Borough,Zone,service_zone\n" + "\n".join(lines) + "\n")
    images = base / "maps"
    images.mkdir()
    (images / "taxi_zone_map_bronx.jpg").write_bytes(b"jpg")
    incidents = base / "incidents.json"
    incidents.write_text(
        json.dumps([{"borough": "queens", "crash_date": "2025-04-03T00:00:00.000"}] * 3)
    )
    options = RunOptions(feeds=FEEDS)
    sources = RawSources(roots, str(zones), incidents=str(incidents), images=str(images))
    return Pipeline(spark, str(base / "lake"), sources, options).run()


def test_silver_keeps_valid_trips_once(run):
    trips = run.read("silver", "trips")
    counts = {r.vehicle_type: r["count"] for r in trips.groupBy("vehicle_type").count().collect()}
    # 120 trips a month, one of them outside the zones; the ten repeated ones count once.
    assert counts == dict.fromkeys(("yellow", "green", "fhv", "fhvhv"), 238)
    report = {r.vehicle_type: r for r in run.read("silver", "quality_report").collect()}
    assert report["green"].rows_read == 260 and report["green"].invalid_records == 2
    assert report["green"].duplicates_removed == 20 and report["green"].rows_kept == 238


def test_gold_agrees_with_silver(run):
    trips = run.read("silver", "trips")
    fares = {r.vehicle_type: r for r in run.read("gold", "kpi_avg_fare_by_feed").collect()}
    for r in trips.groupBy("vehicle_type").agg(F.avg("fare_amount").alias("m")).collect():
        mean = fares[r.vehicle_type].avg_fare
        assert mean is None and r.m is None or mean == pytest.approx(r.m, abs=1e-9)
    assert run.read("gold", "kpi_monthly_trend").count() == 8
    assert run.read("gold", "kpi_avg_duration").count() == 1
    assert run.read("gold", "kpi_shared_rate").first().vehicle_type == "fhvhv"
    weather = run.read("gold", "kpi_weather_daily")
    assert weather.agg(F.sum("trip_count")).first()[0] == trips.count()
    assert weather.first().temp_max == 22.0  # no weather source: the default calendar


def test_lake_tables(run):
    flows = run.read("lake", "od_flows")
    assert flows.agg(F.sum("trip_count")).first()[0] == 952  # nothing is sampled unasked
    assert run.read("lake", "top_routes").count() == 50
    outliers = run.read("lake", "anomaly_trips")
    assert outliers.count() > 0
    assert {r.fare_amount for r in outliers.collect() if "fare" in r.anomaly_reason} == {480.0}
    correlation = run.read("lake", "incident_correlation").collect()
    assert [(r.borough, r.crash_month, r.collision_count) for r in correlation] == [
        ("QUEENS", "2025-04", 3)
    ]
    drift = {(r.feed, r.column_name): r for r in run.read("lake", "schema_drift").collect()}
    assert drift[("green", "pulocationid")].types == "bigint,int"
    report = run.read("lake", "duration_model").first()
    assert report.model == "GradientBoosting" and report.r2_score > 0.6


def test_serving(run):
    assert run.read("serving", "lake_top_routes").count() == 50
    heat = run.read("lake", "zone_heatmap").count()
    assert run.read("serving", "lake_zone_heatmap").count() == heat
    assert run.read("serving", "lake_duration_model").count() == 1
    assert run.read("serving", "lake_schema_drift").count() > 0
    names = {r.name for r in run.read("serving", "kpi_samples").collect()}
    assert {"taxi_avg_fare", "taxi_shared_ride_rate", "taxi_payment_trips"} <= names
    samples = run.read("serving", "lake_samples").collect()
    assert {r.name: r.value for r in samples}["serving_kpi_tables"] == 12
    assert {r.name: r.value for r in samples}["serving_lake_tables"] == 6
    assert sum(r.name == "lake_top_route" for r in samples) == 15
    gauges = run.read("serving", "step_samples").filter("value > 0 and layer = 'silver'")
    assert "pipeline_duplicates_removed" in {r.name for r in gauges.collect()}
    inventory = {r.table_name: r.row_count for r in run.read("serving", "table_inventory").collect()}
    assert inventory["silver_trips"] == 952
    assert run.read("serving", "step_durations").filter("layer is null").count() == 1


def test_step_records(run, spark):
    steps = spark.read.parquet(run.log.path)
    assert steps.filter("status = 'error'").count() == 0
    rows = {(r.layer, r.operation): r for r in steps.collect()}
    assert rows[("silver", "quality_fhv")].duplicates_removed == 20
    assert rows[("silver", "quality_fhv")].invalid_records == 2
    assert rows[("silver", "trips")].rows_written == 952
    assert rows[("bronze", "land_yellow")].rows_written == 260
    assert rows[("bronze", "images")].rows_written == 1
    assert rows[("bronze", "weather")].extra["default"] == "True"
    assert rows[("bronze", "incidents")].extra["default"] == "False"
    assert rows[("lake", "od_flows")].extra["fraction"] == "1.0"
    assert rows[("silver", "trips")].rows_read == 4 * 260
    assert steps.filter("rows_read = 0 and rows_written > 0").count() == 0


def test_bronze_tables_say_where_they_are_from(run):
    for name, default in (("zones", False), ("images", False), ("weather", True), ("incidents", False)):
        table = run.read("bronze", name)
        assert {"_ingestion_ts", "_source_file"} <= set(table.columns)
        assert {r[0] for r in table.select("_is_default").collect()} == {default}


def test_every_landed_row_is_kept_rejected_or_repeated(run):
    for r in run.read("silver", "quality_report").collect():
        assert r.rows_read == r.rows_kept + r.invalid_records + r.duplicates_removed


def scans_of(spark, part, action):
    """Scans that read columns of files below a path, in the plans that ``action`` ran."""
    store = spark._jsparkSession.sharedState().statusStore()

    def executions():
        found = store.executionsList()
        return {found.apply(i).executionId() for i in range(found.size())}

    before = executions()
    spark.conf.set("spark.sql.maxMetadataStringLength", 1_000)  # whole paths in the plans
    try:
        action()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    found = []
    for number in sorted(executions() - before):
        nodes = store.planGraph(number).allNodes()
        for i in range(nodes.size()):
            node = nodes.apply(i)
            if node.name().startswith("Scan parquet") and part in node.desc():
                if "ReadSchema: struct<>" not in node.desc():
                    found.append(node.desc())
    return found


def test_silver_reads_bronze_once(run, spark):
    """Bronze trips are scanned once per feed; the report reads footers and rejected rows."""
    again = Pipeline(spark, run.base, run.sources, run.options)
    bronze = scans_of(spark, "/bronze/trips/spec=", again.silver)
    assert len(bronze) == len(run.options.feeds)
    kept = scans_of(spark, "verdict=kept", again.silver)
    assert not kept
    rejected = run.read("silver", "rejected_trips")
    assert rejected.count() == 8 and rejected.filter("pu_location_id = 400").count() == 8


def test_lake_reads_silver_twice(run, spark):
    again = Pipeline(spark, run.base, run.sources, run.options)
    assert len(scans_of(spark, "verdict=kept", again.lake)) == 2


def test_model_rows_are_those_of_lowest_hash(run):
    """Picked from a share of the trips, or from all where the share is too small."""
    silver = run.read("silver", "trips")
    for cap, share in ((40, None), (150, 0.05)):
        options = replace(run.options, lake=LakeOptions(max_model_rows=cap, min_model_rows=10**6))
        again = Pipeline(run.spark, run.base, run.sources, options)
        if share is not None:
            again.model_share = lambda rows, share=share: share
        again.single_trips(silver, group_stats(silver))
        rows = [str(tuple(r)) for r in again.read("lake", "model_rows").collect()]
        want = [str(tuple(r)) for r in models.ml_input(silver, cap=cap).collect()]
        assert sorted(rows) == sorted(want) and len(rows) == cap


def labelled(folder):
    """One landing of several feeds: a declared label, another one and none."""
    folder.mkdir(parents=True)
    start = dt.datetime(2025, 4, 1)
    n = 90
    table = pa.table(
        {
            "kind": ["day", "night", None] * (n // 3),
            "begun": pa.array([start + dt.timedelta(minutes=i) for i in range(n)], pa.timestamp("us")),
            "ended": pa.array([start + dt.timedelta(minutes=i + 9) for i in range(n)], pa.timestamp("us")),
            "a": pa.array([1 + i % 5 for i in range(n)], pa.int32()),
            "b": pa.array([400 if i == 0 else 2 for i in range(n)], pa.int32()),
        }
    )
    pq.write_table(pa.concat_tables([table, table.slice(3, 3)]), folder / "shared_2025-04.parquet")
    return str(folder)


def test_no_label_is_lost_and_repeated_zones_multiply_nothing(spark, tmp_path):
    spec = FeedSpec("shared", "begun", "ended", "a", "b", feed_column="kind", labels=("day",))
    zones = tmp_path / "zones.csv"
    lines = [f"{i},Area,Zone {i}{x},x" for i in range(1, 7) for x in "ab"]
    zones.write_text("LocationID,Borough,Zone,service_zone\n" + "\n".join(lines) + "\n")
    sources = RawSources({"shared": labelled(tmp_path / "raw")}, str(zones))
    run = Pipeline(spark, str(tmp_path / "lake"), sources, RunOptions((spec,))).run(["bronze", "silver"])
    report = {r.vehicle_type: r for r in run.read("silver", "quality_report").collect()}
    assert set(report) == {"day", "night", "shared"}
    for r in report.values():
        assert r.rows_read == r.rows_kept + r.invalid_records + r.duplicates_removed == 31
        assert r.duplicates_removed == 1
    assert report["day"].invalid_records == 1
    assert run.read("silver", "trips").count() == 89
    assert run.read("silver", "trips").filter("pu_zone_name not like '%a'").count() == 0
    steps = {s.operation: s for s in run.log.steps}
    assert steps["trips"].extra["zones_repeated"] == "6"


def test_a_run_without_any_feed(spark, tmp_path, run):
    sources = RawSources({}, run.sources.zones)
    empty = Pipeline(spark, str(tmp_path / "lake"), sources, run.options).run(["bronze", "silver"])
    weather = empty.read("bronze", "weather")
    assert weather.count() == 61 and weather.filter("not _is_default").count() == 0


def test_a_skipped_model_leaves_no_report_to_serve(spark, run, tmp_path):
    options = replace(run.options, lake=LakeOptions(min_model_rows=10**6))
    again = Pipeline(spark, run.base, run.sources, options)
    again.lake()
    names = {r.name for r in again.read("serving", "lake_samples").collect()}
    assert not any(n.startswith("lake_ml_") for n in names)
    run.run(["lake"])


def test_layers_restart_alone(run):
    before = run.read("gold", "kpi_top_pickup").collect()
    run.run(["gold"])
    assert run.read("gold", "kpi_top_pickup").collect() == before


def test_presets():
    sample, light = RunOptions.sample(FEEDS), RunOptions.light(FEEDS)
    assert (sample.periods.first_n, sample.lake.anomaly_fraction) == (2, 1.0)
    assert (sample.lake.flow_fraction, sample.lake.served_rows) == (0.05, 500)
    full = RunOptions(FEEDS).lake
    assert {full.flow_fraction, full.anomaly_fraction, full.model_fraction} == {1.0}
    assert full.max_anomalies is None and full.served_rows is None
    assert (light.periods.first_n, light.lake.feeds) == (1, ("green",))


def test_light_run_of_one_month_and_feed(run, spark, tmp_path):
    options = RunOptions(
        feeds=FEEDS, periods=PeriodFilter(month="2025-05"), lake=LakeOptions.light()
    )
    sources = RawSources(
        {k: v for k, v in run.sources.feeds.items() if k != "fhv"}, run.sources.zones
    )
    small = Pipeline(spark, str(tmp_path / "lake"), sources, options).run()
    assert {r.year_month for r in small.read("silver", "trips").select("year_month").collect()} == {
        "2025-05"
    }
    assert small.read("lake", "model_rows").count() == 119
    feeds = {r.vehicle_type for r in small.read("lake", "od_flows").collect()}
    assert feeds == {"green"}
    assert small.read("bronze", "incidents").count() == 5  # no source: the default records
    assert small.read("bronze", "weather").count() == 31
