"""Registered queries: every operator on whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks import bindings as b
from checks import rawfiles
from tripmill.functions.numbers import mean_of
from tripmill.functions.periods import month_of, period_of
from tripmill.operators import anomalies as an
from tripmill.operators import flows, incidents, kpis, models, quality, serving, steps
from tripmill.operators.conform import (
    add_time_parts,
    conform,
    feed_label,
    only_feeds,
    union_feeds,
)
from tripmill.operators.drift import file_columns, schema_drift, union_columns
from tripmill.operators.tally import from_rollup, rollup, side_rollup, summarise, tally
from tripmill.operators.zones import add_zones
from tripmill.plans import merge
from tripmill.plans.reuse import materialised
from tripmill.plans.steplog import StepLog
from tripmill.session import scratch_path
from tripmill.sources import landing, reference, snapshots, tables
from tripmill.sources.files import file_manifest, footer_columns, list_files, with_source
from tripmill.specs import PeriodFilter
from tripmill.streaming.landing import land_new_files

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}


def register(query: Query) -> Query:
    """Register under the function's name, without the underscore that avoids a clash."""
    REGISTERED[query.__name__.rstrip("_")] = query
    return query


# ---- sources and sinks ----------------------------------------------------


@register
def land_feed(spark, sf):
    """Raw files in three physical layouts landed in the declared types."""
    root = rawfiles.write_freight(spark, sf)
    landed = landing.land_feed(spark, root, rawfiles.FREIGHT_FILES)
    return landed.drop("_ingestion_ts")


@register
def land_selected_months(spark, sf):
    """The same landing limited to one year: other files are not even opened."""
    root = rawfiles.write_freight(spark, sf)
    landed = landing.land_feed(spark, root, rawfiles.FREIGHT_FILES, PeriodFilter(year="1998"))
    return landed.drop("_ingestion_ts")


@register
def land_stream(spark, sf):
    """The raw files landed by a stream that takes them in several batches."""
    root, target = rawfiles.write_freight(spark, sf), scratch_path(spark, "landed")
    land_new_files(
        spark, root, rawfiles.FREIGHT_FILES, target, scratch_path(spark, "stream"), 40
    ).awaitTermination()
    landed = tables.read_feeds(spark, target)
    return landed.drop("_ingestion_ts", "vehicle_type", "landing_batch")


def _freight_trips(spark, sf):
    return conform(b.freight_raw(spark, sf), b.FREIGHT).drop("ingestion_ts", "source_file")


@register
def select_months(spark, sf):
    return landing.select_periods(_freight_trips(spark, sf), PeriodFilter(month="1997-03"))


@register
def select_year(spark, sf):
    return landing.select_periods(_freight_trips(spark, sf), PeriodFilter(year="1999"))


@register
def select_first_n_months(spark, sf):
    return landing.select_periods(_freight_trips(spark, sf), PeriodFilter(first_n=2))


@register
def period_from_name(spark, sf):
    orders = b.table(spark, sf, "orders").select(
        F.concat(
            F.lit("freight_"), month_of(F.col("o_orderdate")), F.lit("_"), "o_orderstatus",
            F.lit(".parquet"),
        ).alias("name")
    )
    names = orders.union(b.table(spark, sf, "pages").select("url"))
    return names.withColumn("period", period_of(F.col("name")))


@register
def lineage(spark, sf):
    landed = landing.add_lineage(b.table(spark, sf, "lineitem"), "freight")
    return landed.select(
        "l_orderkey",
        "l_linenumber",
        "_source_file",
        "_source_type",
        "year_month",
        F.col("_ingestion_ts").isNotNull().alias("has_time"),
    )


@register
def partition_overwrite(spark, sf):
    """The first month is delivered again with other quantities; other months stay."""
    path = scratch_path(spark, "partitions")
    trips = conform(b.freight_raw(spark, sf), b.FREIGHT).select(
        "vehicle_type", "year_month", "l_orderkey", "l_linenumber", "trip_distance"
    )
    tables.write_partitions(trips, path)
    again = landing.select_periods(trips, PeriodFilter(first_n=1))
    tables.write_partitions(again.withColumn("trip_distance", F.col("trip_distance") + 1), path)
    return tables.read_feeds(spark, path, b.FREIGHT_FEEDS)


@register
def csv_dimension(spark, sf):
    path = scratch_path(spark, "zones")
    b.zones(spark, sf).withColumn("service_zone", F.lower("Borough")).write.option(
        "header", "true"
    ).csv(path)
    return reference.read_dimension(spark, path)


@register
def file_manifest_(spark, sf):
    """Manifest of one text file per nation, written by the query."""
    root = scratch_path(spark, "names")
    names = b.table(spark, sf, "nation").select(
        F.concat(F.lit("map_"), F.col("n_nationkey").cast("string")).alias("file"),
        F.concat_ws(" ", "n_name", F.col("n_regionkey").cast("string")).alias("value"),
    )
    names.repartition("file").write.partitionBy("file").text(root)
    found = file_manifest(spark, root, "*.txt", media_type="text/plain")
    return found.select(
        F.regexp_extract("file_path", r"file=([^/]+)/", 1).alias("file"),
        "file_size_bytes",
        "content_hash",
        "media_type",
    )


@register
def daily_arrays_to_rows(spark, sf):
    """Daily values packed to one JSON payload a year and unpacked again."""
    days = b.weather(spark, sf)
    packed = days.groupBy(F.year("date").alias("year")).agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    F.col("date").cast("string").alias("time"),
                    F.col("temp_max").alias("temperature_2m_max"),
                    F.col("temp_min").alias("temperature_2m_min"),
                    "precipitation_sum",
                    F.col("weather_code").alias("weathercode"),
                )
            )
        ).alias("d")
    )
    fields = ("time", *reference.WEATHER_FIELDS)
    payloads = packed.select(
        F.to_json(F.struct(F.struct(*[F.col("d")[f].alias(f) for f in fields]).alias("daily"))).alias(
            "value"
        )
    )
    return reference.daily_rows(payloads)


def _order_months(spark, sf):
    return b.table(spark, sf, "orders").select(month_of(F.col("o_orderdate")).alias("year_month"))


@register
def covering_range(spark, sf):
    return reference.covering_range(_order_months(spark, sf))


@register
def calendar_default(spark, sf):
    """Every day of the covering range; days without orders get the default values."""
    calendar = reference.default_calendar(reference.covering_range(_order_months(spark, sf)))
    return reference.fill_days(b.weather(spark, sf), calendar)


@register
def clean_incidents(spark, sf):
    return reference.clean_incidents(b.incidents_raw(spark, sf))


@register
def incident_default(spark, sf):
    return reference.default_incidents(b.zones(spark, sf).select(F.lower("Borough").alias("borough")))


@register
def silver_roundtrip(spark, sf):
    path = scratch_path(spark, "silver")
    tables.write_partitions(b.silver(spark, sf), path, whole=True)
    return tables.read_feeds(spark, path, b.ALL_FEEDS)


def _late_freight(trips):
    """Some trips of 1995 delivered again: newer ones with another distance, a part of them for
    another month; and older ones, which change nothing."""
    line = F.col("l_linenumber")
    moved = F.when((line == 6) & (F.col("l_orderkey") % 8 == 1), "1996-01").otherwise(F.col("year_month"))
    days = F.when(line < 6, F.expr("interval -1 day")).otherwise(F.expr("interval 1 day"))
    return trips.filter(F.col("year_month").startswith("1995-") & (line > 4)).withColumns(
        {
            "trip_distance": F.col("trip_distance") + 1,
            "ingestion_ts": F.col("ingestion_ts") + days,
            "year_month": moved,
            "source_file": F.lit("late"),
        }
    )


def _merged_freight(spark, sf):
    """The path of a table of the freight feeds that late deliveries were merged into."""
    path = scratch_path(spark, "merged")
    trips = quality.apply_quality(conform(b.freight_raw(spark, sf), b.FREIGHT), b.FREIGHT_BOUNDS)
    # The last line of each order of 1995 comes with the late deliveries only.
    first = trips.filter(~(F.col("year_month").startswith("1995-") & (F.col("l_linenumber") == 7)))
    for delivery in (first, _late_freight(trips)):
        merge.merge_latest(delivery, path, b.FREIGHT.identity)
    return path


@register
def silver_merged(spark, sf):
    """Late deliveries merged into the months they change: as if all had been there at once."""
    return snapshots.read_snapshot(spark, _merged_freight(spark, sf))


@register
def snapshot_read(spark, sf):
    """Both versions of a table that late deliveries were merged into."""
    path = _merged_freight(spark, sf)
    return union_feeds(
        snapshots.read_snapshot(spark, path, n).withColumn("version", F.lit(n))
        for n in snapshots.versions(spark, path)
    )


@register
def quality_report(spark, sf):
    return union_feeds(
        [
            quality.quality_counts(
                conform(b.freight_raw(spark, sf), b.FREIGHT), b.FREIGHT_BOUNDS, b.FREIGHT.identity
            ),
            quality.quality_counts(
                conform(b.app_raw(spark, sf), b.APP), b.APP_BOUNDS, b.APP.identity
            ),
        ]
    )


def _judged(spark, sf):
    """Kept and rejected rows of both feed families in one written table, by verdict."""
    freight = quality.judge(
        conform(b.freight_raw(spark, sf), b.FREIGHT),
        b.FREIGHT_BOUNDS,
        b.FREIGHT.identity,
        drop=b.FREIGHT.carry,
    )
    app = quality.judge(
        conform(b.app_raw(spark, sf), b.APP), b.APP_BOUNDS, b.APP.identity, drop=b.APP.carry
    )
    path = scratch_path(spark, "judged")
    tables.write_partitions(union_feeds([freight, app]), path, quality.VERDICT_PARTITIONS, whole=True)
    return path


@register
def quality_report_of_tables(spark, sf):
    """The same report from the rows of the kept and rejected parts, written in one pass."""
    path = _judged(spark, sf)
    landed = [
        conform(b.freight_raw(spark, sf), b.FREIGHT).select("vehicle_type"),
        conform(b.app_raw(spark, sf), b.APP).select("vehicle_type"),
    ]
    return quality.report_of_parts(
        union_feeds(landed),
        tables.read_if_exists(spark, f"{path}/verdict={quality.REJECTED}"),
        spark.read.parquet(f"{path}/verdict={quality.KEPT}"),
    )


@register
def rejected_trips(spark, sf):
    """Every rejected row as often as it was delivered."""
    rows = spark.read.parquet(f"{_judged(spark, sf)}/verdict={quality.REJECTED}")
    return rows.select(
        "vehicle_type", "pickup_ts", "pu_location_id", "do_location_id", "fare_amount", "trip_distance"
    )


@register
def serving_snapshot(spark, sf):
    path = scratch_path(spark, "serving")
    table = kpis.kpi(b.silver(spark, sf), "trips_by_zone_hour")
    tables.write_sorted(table, path, serving.KPI_KEYS["trips_by_zone_hour"])
    return spark.read.parquet(path)


@register
def serving_capped(spark, sf):
    table = flows.zone_heatmap(b.silver(spark, sf))
    return _means(serving.capped(table, serving.LAKE_KEYS["zone_heatmap"], serving.SERVED_ROWS))


@register
def serving_reports(spark, sf):
    """The model report and the drift report as dashboards read them, one row per number."""
    trips = materialised(b.silver(spark, sf), "trips")
    rows = models.ml_input(trips, fraction=1.0, cap=None)
    report = models.regression_metrics(_mean_predictor(rows)).withColumn("model", F.lit("means"))
    served = []
    for name, table in (("duration_model", report), ("schema_drift", schema_drift(_footers(spark, sf)))):
        path = scratch_path(spark, name)
        tables.write_sorted(serving.capped(table, serving.LAKE_KEYS[name]), path, serving.LAKE_KEYS[name])
        written = spark.read.parquet(path)
        keys = serving.LAKE_KEYS[name]
        numbers = [c for c, kind in written.dtypes if c not in keys and kind in ("double", "bigint")]
        wide = written.select(
            F.lit(name).alias("report"),
            F.concat_ws("|", *keys).alias("group_key"),
            *[F.col(c).cast("double").alias(c) for c in numbers],
        )
        served.append(wide.unpivot(["report", "group_key"], numbers, "measure", "value"))
    return union_feeds(served)


@register
def serving_sorted(spark, sf):
    """Key ranges of the files of a served table may meet at one value but not overlap."""
    path = scratch_path(spark, "sorted")
    trips = b.silver(spark, sf)
    tables.write_sorted(flows.zone_heatmap(trips), path, ("pu_location_id", "pickup_hour"))
    files = (
        spark.read.parquet(path)
        .groupBy(F.col("_metadata.file_name").alias("file_name"))
        .agg(
            F.min("pu_location_id").alias("low"),
            F.max("pu_location_id").alias("high"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    before = F.lag("high").over(Window.orderBy("low", "high"))  # one row per file
    return files.withColumn("_overlaps", F.col("low") < before).agg(
        F.sum("n").alias("row_count"), F.count_if("_overlaps").alias("overlapping_files")
    )


# ---- conform, filter, deduplicate, enrich ---------------------------------


@register
def conform_feed(spark, sf):
    return conform(b.freight_raw(spark, sf), b.FREIGHT)


@register
def conform_sparse_feed(spark, sf):
    return conform(b.app_raw(spark, sf), b.APP)


@register
def conform_derived_duration(spark, sf):
    return conform(b.freight_raw(spark, sf), b.FREIGHT, derive_duration=True).select(
        "l_orderkey", "l_linenumber", "pickup_ts", "dropoff_ts", "trip_duration_sec"
    )


@register
def quality_filter(spark, sf):
    return quality.apply_quality(conform(b.freight_raw(spark, sf), b.FREIGHT), b.FREIGHT_BOUNDS)


@register
def profile_feed(spark, sf):
    """Pickup time taken as unknown where the order date is after the ship date."""
    raw = b.freight_raw(spark, sf).withColumn(
        "o_orderdate", F.when(F.col("o_orderdate") <= F.col("l_shipdate"), F.col("o_orderdate"))
    )
    return quality.profile(conform(raw, b.FREIGHT))


@register
def dedup_latest(spark, sf):
    return quality.keep_latest(
        conform(b.freight_raw(spark, sf), b.FREIGHT), b.FREIGHT.identity, drop=b.FREIGHT.carry
    )


@register
def dedup_redelivered(spark, sf):
    """Each event delivered twice with another total; the later delivery stays."""
    first = conform(b.app_raw(spark, sf), b.APP).drop("event_id")
    second = first.withColumns(
        {
            "ingestion_ts": F.col("ingestion_ts") + F.expr("interval 1 day"),
            "total_amount": F.col("total_amount") + 1,
            "source_file": F.lit("events_again"),
        }
    )
    return quality.keep_latest(union_feeds([first, second]))


@register
def silver_all_labels(spark, sf):
    """Rows landed, rejected, repeated and kept per feed, with one label declared, one not
    and one missing: every landed row is in one of the three."""
    raw = b.freight_raw(spark, sf).withColumn(
        "feed", F.when(F.col("feed") != "freight_R", F.col("feed"))
    )
    again = raw.filter(F.col("l_linenumber") == 1)
    spec = replace(b.FREIGHT, labels=("freight_A",))
    path = f"{scratch_path(spark, 'labels')}/spec={spec.name}"
    landed = raw.unionAll(again).withColumn("vehicle_type", feed_label(F.col("feed"), spec))
    tables.write_partitions(landed, path, gather=False)
    conformed = conform(tables.read_feeds(spark, path), spec)
    kept = quality.keep_latest(
        quality.apply_quality(conformed, b.FREIGHT_BOUNDS), spec.identity, drop=spec.carry
    )
    return quality.report_of(quality.rejects(conformed, b.FREIGHT_BOUNDS), kept)


@register
def enrich_zones_repeated(spark, sf):
    """Zones listed twice, once under another name and once without a number."""
    places = b.zones(spark, sf)
    twice = places.unionAll(
        places.withColumns({"Borough": F.concat(F.lit("ZZ "), "Borough"), "Zone": F.upper("Zone")})
    ).unionAll(places.withColumn("LocationID", F.lit(None).cast("int")))
    return add_zones(conform(b.freight_raw(spark, sf), b.FREIGHT), twice).drop(
        "ingestion_ts", "source_file"
    )


@register
def enrich_zones(spark, sf):
    return add_zones(conform(b.freight_raw(spark, sf), b.FREIGHT), b.zones(spark, sf)).drop(
        "ingestion_ts", "source_file"
    )


@register
def time_parts(spark, sf):
    return add_time_parts(b.table(spark, sf, "events").select("event_id", "ts"), "ts")


@register
def union_feeds_(spark, sf):
    """Feeds with different columns by name."""
    freight = b.freight_raw(spark, sf).drop("_ingestion_ts", "l_shipdate", "l_linenumber")
    app = b.app_raw(spark, sf).drop("_ingestion_ts", "ended")
    return union_feeds([freight, app])


@register
def feed_subset(spark, sf):
    return only_feeds(b.silver(spark, sf), ("freight_A", "app_view"))


@register
def reject_counts(spark, sf):
    return quality_report(spark, sf).select(
        "vehicle_type", "rows_read", "invalid_records", "duplicates_removed"
    )


# ---- KPIs -----------------------------------------------------------------


def _kpi(name: str) -> Query:
    def query(spark, sf):
        return _means(kpis.kpi(b.silver(spark, sf), name))

    return query


def _means(df: DataFrame) -> DataFrame:
    """Means compared to six digits: another engine adds doubles in another order."""
    return _rounded(df, [c for c in df.columns if c.startswith("avg_") or c == "mean"], 6)


def _rounded(df: DataFrame, columns, digits: int) -> DataFrame:
    return df.withColumns({c: shown(c, digits) for c in columns})


def shown(column: str, digits: int) -> Column:
    """A double rounded once; the factor keeps exact halves from falling either way."""
    return F.round(F.col(column).cast("double") * 1.000000000001, digits)


for _name in (*kpis.ROLLED, *kpis.SIDE):
    REGISTERED[_name] = _kpi(_name)


@register
def shared_rate(spark, sf):
    return kpis.shared_rate(tally(b.silver(spark, sf)), b.APP_FEEDS)


@register
def weather_daily(spark, sf):
    return kpis.weather_daily(tally(b.silver(spark, sf)), b.weather(spark, sf))


@register
def trip_rollup(spark, sf):
    rolled = rollup(b.silver(spark, sf))
    sums = ("fare_sum", "total_sum", "distance_sum")
    return _rounded(rolled, sums, 4)


@register
def all_kpis(spark, sf):
    """What gold runs: the whole catalogue from the two rollups, one row per number."""
    trips = materialised(b.silver(spark, sf), "trips")
    rolled = materialised(rollup(trips), "rollup")
    side = materialised(side_rollup(trips), "side-rollup")
    parts = []
    for name, table in kpis.all_kpis(rolled, side, b.weather(spark, sf), b.APP_FEEDS).items():
        numbers = [c for c in table.columns if c in KPI_NUMBERS]
        keys = [F.col(c).cast("string") for c in table.columns if c not in KPI_NUMBERS]
        wide = table.select(
            F.lit(name).alias("kpi"),
            F.concat_ws("|", *keys).alias("group_key"),
            *[
                (shown(c, 6) if c.startswith("avg_") else F.col(c).cast("double")).alias(c)
                for c in numbers
            ],
        )
        parts.append(wide.unpivot(["kpi", "group_key"], numbers, "measure", "value"))
    return union_feeds(parts)


KPI_NUMBERS = (
    "trip_count", "avg_fare", "avg_total", "avg_distance", "avg_duration_sec",
    "total_trips", "shared_trips", "shared_rate",
    "temp_max", "temp_min", "precipitation_sum", "weather_code",
)


@register
def trip_side_rollup(spark, sf):
    return side_rollup(b.silver(spark, sf))


@register
def kpis_from_rollup(spark, sf):
    """KPIs read from the two written rollups, one row per KPI and group."""
    trips = materialised(b.silver(spark, sf), "trips")
    base = from_rollup(materialised(rollup(trips), "rollup"))
    side = materialised(side_rollup(trips), "side-rollup")
    parts = []
    for name, spec in (kpis.ROLLED | kpis.SIDE).items():
        keys = F.concat_ws("|", *[F.col(k).cast("string") for k in spec.keys])
        mean = next(iter(spec.means), None)
        parts.append(
            summarise(base if name in kpis.ROLLED else side, spec).select(
                F.lit(name).alias("kpi"),
                keys.alias("group_key"),
                "trip_count",
                (F.col(mean) if mean else F.lit(None).cast("double")).alias("mean"),
            )
        )
    return _means(union_feeds(parts))


# ---- lake -----------------------------------------------------------------


@register
def hash_sample(spark, sf):
    return flows.hash_sample(b.silver(spark, sf), 0.05)


@register
def od_flows(spark, sf):
    return _means(flows.od_flows(b.silver(spark, sf)))


@register
def zone_heatmap(spark, sf):
    return _means(flows.zone_heatmap(b.silver(spark, sf)))


@register
def top_routes(spark, sf):
    return _means(flows.top_routes_of(b.silver(spark, sf)))


@register
def feed_stats(spark, sf):
    stats = an.group_stats(b.silver(spark, sf))
    return _rounded(stats, ("mean_fare", "std_fare", "mean_distance", "std_distance"), 4)


def _digits(column):
    """Nine significant digits."""
    return F.format_string("%.8e", column)


@register
def feed_stats_narrow(spark, sf):
    """Values far from zero that differ little: a spread of the last digits."""
    line = b.table(spark, sf, "lineitem")
    rows = line.select(
        F.col("l_returnflag").alias("vehicle_type"),
        (F.lit(1e6) + F.col("l_partkey").cast("double") * 0.001).alias("fare_amount"),
        (F.lit(1e9) + F.col("l_suppkey").cast("double") * 0.5).alias("trip_distance"),
    )
    stats = an.group_stats(rows)
    return stats.select(
        "vehicle_type",
        *[_digits(F.col(c)).alias(c) for c in ("mean_fare", "std_fare", "mean_distance", "std_distance")],
    )


def _flow_rollup(spark, sf):
    return materialised(flows.flow_rollup(b.silver(spark, sf)), "flow-rollup")


@register
def feed_stats_of_rollup(spark, sf):
    """The statistics of the feeds from the rollup that the flows are read from."""
    stats = an.stats_of(flows.feed_moments(_flow_rollup(spark, sf)))
    return _rounded(stats, ("mean_fare", "std_fare", "mean_distance", "std_distance"), 4)


@register
def od_flows_of_rollup(spark, sf):
    return _means(flows.flows_of(_flow_rollup(spark, sf)))


@register
def zone_heatmap_of_rollup(spark, sf):
    return _means(flows.heatmap_of(_flow_rollup(spark, sf)))


def _scored(spark, sf, feeds):
    trips = materialised(b.silver(spark, sf), "trips")
    return an.zscores(trips, feeds=feeds).select(
        "vehicle_type",
        "pickup_ts",
        "pu_location_id",
        "do_location_id",
        "fare_amount",
        "trip_distance",
        shown("fare_zscore", 4).alias("fare_zscore"),
        shown("distance_zscore", 4).alias("distance_zscore"),
    )


@register
def zscores(spark, sf):
    return _scored(spark, sf, b.ALL_FEEDS)


@register
def zscores_any_feed(spark, sf):
    """The same without a list of feeds: the join of the statistics carries no filter."""
    return _scored(spark, sf, None)


def _anomalies(spark, sf, threshold):
    """The silver table is read twice, for the statistics and for the scores: write it once."""
    trips = materialised(b.silver(spark, sf), "trips")
    return an.tag_anomalies(trips, threshold, feeds=b.ALL_FEEDS)


@register
def anomalies(spark, sf):
    return _rounded(_anomalies(spark, sf, 3.0), ("fare_zscore", "distance_zscore"), 4)


@register
def anomalies_low_threshold(spark, sf):
    """Threshold 1.5, so that distance outliers, inversions and equal zones occur too."""
    return _rounded(_anomalies(spark, sf, 1.5), ("fare_zscore", "distance_zscore"), 4)


@register
def anomalies_capped(spark, sf):
    capped = an.cap_anomalies(_anomalies(spark, sf, 1.5), 2_000)
    return _rounded(capped, ("fare_zscore", "distance_zscore"), 4)


@register
def ml_input(spark, sf):
    return models.ml_input(b.silver(spark, sf), fraction=0.5, cap=2_000, feeds=b.APP_FEEDS)


def _model_rows(spark, sf):
    """Every trip with a duration: nothing sampled, nothing cut."""
    return models.ml_input(b.silver(spark, sf), fraction=1.0, cap=None)


@register
def ml_features(spark, sf):
    return models.ml_features(_model_rows(spark, sf))


@register
def ml_split(spark, sf):
    return models.ml_split(_model_rows(spark, sf))


def _model(name: str) -> Query:
    def query(spark, sf):
        return models.fit_and_score(materialised(_model_rows(spark, sf), "model-rows"), name)

    return query


REGISTERED["model_linear"] = _model("LinearRegression")
REGISTERED["model_ridge"] = _model("Ridge")
REGISTERED["model_forest"] = _model("RandomForest")
REGISTERED["model_gbt"] = _model("GradientBoosting")


@register
def model_gradients(spark, sf):
    """The gradient of the linear and the ridge objective at the fitted weights, as a share of
    the sum of its terms: zero for every feature and the intercept, as nothing fits better."""
    rows = materialised(_model_rows(spark, sf), "model-rows")
    found = []
    for name, penalty in (("LinearRegression", 0.0), ("Ridge", models.RIDGE_ALPHA)):
        model, scored = models.fit(rows, name)
        weights = [*model.stages[-1].coefficients.toArray().tolist(), 0.0]
        numbers = [c for c in models.feature_columns(rows) if c != models.CATEGORY]
        names = [*numbers, *model.stages[0].labels, "intercept"]
        rest = F.col(models.TARGET) - F.col("prediction")
        values = F.concat(vector_to_array("features"), F.array(F.lit(1.0)))
        train = scored.filter(~F.col("is_test")).select(rest.alias("r"), values.alias("x"))
        parts = []
        for j, (feature, weight) in enumerate(zip(names, weights, strict=True)):
            term = F.col("r") * F.col("x")[j]
            gradient = F.try_divide(F.sum(term) - F.lit(penalty * weight), F.sum(F.abs(term)))
            share = F.coalesce(F.abs(F.round(gradient, 3)), F.lit(0.0))  # a feature of zeros only
            parts.append(share.alias(feature))
        wide = train.agg(F.count(F.lit(1)).alias("train_rows"), *parts)
        found.append(
            wide.unpivot(["train_rows"], [f"`{n}`" for n in names], "feature", "gradient").withColumn(
                "model", F.lit(name)
            )
        )
    return union_feeds(found)


def _mean_predictor(rows: DataFrame) -> DataFrame:
    """Predicts the mean training duration of the feed and hour."""
    split = models.ml_split(rows)
    known = split.filter(~F.col("is_test"))
    duration = F.col("trip_duration_sec")
    means = known.groupBy("vehicle_type", "pickup_hour").agg(
        mean_of(F.sum(duration.cast("bigint")), F.count(duration)).alias("prediction")
    )
    return split.join(means, ["vehicle_type", "pickup_hour"], "left")


@register
def regression_metrics(spark, sf):
    rows = materialised(_model_rows(spark, sf), "model-rows")
    return models.regression_metrics(_mean_predictor(rows))


@register
def model_comparison(spark, sf):
    return models.compare_models(materialised(_model_rows(spark, sf), "model-rows"))


def _incidents(spark, sf):
    return reference.clean_incidents(b.incidents_raw(spark, sf))


@register
def incidents_by_area_month(spark, sf):
    return incidents.incidents_by_area_month(_incidents(spark, sf))


@register
def incident_trip_join(spark, sf):
    return incidents.incident_trip_join(_incidents(spark, sf), tally(b.silver(spark, sf)))


def _footers(spark, sf):
    files = list_files(spark, rawfiles.write_freight(spark, sf), "*.parquet")
    return with_source(footer_columns(files)).withColumn("feed", F.lit("freight"))


@register
def schema_drift_(spark, sf):
    return schema_drift(_footers(spark, sf))


@register
def schema_files(spark, sf):
    return file_columns(_footers(spark, sf))


@register
def schema_union(spark, sf):
    return union_columns(_footers(spark, sf))


# ---- run metrics ----------------------------------------------------------


@register
def run_metrics(spark, sf):
    """Records of one good step and one that fails."""
    log = StepLog(spark, scratch_path(spark, "steps"))
    with log.track("silver", "count_lineitem", table="lineitem") as step:
        step.rows_read = b.table(spark, sf, "lineitem").count()
    try:
        with log.track("silver", "missing_column"):
            b.table(spark, sf, "orders").select("no_such_column")
    except Exception:
        pass
    log.save()
    return spark.read.parquet(log.path).select("layer", "operation", "status", "rows_read")


@register
def latest_step(spark, sf):
    return steps.latest_steps(b.steps(spark, sf)).drop("extra")


@register
def last_steps(spark, sf):
    return steps.last_steps(b.steps(spark, sf), 8).drop("extra")


@register
def metric_samples(spark, sf):
    return steps.step_samples(steps.latest_steps(b.steps(spark, sf)))


@register
def nonzero_steps(spark, sf):
    samples = steps.step_samples(b.steps(spark, sf))
    written = steps.nonzero(samples, ("rows_written",))
    checks = ("null_rate", "duplicates_removed", "invalid_records")
    return written.unionByName(steps.nonzero(samples, checks, layer="purchase"))


@register
def duration_rollup(spark, sf):
    return steps.duration_rollup(b.steps(spark, sf))


@register
def kpi_samples(spark, sf):
    trips = materialised(b.silver(spark, sf), "trips")
    rolled = from_rollup(materialised(rollup(trips), "rollup"))
    names = ("avg_fare_by_feed", "monthly_trend", "avg_duration")
    made = {name: summarise(rolled, kpis.ROLLED[name]) for name in names}
    side = materialised(side_rollup(trips), "side-rollup")
    made["payment_distribution"] = summarise(side, kpis.SIDE["payment_distribution"])
    made["shared_rate"] = kpis.shared_rate(side, b.APP_FEEDS)
    return steps.kpi_samples(made, b.APP_FEEDS)


@register
def ranked_samples(spark, sf):
    trips = materialised(b.silver(spark, sf), "trips")
    return steps.top_samples(
        kpis.kpi(trips, "top_pickup"), kpis.kpi(trips, "top_dropoff"), flows.top_routes_of(trips)
    )


@register
def lake_samples(spark, sf):
    trips = materialised(b.silver(spark, sf), "trips")
    report = models.regression_metrics(
        _mean_predictor(models.ml_input(trips, fraction=1.0, cap=None))
    )
    tagged = an.tag_anomalies(trips, feeds=b.ALL_FEEDS)
    rolled = materialised(rollup(trips), "rollup")
    side = materialised(side_rollup(trips), "side-rollup")
    # No feed of this name: the table of shared rides is empty and does not count.
    made = kpis.all_kpis(rolled, side, b.weather(spark, sf), ("none",))
    return steps.lake_samples(
        tagged, report, {"kpi": list(made.values()), "lake": [tagged, made["top_pickup"]]}
    )


TABLE_NAMES = {
    "fact_lineitem": "lineitem",
    "fact_orders": "orders",
    "fact_events": "events",
    "dim_customer": "customer",
    "dim_supplier": "supplier",
    "dim_part": "part",
    "dim_nation": "nation",
    "dim_region": "region",
    "text_documents": "documents",
    "text_pages": "pages",
    "text_benchmark": "benchmark",
    "text_labels": "labels",
    "text_conversations": "conversations",
    "vector_embeddings": "embeddings",
}


@register
def table_inventory(spark, sf):
    return steps.table_inventory({k: b.table(spark, sf, v) for k, v in TABLE_NAMES.items()})
