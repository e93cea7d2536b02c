"""Bronze, silver, gold and lake runs. Layers meet only in their tables."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.functions.hashing import SAMPLE, below_fraction, key_hash
from tripmill.operators.anomalies import (
    cap_anomalies,
    far_out,
    group_stats,
    stats_of,
    tag_anomalies,
    zscores,
)
from tripmill.operators.conform import (
    add_time_parts,
    conform,
    feed_label,
    only_feeds,
    union_feeds,
)
from tripmill.operators.drift import file_columns, schema_drift, union_columns
from tripmill.operators.flows import (
    feed_moments,
    flow_rollup,
    flows_of,
    hash_sample,
    heatmap_of,
    top_routes,
)
from tripmill.operators.incidents import incident_trip_join
from tripmill.operators.kpis import all_kpis
from tripmill.operators.models import fit_and_score, ml_input
from tripmill.operators.quality import KEPT, REJECTED, VERDICT_PARTITIONS, judge, report_of_parts
from tripmill.operators.serving import KPI_KEYS, LAKE_KEYS, capped
from tripmill.operators.steps import (
    duration_rollup,
    kpi_samples,
    lake_samples,
    latest_steps,
    step_samples,
    table_inventory,
    top_samples,
)
from tripmill.operators.tally import rollup, side_rollup
from tripmill.operators.zones import add_zones, unique_zones
from tripmill.plans.reuse import written
from tripmill.plans.steplog import StepLog
from tripmill.sources.files import file_manifest, footer_columns, list_files, with_source
from tripmill.sources.landing import land_feed
from tripmill.sources.reference import (
    covering_range,
    default_areas,
    default_calendar,
    default_incidents,
    read_dimension,
    read_incidents,
    read_weather,
    with_origin,
)
from tripmill.sources.tables import (
    if_found,
    read_feeds,
    read_if_exists,
    write_compact,
    write_partitions,
    write_sorted,
    write_table,
)
from tripmill.specs import TRIP_IDENTITY, FeedSpec, RunOptions

LAYERS = ("bronze", "silver", "gold", "lake")
# Tables that are a part of another one.
PARTS = {
    ("silver", "trips"): f"judged/verdict={KEPT}",
    ("silver", "rejected_trips"): f"judged/verdict={REJECTED}",
}


@dataclass(frozen=True)
class RawSources:
    """Where raw inputs lie. Weather, incidents and images may be absent."""

    feeds: dict[str, str]
    zones: str
    weather: str | None = None
    incidents: str | None = None
    images: str | None = None
    incident_lines: bool = False


@dataclass
class Pipeline:
    """One run over one set of tables below ``base``."""

    spark: SparkSession
    base: str
    sources: RawSources
    options: RunOptions
    log: StepLog = field(init=False)
    # The report of this run's model; an earlier one is not served as current.
    model_report: DataFrame | None = field(init=False, default=None)

    def __post_init__(self) -> None:
        self.log = StepLog(self.spark, self.path("metrics", "steps"))

    def path(self, layer: str, name: str) -> str:
        return f"{self.base}/{layer}/{PARTS.get((layer, name), name)}"

    def read(self, layer: str, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(layer, name))

    def rows(self, layer: str, name: str) -> int:
        """Rows of a written table; Spark answers this from the file footers."""
        return self.read(layer, name).count()

    def write(
        self,
        df: DataFrame,
        layer: str,
        name: str,
        compact: bool = False,
        read: int | None = None,
        **extra: object,
    ) -> DataFrame:
        """Write a table under a step record and hand back the table as written.

        ``read`` are the rows it was made from; without, each row was read to be written.
        """
        with self.log.track(layer, name, **extra) as step:
            (write_compact if compact else write_table)(df, self.path(layer, name))
            step.rows_written = self.rows(layer, name)
            step.rows_read = step.rows_written if read is None else read
        return self.read(layer, name)

    def run(self, layers: Iterable[str] = LAYERS) -> "Pipeline":
        """Run the given layers in order; step records are saved even when one fails."""
        steps = {"bronze": self.bronze, "silver": self.silver, "gold": self.gold, "lake": self.lake}
        try:
            for layer in layers:
                steps[layer]()
        finally:
            self.log.save()
            self.serve_steps()
        return self

    def serve_steps(self) -> None:
        """Gauges of the latest steps, durations, and the rows of every table there is."""
        steps = read_if_exists(self.spark, self.log.path)
        if steps is None:
            return
        write_table(step_samples(latest_steps(steps)), self.path("serving", "step_samples"))
        write_table(duration_rollup(steps), self.path("serving", "step_durations"))
        names = {s.operation for s in self.log.steps if s.layer in LAYERS}
        tables = {
            f"{layer}_{name}": table
            for layer in LAYERS
            for name in sorted(names | {"trips"})
            if (table := read_if_exists(self.spark, self.path(layer, name))) is not None
        }
        if tables:
            write_table(table_inventory(tables), self.path("serving", "table_inventory"))

    # ---- bronze -------------------------------------------------------------

    def bronze(self) -> None:
        spark, sources = self.spark, self.sources
        zones = with_origin(read_dimension(spark, sources.zones), sources.zones)
        self.write(zones, "bronze", "zones")
        if sources.images:
            prefix = "taxi_zone_map_"  # fixed value: image names carry it before the borough
            manifest = file_manifest(spark, sources.images, "*.jpg", prefix)
            self.write(with_origin(manifest, sources.images), "bronze", "images")
        for spec in self.options.feeds:
            if spec.name in sources.feeds:
                self.land(spec)
        weather = incidents = None
        if sources.weather:
            weather = if_found(lambda: read_weather(spark, sources.weather))
        absent = weather is None
        if absent:
            landed = if_found(lambda: read_feeds(spark, self.path("bronze", "trips")))
            if landed is None:  # no trips either: the range of the default days
                landed = spark.createDataFrame([], "year_month string")
            weather = default_calendar(covering_range(landed, self.options.periods))
        origin = "default" if absent else sources.weather
        self.write(with_origin(weather, origin, absent), "bronze", "weather", default=absent)
        if sources.incidents:
            lines = sources.incident_lines
            incidents = if_found(lambda: read_incidents(spark, sources.incidents, lines=lines))
        absent = incidents is None
        if absent:
            incidents = default_incidents(default_areas(spark))
        origin = "default" if absent else sources.incidents
        self.write(with_origin(incidents, origin, absent), "bronze", "incidents", default=absent)

    def land(self, spec: FeedSpec) -> None:
        with self.log.track("bronze", f"land_{spec.name}", feed=spec.name) as step:
            root = self.sources.feeds[spec.name]
            landed = if_found(lambda: land_feed(self.spark, root, spec, self.options.periods))
            if landed is None:
                step.extra["skipped"] = "no input files"
                return
            own = F.col(spec.feed_column) if spec.feed_column else F.lit(None)
            # Raw files lie by month already: land them without an exchange.
            landed = landed.withColumn("vehicle_type", feed_label(own.cast("string"), spec))
            write_partitions(landed, self.landing_path(spec), gather=False)
            step.rows_written = self.landed(spec).count()
            step.rows_read = step.rows_written  # landing keeps every row

    def landing_path(self, spec: FeedSpec) -> str:
        """Every spec lands in a partition of its own, so whatever labels its rows carry,
        none is lost to a list of names."""
        return self.path("bronze", f"trips/spec={spec.name}")

    def landed(self, spec: FeedSpec) -> DataFrame | None:
        """All landed rows of a spec, or None."""
        return if_found(lambda: read_feeds(self.spark, self.landing_path(spec)))

    # ---- silver -------------------------------------------------------------

    def silver(self) -> None:
        bounds = self.options.bounds
        found = [(spec, self.landed(spec)) for spec in self.options.feeds]
        conformed = [(spec, conform(raw, spec)) for spec, raw in found if raw is not None]
        if not conformed:
            return
        zones = self.read("bronze", "zones")
        with self.log.track("silver", "trips") as step:
            step.extra["zones_repeated"] = str(zones.count() - unique_zones(zones).count())
            # One pass over bronze: rejected rows are written beside the kept ones.
            judged = [
                judge(df, bounds, spec.identity, drop=spec.carry) for spec, df in conformed
            ]
            trips = add_time_parts(add_zones(union_feeds(judged), zones))
            write_partitions(trips, self.path("silver", "judged"), VERDICT_PARTITIONS, whole=True)
            step.rows_written = self.rows("silver", "trips")
            step.rows_read = sum(raw.count() for _, raw in found if raw is not None)
        landed = union_feeds([raw.select("vehicle_type") for _, raw in found if raw is not None])
        rejected = read_if_exists(self.spark, self.path("silver", "rejected_trips"))
        report = report_of_parts(landed, rejected, self.read("silver", "trips"))
        for row in self.write(report, "silver", "quality_report").toLocalIterator():
            with self.log.track("silver", f"quality_{row['vehicle_type']}") as step:
                step.rows_read, step.rows_written = row["rows_read"], row["rows_kept"]
                step.null_rate = row["null_rate"]
                step.invalid_records = row["invalid_records"]
                step.duplicates_removed = row["duplicates_removed"]

    # ---- gold ---------------------------------------------------------------

    def gold(self) -> None:
        trips = self.read("silver", "trips")
        n = self.rows("silver", "trips")
        rolled = self.write(rollup(trips), "gold", "trip_rollup", read=n)
        shared = (self.options.shared_rate_feed,)
        side = self.write(side_rollup(trips), "gold", "side_rollup", read=n)
        tables = all_kpis(rolled, side, self.read("bronze", "weather"), shared)
        groups = self.rows("gold", "trip_rollup")
        written = {
            name: self.write(df, "gold", f"kpi_{name}", read=groups) for name, df in tables.items()
        }
        for name, df in written.items():
            write_sorted(df, self.path("serving", f"kpi_{name}"), KPI_KEYS[name])
        self.write(kpi_samples(written, shared), "serving", "kpi_samples")

    # ---- lake ---------------------------------------------------------------

    def lake(self) -> None:
        """Two scans of silver: one adds trips up, one looks at single trips."""
        silver = self.read("silver", "trips")
        stats = self.flows(silver)
        self.single_trips(silver, stats)
        rolled = only_feeds(self.read("gold", "trip_rollup"), self.options.lake.feeds)
        incidents = read_if_exists(self.spark, self.path("bronze", "incidents"))
        if incidents is not None:
            joined = incident_trip_join(incidents, rolled)
            self.write(joined, "lake", "incident_correlation")
        self.drift()
        self.serve_lake()

    def flows(self, silver: DataFrame) -> DataFrame:
        """Flows, heatmap and routes; hands back the statistics of the feeds."""
        lake, n = self.options.lake, self.rows("silver", "trips")
        share = lake.flow_fraction
        trips = only_feeds(silver, lake.feeds)
        rollup_of = flow_rollup(hash_sample(trips, share))
        rolled = self.write(rollup_of, "lake", "flow_rollup", read=n, fraction=share)
        groups = self.rows("lake", "flow_rollup")
        flows = self.write(flows_of(rolled), "lake", "od_flows", read=groups, fraction=share)
        self.write(heatmap_of(rolled), "lake", "zone_heatmap", read=groups, fraction=share)
        self.write(top_routes(flows, lake.top_routes), "lake", "top_routes", fraction=share)
        if lake.anomaly_fraction == share:
            return stats_of(feed_moments(rolled))
        # Another share of the trips is looked at for anomalies: its own statistics, its own scan.
        return group_stats(hash_sample(trips, lake.anomaly_fraction))

    def single_trips(self, silver: DataFrame, stats: DataFrame) -> None:
        """Anomalies and the rows of the model, picked from silver in one scan."""
        lake, n = self.options.lake, self.rows("silver", "trips")
        share, feeds = lake.anomaly_fraction, lake.model_feeds or lake.feeds
        enough = self.model_share(only_feeds(silver, feeds).count())
        with written(self.picked(silver, stats, enough), "picked") as found:
            looked_at = hash_sample(only_feeds(found, lake.feeds), share)
            tagged = tag_anomalies(looked_at, lake.threshold, stats)
            anomalies = cap_anomalies(tagged, lake.max_anomalies)
            cap = "none" if lake.max_anomalies is None else lake.max_anomalies
            extra = {"fraction": share, "cap": cap}
            self.write(anomalies, "lake", "anomaly_trips", compact=True, read=n, **extra)
            self.duration_model(found, silver, enough)

    def model_share(self, rows: int) -> float:
        """The share of trips, by hash, that holds the model's rows many times over."""
        lake = self.options.lake
        if lake.max_model_rows is None or not rows:
            return lake.model_fraction
        return min(lake.model_fraction, 20 * lake.max_model_rows / rows)

    def picked(self, silver: DataFrame, stats: DataFrame, enough: float) -> DataFrame:
        """Trips that are an anomaly or may be rows of the model, as they are in silver."""
        lake = self.options.lake

        def among(feeds: Iterable[str] | None) -> Column:
            return F.lit(True) if feeds is None else F.col("vehicle_type").isin(*feeds)

        hashed = key_hash(silver, TRIP_IDENTITY, SAMPLE)
        odd = far_out(lake.threshold) & below_fraction(hashed, lake.anomaly_fraction)
        model = below_fraction(hashed, enough) & (F.col("trip_duration_sec") > 0)
        wanted = (among(lake.feeds) & odd) | (among(lake.model_feeds or lake.feeds) & model)
        return zscores(silver, stats).filter(wanted).select(*silver.columns)

    def duration_model(self, found: DataFrame, silver: DataFrame, enough: float) -> None:
        """Fit to the trips of lowest hash; ``found`` has all trips below the share ``enough``."""
        lake = self.options.lake
        feeds = lake.model_feeds or lake.feeds
        rows = self.write(ml_input(found, enough, lake.max_model_rows, feeds), "lake", "model_rows")
        if enough < lake.model_fraction and rows.count() < lake.max_model_rows:
            # Fewer trips with a duration than their share: all of silver after all.
            chosen = ml_input(silver, lake.model_fraction, lake.max_model_rows, feeds)
            rows = self.write(chosen, "lake", "model_rows")
        with self.log.track("lake", "duration_model") as step:
            step.rows_read = rows.count()
            if step.rows_read < lake.min_model_rows:
                step.extra["skipped"] = "insufficient_rows"
                return
            report = fit_and_score(rows, "GradientBoosting")
            write_table(report, self.path("lake", "duration_model"))
            step.rows_written = 1
            self.model_report = self.read("lake", "duration_model")

    def drift(self) -> None:
        listed = [
            with_source(footer_columns(list_files(self.spark, root, "*.parquet"))).withColumn(
                "feed", F.lit(feed)
            )
            for feed, root in self.sources.feeds.items()
        ]
        if listed:
            columns = union_feeds(listed)
            self.write(schema_drift(columns), "lake", "schema_drift")
            self.write(file_columns(columns), "lake", "schema_files")
            self.write(union_columns(columns), "lake", "schema_union")

    def serve_lake(self) -> None:
        served, rows = [], self.options.lake.served_rows
        for name, keys in LAKE_KEYS.items():
            table = read_if_exists(self.spark, self.path("lake", name))
            if name == "duration_model":
                table = self.model_report
            if table is not None:
                path = self.path("serving", f"lake_{name}")
                write_sorted(capped(table, keys, rows), path, keys)
                served.append(self.spark.read.parquet(path))
        kpis = [read_if_exists(self.spark, self.path("serving", f"kpi_{k}")) for k in KPI_KEYS]
        gauges = lake_samples(
            self.read("lake", "anomaly_trips"),
            self.model_report,
            {"kpi": [k for k in kpis if k is not None], "lake": served},
        )
        tops = top_samples(
            self.read("gold", "kpi_top_pickup"),
            self.read("gold", "kpi_top_dropoff"),
            self.read("lake", "top_routes"),
        )
        self.write(gauges.unionByName(tops), "serving", "lake_samples")
