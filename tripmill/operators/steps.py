"""Step records and gauges as tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.functions.numbers import fixed_point, rounded
from tripmill.functions.ordering import by
from tripmill.operators.topn import top_n

STEP_SCHEMA = """
    layer string, operation string, status string, rows_read bigint, rows_written bigint,
    duration_ms double, null_rate double, duplicates_removed bigint, invalid_records bigint,
    extra map<string,string>, timestamp timestamp_ntz, sequence bigint
"""

# Numbers of a step record that become gauges, and their prefix.
STEP_GAUGES = (
    "rows_read",
    "rows_written",
    "duration_ms",
    "null_rate",
    "duplicates_removed",
    "invalid_records",
)
STEP_PREFIX = "pipeline_"


def latest_steps(steps: DataFrame) -> DataFrame:
    """The newest record per layer and operation; of equal times the later one."""
    newest = Window.partitionBy("layer", "operation").orderBy(*by("-timestamp", "-sequence"))
    return steps.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def last_steps(steps: DataFrame, n: int = 5) -> DataFrame:
    return top_n(steps, by("-timestamp", "-sequence"), n)


def duration_rollup(steps: DataFrame) -> DataFrame:
    """Total duration per operation, per layer (operation null) and overall (both null)."""
    total = F.sum(fixed_point(F.col("duration_ms"))) / F.lit(1e4)
    return steps.rollup("layer", "operation").agg(
        total.alias("duration_ms"), F.count(F.lit(1)).alias("steps")
    )


def label_text(labels: Mapping[str, Column]) -> Column:
    """``name="value"`` pairs; double quotes in values become single, null is ``unknown``."""
    pairs = [
        F.concat(
            F.lit(f'{name}="'),
            F.coalesce(F.replace(value.cast("string"), F.lit('"'), F.lit("'")), F.lit("unknown")),
            F.lit('"'),
        )
        for name, value in labels.items()
    ]
    return F.concat_ws(",", *pairs)


def gauge(
    df: DataFrame, name: str, labels: Mapping[str, str], value: str, digits: int | None = None
) -> DataFrame:
    """One column of a table as gauge samples; rows without a value give none."""
    number = F.col(value).cast("double")
    return df.filter(F.col(value).isNotNull()).select(
        F.lit(name).alias("name"),
        label_text({label: F.col(column) for label, column in labels.items()}).alias("labels"),
        (number if digits is None else rounded(number, digits)).alias("value"),
    )


# The gauge names and labels of the functions below.


def step_samples(steps: DataFrame) -> DataFrame:
    """Six gauges per step record."""
    labels = label_text({c: F.col(c) for c in ("layer", "operation", "status")})
    wide = steps.select(
        "layer", labels.alias("labels"), *[F.col(g).cast("double").alias(g) for g in STEP_GAUGES]
    )
    return wide.unpivot(["layer", "labels"], list(STEP_GAUGES), "gauge", "value").select(
        F.concat(F.lit(STEP_PREFIX), "gauge").alias("name"), "layer", "labels", "value"
    )


def nonzero(samples: DataFrame, gauges: Sequence[str], layer: str | None = None) -> DataFrame:
    """Samples above zero of the given gauges, of one layer or of all."""
    names = [STEP_PREFIX + g for g in gauges]
    chosen = samples.filter(F.col("name").isin(*names) & (F.col("value") > 0))
    return chosen if layer is None else chosen.filter(F.col("layer") == layer)


def kpi_samples(tables: Mapping[str, DataFrame], feeds: Sequence[str]) -> DataFrame:
    """Gauges of the KPI tables; duration and share rate for the given feeds only."""
    feed = {"vehicle_type": "vehicle_type"}
    month = {**feed, "year_month": "year_month"}
    chosen = F.col("vehicle_type").isin(*feeds)
    durations, shares = tables["avg_duration"].filter(chosen), tables["shared_rate"].filter(chosen)
    payment = {**feed, "payment_type": "payment_type"}
    parts = [
        gauge(tables["avg_fare_by_feed"], "taxi_avg_fare", feed, "avg_fare", 4),
        gauge(tables["avg_fare_by_feed"], "taxi_trips_total", feed, "trip_count"),
        gauge(tables["monthly_trend"], "taxi_monthly_trips", month, "trip_count"),
        gauge(tables["monthly_trend"], "taxi_monthly_avg_fare", month, "avg_fare", 4),
        gauge(tables["payment_distribution"], "taxi_payment_trips", payment, "trip_count"),
        gauge(durations, "taxi_avg_duration_sec", feed, "avg_duration_sec", 2),
        gauge(shares, "taxi_shared_ride_rate", feed, "shared_rate", 4),
    ]
    return reduce(DataFrame.unionByName, parts)


def ranked_samples(
    df: DataFrame, name: str, labels: Mapping[str, str], n: int, ties: Sequence[str] = ()
) -> DataFrame:
    """The ``n`` rows with most trips as gauges with their rank."""
    order = by("-trip_count", *(ties or [c for c in df.columns if c != "trip_count"]))
    first = top_n(df, order, n)
    # At most n rows are left, so numbering them in one task is bounded.
    ranked = first.withColumn("_place", F.row_number().over(Window.orderBy(*order)))
    return gauge(ranked, name, {"rank": "_place", **labels}, "trip_count")


def top_samples(
    top_pickup: DataFrame, top_dropoff: DataFrame, top_routes: DataFrame
) -> DataFrame:
    """Top 10 pickup zones, top 10 dropoff zones and top 15 routes as ranked gauges."""
    return reduce(
        DataFrame.unionByName,
        [
            ranked_samples(
                top_pickup, "taxi_top_pickup", {"zone": "pu_zone_name", "borough": "pu_borough"}, 10
            ),
            ranked_samples(
                top_dropoff,
                "taxi_top_dropoff",
                {"zone": "do_zone_name", "borough": "do_borough"},
                10,
            ),
            ranked_samples(
                top_routes,
                "lake_top_route",
                {"from_zone": "pu_zone_name", "to_zone": "do_zone_name"},
                15,
            ),
        ],
    )


def lake_samples(
    anomalies: DataFrame, report: DataFrame | None, tables: Mapping[str, Sequence[DataFrame]]
) -> DataFrame:
    """All anomalies counted, model quality, and the tables per kind that hold any row."""
    count = anomalies.agg(F.count(F.lit(1)).alias("n"))
    parts = [gauge(count, "lake_anomaly_trips_total", {}, "n")]
    for kind, members in tables.items():
        filled = [df.limit(1).select(F.lit(1).alias("n")) for df in members]
        none = count.select("n").limit(0)
        n = reduce(DataFrame.unionAll, filled, none).agg(F.count("n").alias("n"))
        parts.append(gauge(n, f"serving_{kind}_tables", {}, "n"))
    if report is not None:
        parts.append(gauge(report, "lake_ml_mae_seconds", {}, "mae_seconds", 2))
        parts.append(gauge(report, "lake_ml_r2_score", {}, "r2_score", 4))
    return reduce(DataFrame.unionByName, parts)


def table_inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, and tables and rows per name prefix (table null) and overall (both null)."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name.split("_")[0]).alias("prefix"), F.lit(name).alias("table_name"), "n"
        )
        for name, df in tables.items()
    ]
    return (
        reduce(DataFrame.unionByName, counts)
        .rollup("prefix", "table_name")
        .agg(F.sum("n").alias("row_count"), F.count(F.lit(1)).alias("tables"))
    )
