"""Origin-destination flows, pickup heatmap and top routes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.functions.hashing import SAMPLE, below_fraction, key_hash
from tripmill.functions.moments import PARTS, merged, moment_columns
from tripmill.functions.ordering import by
from tripmill.operators.anomalies import LOOKED_AT
from tripmill.operators.tally import DO, PU, Summary, summarise, tally
from tripmill.operators.topn import top_n
from tripmill.specs import TRIP_IDENTITY

AVERAGES = {"avg_fare": "fare", "avg_distance": "distance"}

OD_KEYS = ("vehicle_type", *PU, *DO, "pickup_hour")
HEAT_KEYS = ("vehicle_type", *PU, "pickup_hour")
_MOMENTS = {f"moment_{k}": c for k, c in LOOKED_AT.items()}

# The columns of a top route.
ROUTE_COLUMNS = (
    "vehicle_type",
    "pu_zone_name",
    "pu_borough",
    "do_zone_name",
    "do_borough",
    "trip_count",
    "avg_fare",
    "avg_distance",
)


def hash_sample(
    trips: DataFrame, fraction: float, keys: Sequence[str] = TRIP_IDENTITY
) -> DataFrame:
    """The share of trips whose key hash is small. Smaller shares are subsets of larger ones."""
    if fraction >= 1.0:
        return trips
    return trips.filter(below_fraction(key_hash(trips, keys, SAMPLE), fraction))


def flow_rollup(trips: DataFrame) -> DataFrame:
    """Trips added up per feed, zone pair and hour: flows, heatmap, routes and the mean and
    spread of every feed are read from it, so the trips themselves are scanned once.

    Its size is bounded by feeds, zones and hours, whatever the number of trips. Groups
    with an unknown zone are kept; the flows leave them out.
    """
    totals = ("trip_count", *(f"{m}_{p}" for m in AVERAGES.values() for p in ("sum", "n")))
    tallied = tally(trips).withColumns(
        {f"moment_{k}": v for k, v in moment_columns(LOOKED_AT).items()}
    )
    return tallied.groupBy(*OD_KEYS).agg(
        *[F.try_sum(name).alias(name) for name in totals], *merged(_MOMENTS)
    )


def feed_moments(rolled: DataFrame) -> DataFrame:
    """The moment columns of a rollup under the names the statistics expect."""
    names = [f"{k}_{p}" for k in LOOKED_AT for p in PARTS]
    return rolled.select("vehicle_type", *[F.col(f"moment_{n}").alias(n) for n in names])


def flows_of(rolled: DataFrame) -> DataFrame:
    """``od_flows`` from the rollup, the same digits."""
    return _averaged(rolled, OD_KEYS)


def heatmap_of(rolled: DataFrame) -> DataFrame:
    """``zone_heatmap`` from the rollup, the same digits."""
    order = ("-trip_count", *HEAT_KEYS)
    return summarise(rolled, Summary(keys=HEAT_KEYS, means=AVERAGES, order=order))


def _averaged(tallied: DataFrame, keys: Sequence[str]) -> DataFrame:
    both = F.col("pu_location_id").isNotNull() & F.col("do_location_id").isNotNull()
    return summarise(tallied.filter(both), Summary(keys=keys, means=AVERAGES))


def _flows(trips: DataFrame) -> DataFrame:
    return _averaged(tally(trips), OD_KEYS)


def od_flows(trips: DataFrame) -> DataFrame:
    """Trips, mean fare and mean distance per feed, zone pair and hour.

    In no order: the written table is ranked by its readers, which saves an exchange here.
    """
    return _flows(trips)


def zone_heatmap(trips: DataFrame) -> DataFrame:
    """The same measures per feed, pickup zone and hour; busiest first."""
    return heatmap_of(tally(trips))


def top_routes(flows: DataFrame, n: int = 50) -> DataFrame:
    """The busiest zone pairs. Each hour ranks by itself, so a pair may appear twice."""
    return top_n(flows, by("-trip_count", *OD_KEYS), n).select(*ROUTE_COLUMNS)


def top_routes_of(trips: DataFrame, n: int = 50) -> DataFrame:
    return top_routes(_flows(trips), n)
