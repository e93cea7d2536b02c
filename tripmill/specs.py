"""Declarations: what a feed looks like and which bounds its rows must meet."""

from __future__ import annotations

from dataclasses import dataclass, field

# Columns and types of a conformed trip, in output order.
TRIP_COLUMNS: dict[str, str] = {
    "vehicle_type": "string",
    "pickup_ts": "timestamp_ntz",
    "dropoff_ts": "timestamp_ntz",
    "pu_location_id": "int",
    "do_location_id": "int",
    "trip_distance": "double",
    "fare_amount": "double",
    "total_amount": "double",
    "payment_type": "int",
    "passenger_count": "double",
    "trip_duration_sec": "int",
    "shared_match_flag": "string",
    "year_month": "string",
    "ingestion_ts": "timestamp_ntz",
    "source_file": "string",
}

# The columns that make two landed rows the same trip.
TRIP_IDENTITY: tuple[str, ...] = (
    "vehicle_type",
    "pickup_ts",
    "dropoff_ts",
    "pu_location_id",
    "do_location_id",
    "fare_amount",
)


@dataclass(frozen=True)
class FeedSpec:
    """Role map of one feed: which raw column plays which part of a trip.

    ``feed_column`` names a raw column holding the feed label where one landing
    carries several feeds, ``labels`` those expected there; others are kept as feeds too.
    Rows without a label, or all without such a column, are labelled ``name``. ``carry``
    lists raw columns kept next to the trip columns until deduplication.
    """

    name: str
    pickup: str
    dropoff: str
    pickup_zone: str
    dropoff_zone: str
    distance: str | None = None
    fares: tuple[str, ...] = ("fare_amount", "base_passenger_fare")
    totals: tuple[str, ...] = ("total_amount", "base_passenger_fare")
    payment: str = "payment_type"
    passengers: str = "passenger_count"
    duration: str = "trip_time"
    shared_flag: str = "shared_match_flag"
    contract: str = ""
    feed_column: str | None = None
    labels: tuple[str, ...] = ()
    carry: tuple[str, ...] = ()
    identity: tuple[str, ...] = TRIP_IDENTITY

    @property
    def feeds(self) -> tuple[str, ...]:
        """Every feed label this spec can produce."""
        return self.labels or (self.name,)


@dataclass(frozen=True)
class QualityBounds:
    """Inclusive limits of a valid trip (fixed default values)."""

    min_zone: int = 1
    max_zone: int = 265
    min_fare: float = 0.0
    max_fare: float = 500.0


@dataclass(frozen=True)
class PeriodFilter:
    """Which landed months take part: a month beats a year beats the first n."""

    month: str | None = None
    year: str | None = None
    first_n: int | None = None


@dataclass(frozen=True)
class LakeOptions:
    """Threshold and limits of the lake analytics.

    Everything is looked at and kept unless the caller asks for less; only the rows that
    the duration model is fitted to are bounded from the start.
    """

    flow_fraction: float = 1.0
    anomaly_fraction: float = 1.0
    model_fraction: float = 1.0
    threshold: float = 3.0
    max_anomalies: int | None = None
    served_rows: int | None = None
    max_model_rows: int = 10_000
    min_model_rows: int = 100
    top_routes: int = 50
    feeds: tuple[str, ...] | None = None
    model_feeds: tuple[str, ...] | None = None

    @staticmethod
    def sample() -> "LakeOptions":
        """A twentieth of the trips for the flows, capped tables for dashboards."""
        return LakeOptions(flow_fraction=0.05, max_anomalies=50_000, served_rows=500)

    @staticmethod
    def light(feed: str = "green", model_feed: str = "fhvhv") -> "LakeOptions":
        """One feed with nothing sampled, and the one with durations for the model."""
        return LakeOptions(feeds=(feed,), model_feeds=(model_feed,))


@dataclass(frozen=True)
class RunOptions:
    """Everything a layer run needs besides its tables."""

    feeds: tuple[FeedSpec, ...]
    bounds: QualityBounds = QualityBounds()
    periods: PeriodFilter = PeriodFilter()
    lake: LakeOptions = field(default_factory=LakeOptions)
    shared_rate_feed: str = "fhvhv"

    @staticmethod
    def sample(feeds: tuple[FeedSpec, ...], months: int = 2) -> "RunOptions":
        """The first months of each feed."""
        return RunOptions(feeds, periods=PeriodFilter(first_n=months), lake=LakeOptions.sample())

    @staticmethod
    def light(feeds: tuple[FeedSpec, ...]) -> "RunOptions":
        """The first month of each feed and one feed in the lake analytics."""
        return RunOptions(feeds, periods=PeriodFilter(first_n=1), lake=LakeOptions.light())
