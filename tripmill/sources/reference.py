"""Zone dimension, daily weather and incident records."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmill.functions.periods import first_day, month_of
from tripmill.specs import PeriodFilter

ZONE_SCHEMA = "LocationID int, Borough string, Zone string, service_zone string"

# Payload array -> output column, default day, default range.
WEATHER_FIELDS: dict[str, str] = {
    "temperature_2m_max": "temp_max",
    "temperature_2m_min": "temp_min",
    "precipitation_sum": "precipitation_sum",
    "weathercode": "weather_code",
}
DEFAULT_DAY: dict[str, float | int] = {
    "temp_max": 22.0,
    "temp_min": 12.0,
    "precipitation_sum": 0.0,
    "weather_code": 0,
}
DEFAULT_RANGE = ("2025-04-01", "2025-05-31")
PAYLOAD_SCHEMA = """
    daily struct<time: array<string>, temperature_2m_max: array<double>,
    temperature_2m_min: array<double>, precipitation_sum: array<double>,
    weathercode: array<int>>
"""

# Default incident records.
DEFAULT_AREAS = ("MANHATTAN", "BROOKLYN", "QUEENS", "BRONX", "STATEN ISLAND")
DEFAULT_CRASH_DATE = "2025-04-01T00:00:00.000"
DEFAULT_INJURED = "1"
INCIDENT_SCHEMA = "borough string, crash_date string, number_of_persons_injured string"


def read_dimension(spark: SparkSession, path: str, schema: str = ZONE_SCHEMA) -> DataFrame:
    """A CSV dimension with a header, in declared types."""
    return (
        spark.read.schema(schema)
        .option("header", "true")
        .option("enforceSchema", "false")
        .csv(path)
    )


def covering_range(
    landed: DataFrame, periods: PeriodFilter = PeriodFilter(), column: str = "year_month"
) -> DataFrame:
    """First day of the first month and last day of the last month, as one row.

    Limited to the chosen month or year; the fixed default range where no row
    carries a month.
    """
    month = F.col(column)
    if periods.month:
        landed = landed.filter(month == periods.month)
    elif periods.year:
        landed = landed.filter(month.startswith(f"{periods.year}-"))
    day = first_day(month)
    start, end = (F.lit(d).cast("date") for d in DEFAULT_RANGE)
    return landed.agg(
        F.coalesce(F.min(day), start).alias("start_date"),
        F.coalesce(F.last_day(F.max(day)), end).alias("end_date"),
    )


def default_calendar(
    days: DataFrame, defaults: Mapping[str, float | int] = DEFAULT_DAY
) -> DataFrame:
    """One row per day of the range with constant values."""
    every = F.explode(F.sequence("start_date", "end_date", F.expr("interval 1 day")))
    return days.select(every.alias("date")).withColumns(
        {name: F.lit(value) for name, value in defaults.items()}
    )


def fill_days(weather: DataFrame, calendar: DataFrame) -> DataFrame:
    """The calendar with every known value in place of its default."""
    given = weather.select("date", *[F.col(c).alias(f"_{c}") for c in calendar.columns[1:]])
    return calendar.join(given, "date", "left").select(
        "date",
        *[
            F.coalesce(F.col(f"_{c}").cast(kind), F.col(c)).alias(c)
            for c, kind in calendar.dtypes[1:]
        ],
    )


def daily_rows(
    payloads: DataFrame,
    column: str = "value",
    schema: str = PAYLOAD_SCHEMA,
    fields: Mapping[str, str] = WEATHER_FIELDS,
) -> DataFrame:
    """JSON payloads with parallel arrays per day to one row per day.

    Days are those of the ``time`` array; a short or absent array gives nulls.
    """
    parsed = payloads.select(F.from_json(column, schema).alias("p"))
    arrays = [
        F.coalesce(F.col(f"p.daily.{name}"), F.array()).alias(name) for name in ("time", *fields)
    ]
    zipped = parsed.select(*arrays).select(F.inline(F.arrays_zip("time", *fields)))
    return zipped.filter(F.col("time").isNotNull()).select(
        F.to_date("time").alias("date"),
        *[F.col(name).alias(alias) for name, alias in fields.items()],
    )


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """Daily weather from payload files, one payload a file."""
    return daily_rows(spark.read.text(path, wholetext=True))


def with_origin(table: DataFrame, source: str, default: bool = False) -> DataFrame:
    """Where the rows of a bronze table are from, when they were landed, and whether they
    stand in for a source that was not there."""
    now = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    return table.withColumns(
        {
            "_ingestion_ts": F.lit(now).cast("timestamp_ntz"),
            "_source_file": F.lit(source),
            "_is_default": F.lit(default),
        }
    )


def clean_incidents(records: DataFrame) -> DataFrame:
    """Parsed time, trimmed upper-case borough and month; unreadable times are null."""
    return records.withColumns(
        {
            "borough": F.upper(F.trim("borough")),
            "crash_ts": F.col("crash_date").try_cast("timestamp_ntz"),
        }
    ).withColumn("crash_month", month_of(F.col("crash_ts")))


def read_incidents(
    spark: SparkSession, path: str, schema: str = INCIDENT_SCHEMA, lines: bool = False
) -> DataFrame:
    """Incident records from JSON arrays (a file is one task), or from JSON lines (split).

    Every field stays: those of ``schema`` in their declared type, null where a record
    lacks them, others as text.
    """
    reader = spark.read.option("multiLine", not lines).option("primitivesAsString", "true")
    records = reader.json(path)
    missing = [f for f in StructType.fromDDL(schema).fields if f.name not in records.columns]
    filled = records.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in StructType.fromDDL(schema).fields}
    return clean_incidents(filled.withColumns(typed))


def default_areas(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(a,) for a in DEFAULT_AREAS], "borough string")


def default_incidents(
    areas: DataFrame,
    crash_date: str | date = DEFAULT_CRASH_DATE,
    injured: str = DEFAULT_INJURED,
) -> DataFrame:
    """One incident per area for when no incident source is there."""
    return clean_incidents(
        areas.select("borough")
        .distinct()
        .withColumns(
            {
                "crash_date": F.lit(str(crash_date)),
                "number_of_persons_injured": F.lit(injured),
            }
        )
    )
