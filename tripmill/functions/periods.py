"""Months in names, source names and date parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_PERIOD = "unknown"  # fixed value
PERIOD_PATTERN = r"\d{4}-\d{2}"  # fixed value


def period_of(name: Column) -> Column:
    """The first ``yyyy-MM`` inside a name, else ``unknown``."""
    found = F.regexp_extract(name, PERIOD_PATTERN, 0)
    return F.when(found == "", F.lit(UNKNOWN_PERIOD)).otherwise(
        F.coalesce(found, F.lit(UNKNOWN_PERIOD))
    )


def source_name(path: Column) -> Column:
    """File name of a path, or the directory name where a writer split it in parts."""
    steps = F.split(path, "/")
    name = F.element_at(steps, -1)
    return F.when(name.startswith("part-"), F.element_at(steps, -2)).otherwise(name)


def month_of(ts: Column) -> Column:
    """``yyyy-MM`` of a time, whatever the session zone."""
    return F.substring(F.to_date(ts).cast("string"), 1, 7)


def first_day(period: Column) -> Column:
    """First day of a ``yyyy-MM`` period; null where the text is no period."""
    return F.concat(period, F.lit("-01")).try_cast("date")
