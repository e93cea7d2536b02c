"""Arithmetic on columns that does not depend on the order of rows.

Adding doubles gives last digits that depend on the order in which tasks finish.
Money and distance are therefore added as wide decimals, which hold every amount
with eight decimals, and divided once at the end: every run, every retry and every
pre-aggregated table gives the same bits. What no decimal holds (infinity, NaN,
amounts past ``EXACT_TYPE``) counts as unknown and stops nothing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = 4
#: A single amount; sums of it are DECIMAL(38, 8), so 10^10 rows of the largest still fit.
EXACT_TYPE = "decimal(28,8)"


def exact(value: Column, kind: str = EXACT_TYPE) -> Column:
    """``value`` as a decimal; null where it does not fit."""
    return value.try_cast(kind)


def fixed_point(value: Column, digits: int = DIGITS) -> Column:
    """``value`` as a BIGINT count of ``10**-digits`` units, half up; NaN gives null."""
    scaled = value.cast("double") * F.lit(float(10**digits)) + F.lit(0.5)
    return F.when(~F.isnan(scaled), F.floor(scaled))


def rounded(value: Column, digits: int) -> Column:
    """``value`` rounded half up to ``digits`` decimals, as a double."""
    return fixed_point(value, digits) / F.lit(float(10**digits))


def mean_of(total: Column, n: Column) -> Column:
    """Mean from an exact total and its number of values, as a double; null for none."""
    return F.try_divide(total.cast("double"), n.cast("double"))
