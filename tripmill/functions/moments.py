"""Mean and spread from exact sums that can be added up again.

Subtracting large sums of squares from each other leaves nothing of a narrow spread. Here
a value is a whole part and a fraction of twelve digits, and their sums, squares and
products are added as wide decimals. A centre close to the mean is then taken out of the
sums in decimals, where no digit is lost, and only the small rest becomes a double. The
parts are plain columns: a rollup that adds them up at any grain and in any order gives the
same bits, and what no decimal holds (infinity, NaN, 10^13 and more) counts as unknown.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Values as they are added up, and what they are added up to.
VALUE_TYPE = "decimal(25,12)"
PARTS = ("n", "hi", "lo", "hi_hi", "hi_lo", "lo_lo")


def parts_of(value: Column) -> dict[str, Column]:
    """What one value adds to each part; zeros for an unknown one."""
    known = value.try_cast(VALUE_TYPE)
    hi = F.floor(known).cast("decimal(13,0)")
    lo = (known - F.floor(known)).cast("decimal(13,12)")
    products = {"hi": hi, "lo": lo, "hi_hi": hi * hi, "hi_lo": hi * lo, "lo_lo": lo * lo}
    return {"n": F.when(known.isNull(), 0).otherwise(1).cast("bigint"), **products}


def moment_columns(columns: Mapping[str, str]) -> dict[str, Column]:
    """The parts of several measures (name to column) as ``name_part``."""
    return {
        f"{name}_{part}": value
        for name, column in columns.items()
        for part, value in parts_of(F.col(column)).items()
    }


def merged(names: Mapping[str, str]) -> list[Column]:
    """Aggregates that add up the parts of the measures, from rows or from a rollup."""
    return [F.try_sum(f"{name}_{part}").alias(f"{name}_{part}") for name in names for part in PARTS]


def mean_of_parts(name: str) -> Column:
    """Mean as a double; null for no values."""
    n, hi, lo = (F.col(f"{name}_{p}") for p in PARTS[:3])
    total = hi.try_cast("decimal(37,12)") + lo.try_cast("decimal(37,12)")
    return F.try_divide(total.cast("double"), n.cast("double"))


def deviation_of_parts(name: str) -> Column:
    """Sample standard deviation as a double; null below two values.

    With q and f the whole and the fractional part of the centre, the squared distances
    from it are the sums over (hi-q)^2, 2(hi-q)(lo-f) and (lo-f)^2.
    """
    n, hi, lo, hi_hi, hi_lo, lo_lo = (F.col(f"{name}_{p}") for p in PARTS)
    count = n.try_cast("decimal(13,0)")
    total, rest = hi.try_cast("decimal(38,0)"), lo.try_cast("decimal(24,12)")
    q = F.call_function("div", total, F.when(n > 0, count)).try_cast("decimal(13,0)")
    left = (total - q * count).try_cast("decimal(13,0)")  # n * q + left = total
    f = F.try_divide(left + rest, F.when(n > 0, count)).try_cast("decimal(12,10)")
    whole = hi_hi.try_cast("decimal(38,0)") - q * (total + left).try_cast("decimal(24,0)")
    crossed = (hi_lo.try_cast("decimal(37,12)") - (q * rest).try_cast("decimal(37,12)")).try_cast(
        "decimal(37,12)"
    ) - (f * left).try_cast("decimal(37,12)")
    around = (rest + rest - f * count).try_cast("decimal(25,12)")
    small = lo_lo.try_cast("decimal(36,22)") - (f * around).try_cast("decimal(36,22)")
    narrow = [x.try_cast("decimal(36,22)") for x in (whole, crossed, crossed, small)]
    exact = (narrow[0] + narrow[1]).try_cast("decimal(37,22)") + (narrow[2] + narrow[3]).try_cast(
        "decimal(37,22)"
    )
    wide = whole.cast("double") + 2 * crossed.cast("double") + small.cast("double")
    off = (left + rest - f * count).cast("double")
    spread = F.coalesce(exact.cast("double"), wide) - F.try_divide(off * off, n.cast("double"))
    return F.when(n > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (n.cast("double") - 1)))
