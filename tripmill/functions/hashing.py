"""Stable pseudo-random choice from the key of a row.

``DataFrame.sample`` draws by partition and row position, so a different file
split gives different rows. Here the choice depends on the key alone: the same
trip is in the sample on every cluster, after every retry and at every size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.numbers import fixed_point

SPACE = 2**32
EPOCH = "1970-01-01 00:00:00"

# Independent parts of one hash: which trips are sampled says nothing about the split.
SAMPLE, SPLIT = 0, 1


def _text(name: str, kind: str) -> Column:
    """A key column as short text: doubles in fixed point, so that 1e7 and 10000000.0
    agree, and times in whole seconds, as formatting them costs more than the hash."""
    value = F.col(name)
    if kind in ("double", "float"):
        value = fixed_point(value)
    elif kind == "timestamp_ntz":
        since = value - F.lit(EPOCH).cast("timestamp_ntz")
        value = since.cast("interval second").cast("bigint")
    return value.cast("string")


def key_text(df: DataFrame, keys: Sequence[str]) -> Column:
    """Key columns as one text; unknown values are skipped."""
    types = dict(df.dtypes)
    return F.concat_ws("|", *[_text(k, types[k]) for k in keys])


def key_hash(df: DataFrame, keys: Sequence[str], part: int) -> Column:
    """32 bits of the MD5 of the key as eight hex digits."""
    return F.substring(F.md5(key_text(df, keys)), 1 + 8 * part, 8)


def below_fraction(hashed: Column, fraction: float) -> Column:
    """True for the given share of hash values (hex text orders like its number)."""
    limit = round(fraction * SPACE)
    if limit >= SPACE:
        return F.lit(True)
    return hashed < F.lit(f"{max(limit, 0):08x}")
