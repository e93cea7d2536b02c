"""Late deliveries merged into a snapshot table, which is rewritten only where they change it."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import ExitStack
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.operators.quality import keep_latest
from tripmill.plans.reuse import written
from tripmill.sources.snapshots import (
    load_version,
    read_partitions,
    replace_partitions,
    write_snapshot,
)
from tripmill.sources.tables import TRIP_PARTITIONS
from tripmill.specs import TRIP_IDENTITY

#: Types whose smallest and largest value bound the files that can hold a key.
_BOUNDED = ("int", "bigint", "smallint", "tinyint", "date", "timestamp", "timestamp_ntz", "string")


@dataclass(frozen=True)
class Merged:
    """The version that holds the merge and how many partitions it rewrote."""

    version: int
    rewritten: int


def _within(late: DataFrame, keys: Sequence[str]) -> Column | None:
    """The bounds of the late keys, as a filter that reaches partitions and row groups.

    None where there are no late rows.
    """
    bounded = [k for k, kind in late.dtypes if k in keys and kind in _BOUNDED]
    found = late.agg(
        F.count(F.lit(1)).alias("n"),
        *[f(F.col(k)).alias(f"{name}_{k}") for k in bounded for name, f in _ENDS],
    ).first()
    if not found["n"]:
        return None
    inside = F.lit(True)
    for k in bounded:
        low, high, nulls = (found[f"{name}_{k}"] for name, _ in _ENDS)
        between = F.lit(False) if low is None else F.col(k).between(low, high)
        inside = inside & (between | F.col(k).isNull() if nulls else between)
    return inside


_ENDS = (("low", F.min), ("high", F.max), ("nulls", lambda c: F.count_if(c.isNull())))


def _matched(rows: DataFrame, keys_of: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join by key; null keys are equal."""
    other = keys_of.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = reduce(and_, (rows[k].eqNullSafe(other[f"_{k}"]) for k in keys))
    return rows.join(other, same, how)


def merge_latest(
    late: DataFrame,
    path: str,
    keys: Sequence[str] = TRIP_IDENTITY,
    newest: Sequence[str] = ("-ingestion_ts",),
    partitions: Sequence[str] = TRIP_PARTITIONS,
) -> Merged:
    """Publish the table with the newest row per key of what it holds and what came late.

    The result is that of ``keep_latest`` over both, as that is the same whatever is left
    out before; the table must hold one row per key, which a table made by it does.
    Rows that are in the table with the same values change nothing.

    The table's rows are looked at within the bounds of the late keys only. A partition is
    rewritten if it loses a row or gets one, the late rows' own or, where a trip is
    delivered again for another month, both. The files of other partitions stay as they are.
    Without a change there is no new version. Jobs start here; the driver gets the bounds
    of the keys and the names of changed partitions.
    """
    spark = late.sparkSession
    version = load_version(spark, path)
    if version is None:
        first = write_snapshot(keep_latest(late, keys, newest), path, partitions)
        return Merged(first, len(load_version(spark, path, first).partitions))
    if tuple(partitions) != version.keys:
        raise ValueError(f"the table is partitioned by {version.keys}")
    columns = version.schema.names
    current = read_partitions(spark, path, version)
    with ExitStack() as kept:
        one = keep_latest(late.select(*columns), keys, newest)
        one = kept.enter_context(written(one, "late"))
        inside = _within(one, keys)
        if inside is None:
            return Merged(version.number, 0)
        held = _matched(current.filter(inside), one, keys, "left_semi")
        held = kept.enter_context(written(held, "held"))
        # The last column decides between equal rows: the one that is there already stays.
        both = held.withColumn("_late", F.lit(False)).unionByName(
            one.withColumn("_late", F.lit(True))
        )
        added = keep_latest(both, keys, newest).filter("_late").drop("_late")
        added = kept.enter_context(written(added, "added"))
        lost = _matched(held, added, keys, "left_semi")
        changed = lost.select(*partitions).union(added.select(*partitions)).distinct()
        touched = {tuple(None if v in (None, "") else str(v) for v in row) for row in changed.collect()}
        if not touched:
            return Merged(version.number, 0)
        known = version.by_values()
        names = [known[row] for row in touched if row in known]
        stay = _matched(read_partitions(spark, path, version, names), added, keys, "left_anti")
        number = replace_partitions(stay.unionByName(added), path, version, names)
    return Merged(number, len(touched))

