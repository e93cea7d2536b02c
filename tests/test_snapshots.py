"""Versions that appear whole or not at all, and late deliveries merged into them."""

import datetime as dt
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tripmill.operators.quality import keep_latest
from tripmill.plans.merge import _within, merge_latest
from tripmill.sources import snapshots
from tripmill.sources.snapshots import read_snapshot, versions, write_snapshot

T = dt.datetime(2025, 4, 1, 8, 30)
SCHEMA = "vehicle_type string, n long, pickup_ts timestamp_ntz, fare double, year_month string, ingestion_ts timestamp_ntz"
KEYS = ("vehicle_type", "n", "pickup_ts")


def row(n, fare=1.0, month="2025-04", day=0, feed="yellow", at=T):
    return (feed, n, at, fare, month, T + dt.timedelta(days=day))


def made(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def rows_of(df):
    return sorted(map(repr, df.collect()))


def files(spark, path):
    """Data files of the newest version, by partition."""
    folders = snapshots.load_version(spark, path).folders(path)
    return {Path(f).parent.name + "/" + Path(f).name: sorted(map(str, Path(f).glob("*.parquet"))) for f in folders}


def test_only_changed_months_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    write_snapshot(made(spark, row(1), row(2, month="2025-05"), row(3, month="2025-06")), path)
    before = files(spark, path)
    merged = merge_latest(made(spark, row(2, 9.0, "2025-05", day=1)), path, KEYS)
    assert (merged.version, merged.rewritten) == (2, 1)
    after = files(spark, path)
    assert {m for m in before if before[m] != after[m]} == {"vehicle_type=yellow/year_month=2025-05"}
    want = [row(1), row(2, 9.0, "2025-05", day=1), row(3, month="2025-06")]
    assert rows_of(read_snapshot(spark, path)) == rows_of(made(spark, *want))
    assert read_snapshot(spark, path, 1).filter("fare = 9").count() == 0


def test_trip_that_moves_to_another_month(spark, tmp_path):
    """The month it leaves ends up without rows and without a folder."""
    path = str(tmp_path / "t")
    write_snapshot(made(spark, row(1), row(2, month="2025-05")), path)
    assert merge_latest(made(spark, row(2, month="2025-04", day=1)), path, KEYS).rewritten == 2
    assert list(files(spark, path)) == ["vehicle_type=yellow/year_month=2025-04"]
    assert read_snapshot(spark, path).count() == 2


def test_what_changes_nothing_makes_no_version(spark, tmp_path):
    path = str(tmp_path / "t")
    first = made(spark, row(1, day=2), row(2))
    write_snapshot(first, path)
    for late in (first, made(spark, row(1, 7.0, day=1)), first.limit(0)):
        assert merge_latest(late, path, KEYS).rewritten == 0
    assert versions(spark, path) == [1]


def test_null_keys_are_equal(spark, tmp_path):
    path = str(tmp_path / "t")
    write_snapshot(made(spark, row(None, at=None), row(1)), path)
    merge_latest(made(spark, row(None, 5.0, at=None, day=1), row(None, 6.0)), path, KEYS)
    fares = [r["fare"] for r in read_snapshot(spark, path).filter("n is null").collect()]
    assert sorted(fares) == [5.0, 6.0]


def test_odd_partition_values(spark, tmp_path):
    path = str(tmp_path / "t")
    odd = ["a/b=c", "50%", "ü ö", None, "2025"]
    write_snapshot(made(spark, *(row(i, month=m) for i, m in enumerate(odd))), path)
    assert [r["year_month"] for r in read_snapshot(spark, path).orderBy("n").collect()] == odd
    late = made(spark, *(row(i, 2.0, month=m, day=1) for i, m in enumerate(odd)), row(9, month=""))
    assert merge_latest(late, path, KEYS).rewritten == 5
    got = read_snapshot(spark, path).orderBy("n").collect()
    assert [r["year_month"] for r in got] == [*odd, None]
    assert [r["fare"] for r in got] == [2.0] * 5 + [1.0]


@pytest.mark.parametrize("seed", range(3))
def test_any_deliveries_in_any_order_equal_a_rebuild(spark, tmp_path, seed):
    path, draw = str(tmp_path / "t"), random.Random(seed)
    deliveries = [
        [
            row(draw.choice([None, *range(12)]), float(draw.randrange(3)), f"2025-0{draw.randrange(1, 5)}",
                draw.randrange(3), draw.choice(["yellow", "green"]))
            for _ in range(draw.choice([1, 8, 30]))
        ]
        for _ in range(3)
    ]
    for rows in deliveries:
        merge_latest(made(spark, *rows), path, KEYS)
    everything = made(spark, *(r for rows in deliveries for r in rows))
    assert rows_of(read_snapshot(spark, path)) == rows_of(keep_latest(everything, KEYS))


def test_killed_write_leaves_the_version_before(spark, tmp_path):
    path = str(tmp_path / "t")
    first = made(spark, row(1), row(2, month="2025-05"))
    write_snapshot(first, path)
    broken = made(spark, row(1, 5.0)).withColumn("fare", F.raise_error(F.lit("killed")).cast("double"))
    with pytest.raises(Exception, match="killed"):
        write_snapshot(broken, path)
    snapshots.write_commit(made(spark, row(1, 6.0)), path, ("vehicle_type", "year_month"))  # no version names it
    assert rows_of(read_snapshot(spark, path)) == rows_of(first)
    assert versions(spark, path) == [1]
    assert snapshots.forget(spark, path) == []
    assert len(list((tmp_path / "t" / "data").iterdir())) == 1
    assert rows_of(read_snapshot(spark, path)) == rows_of(first)


def test_one_of_two_writers_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    write_snapshot(made(spark, row(1)), path)
    base = snapshots.load_version(spark, path)
    write_snapshot(made(spark, row(2)), path, base=base)
    with pytest.raises(snapshots.VersionConflict):
        write_snapshot(made(spark, row(3)), path, base=base)
    assert rows_of(read_snapshot(spark, path)) == rows_of(made(spark, row(2)))
    assert not [f for f in (tmp_path / "t" / "versions").iterdir() if f.name.startswith(".") and f.suffix != ".crc"]


def test_whole_tables_and_old_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, path)
    write_snapshot(made(spark, row(1), row(2, month="2025-05")), path)
    write_snapshot(made(spark, row(3)).drop("fare"), path, whole=True)
    assert read_snapshot(spark, path).columns == [c for c in made(spark).columns if c != "fare"]
    with pytest.raises(ValueError, match="columns"):
        write_snapshot(made(spark, row(4)), path)
    with pytest.raises(ValueError, match="partitioned"):
        write_snapshot(made(spark, row(4)).drop("fare"), path, ("year_month",))
    write_snapshot(made(spark).drop("fare"), path, whole=True)
    assert read_snapshot(spark, path).count() == 0 and read_snapshot(spark, path, 1).count() == 2
    assert snapshots.forget(spark, path, keep=2) == [1]
    assert read_snapshot(spark, path, 2).count() == 1


def test_late_keys_bound_what_is_read(spark, tmp_path):
    """Feeds and pickup times outside the late rows are not scanned."""
    path = str(tmp_path / "t")
    write_snapshot(made(spark, row(1), row(1, feed="green")), path)
    inside = _within(made(spark, row(1, day=1)), KEYS)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = read_snapshot(spark, path).filter(inside)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [isnotnull(vehicle_type" in plan
    assert "GreaterThanOrEqual(n,1)" in plan and "GreaterThanOrEqual(pickup_ts" in plan
