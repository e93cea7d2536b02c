"""Column functions."""

import calendar
import datetime as dt
import hashlib
import math
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tripmill.functions import moments
from tripmill.functions.hashing import SAMPLE, SPLIT, below_fraction, key_hash
from tripmill.functions.numbers import exact, fixed_point, mean_of, rounded
from tripmill.functions.periods import first_day, month_of, period_of, source_name


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "name,period",
    [
        ("yellow_tripdata_2025-04.parquet", "2025-04"),
        ("2024-01_and_2025-02", "2024-01"),
        ("trips.parquet", "unknown"),
        ("20-2025-1.parquet", "unknown"),
        (None, "unknown"),
    ],
)
def test_period_of(spark, name, period):
    assert one(spark, period_of(F.lit(name).cast("string"))) == period


def test_source_name(spark):
    assert one(spark, source_name(F.lit("file:/a/yellow_2025-04.parquet"))) == "yellow_2025-04.parquet"
    assert one(spark, source_name(F.lit("s3://b/green_2025-04/part-0001.parquet"))) == "green_2025-04"


def test_first_day_of_no_period_is_null(spark):
    assert str(one(spark, first_day(F.lit("2024-02")))) == "2024-02-01"
    assert one(spark, first_day(F.lit("unknown"))) is None
    assert one(spark, first_day(F.lit("2024-13"))) is None


def test_month_does_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Beirut")  # skipped midnights
    try:
        midnight = F.lit("2024-03-31 00:30:00").cast("timestamp_ntz")
        assert one(spark, month_of(midnight)) == "2024-03"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_fixed_point(spark):
    assert one(spark, fixed_point(F.lit(12.34567))) == 123457
    assert one(spark, fixed_point(F.lit(-1.0))) == -10000
    assert one(spark, fixed_point(F.lit(float("nan")))) is None
    assert one(spark, fixed_point(F.lit(None).cast("double"))) is None
    assert one(spark, rounded(F.lit(0.00125), 4)) == 0.0013


def test_mean_of_nothing_is_null(spark):
    assert one(spark, mean_of(F.lit(None).cast("bigint"), F.lit(0).cast("bigint"))) is None


def test_means_do_not_depend_on_row_order(spark):
    rows = spark.range(50_000).select((F.col("id") * 0.07 + 1e6).alias("v"))
    mean = mean_of(F.sum(exact(F.col("v"))), F.count("v")).alias("m")
    found = {
        rows.repartition(n).orderBy(order).agg(mean).first()["m"]
        for n in (1, 7)
        for order in ("v", F.desc("v"))
    }
    assert len(found) == 1
    assert abs(found.pop() - (1e6 + 0.07 * 49_999 / 2)) < 1e-6


@pytest.mark.parametrize("value", [float("inf"), float("-inf"), float("nan"), 1e25, None])
def test_what_no_decimal_holds_is_unknown(spark, value):
    assert one(spark, exact(F.lit(value).cast("double"))) is None


def _moments(spark, values, grains=1):
    """(mean, deviation) of doubles whose parts were added up per grain, then over all."""
    rows = spark.createDataFrame([(i % grains, v) for i, v in enumerate(values)], "g int, v double")
    sums = rows.withColumns(moments.moment_columns({"x": "v"}))
    sums = sums.groupBy("g").agg(*moments.merged({"x": "v"})).agg(*moments.merged({"x": "v"}))
    return tuple(sums.select(moments.mean_of_parts("x"), moments.deviation_of_parts("x")).first())


@pytest.mark.parametrize(
    "values",
    [
        [1e6, 1e6 + 0.001, 1e6 + 0.002],
        [-1e6, -1e6 + 0.001, -1e6 - 0.002, -1e6],
        [999_999.9995, 1_000_000.0005] * 40,  # on both sides of a whole number
        [9e12, 9e12 + 1, 9e12 + 3],
        [4e-7, 4e-7],
        [1e-9, 3e-9, 8e-9],
        [0.0, 0.0, 0.0],
        [5e12, -5e12, 17.25],
        [0.37 * i + 0.00001 for i in range(1_000)],
        [-0.5, 0.25, 1e9],
    ],
)
def test_moments_keep_their_digits(spark, values):
    mean, deviation = _moments(spark, values)
    exact_values = [Fraction(repr(v)) for v in values]
    center = sum(exact_values) / len(values)
    want = math.sqrt(sum((v - center) ** 2 for v in exact_values) / (len(values) - 1))
    assert mean == pytest.approx(float(center), rel=1e-14)
    assert deviation == pytest.approx(want, rel=1e-10, abs=1e-15)
    # The same bits whatever the order and the grain.
    assert _moments(spark, values[::-1], 7) == (mean, deviation)


def test_moments_of_few_and_unknown_values(spark):
    assert _moments(spark, [3.5]) == (3.5, None)
    unknown = [float("inf"), float("-inf"), float("nan"), 1e13, None]
    assert _moments(spark, [*unknown, 2.0, 4.0]) == (3.0, math.sqrt(2.0))
    assert _moments(spark, unknown) == (None, None)


def test_key_hash_is_md5_of_the_key(spark):
    time = dt.datetime(2025, 4, 1, 8, 30, 7, 250_000)
    df = spark.createDataFrame(
        [("a", 7, 1.5, time, None)], "k string, n int, v double, t timestamp_ntz, u timestamp_ntz"
    )
    seconds = calendar.timegm(time.timetuple())
    digest = hashlib.md5(f"a|7|15000|{seconds}".encode()).hexdigest()
    keys = ["k", "n", "v", "t", "u"]
    row = df.select(*[key_hash(df, keys, part).alias(f"h{part}") for part in (SAMPLE, SPLIT)])
    assert tuple(row.first()) == (digest[:8], digest[8:16])


def test_sample_share_nesting_and_stability(spark):
    ids = spark.range(20_000).withColumn("k", F.col("id").cast("string"))
    hashed = ids.withColumn("h", key_hash(ids, ["k"], SAMPLE))

    def chosen(df, share):
        return {r["id"] for r in df.filter(below_fraction(F.col("h"), share)).collect()}

    small, large = chosen(hashed, 0.1), chosen(hashed.repartition(13), 0.3)
    assert small < large and small == chosen(hashed.repartition(5), 0.1)
    assert 1_800 < len(small) < 2_200 and 5_700 < len(large) < 6_300
    assert len(chosen(hashed, 1.0)) == 20_000 and not chosen(hashed, 0.0)
