"""Raw feed files in drifting layouts, written from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import bindings as b
from tripmill.plans.reuse import materialised
from tripmill.session import scratch_path
from tripmill.specs import FeedSpec

# The declared types of the raw freight feed.
FREIGHT_FILES = FeedSpec(
    name="freight",
    pickup="o_orderdate",
    dropoff="l_shipdate",
    pickup_zone="from_zone",
    dropoff_zone="to_zone",
    contract="""
        feed string, o_orderdate timestamp_ntz, l_shipdate timestamp_ntz, from_zone int,
        to_zone int, l_quantity double, l_extendedprice double, l_orderkey bigint,
        l_linenumber int, charge double
    """,
)


PREFIX = "freight_"


def _layouts(raw: DataFrame) -> list[DataFrame]:
    """Early years as declared; then 64-bit ids and another spelling; then an added column
    and a dropped one."""
    year = F.substring("source", len(PREFIX) + 1, 4)
    declared = raw.filter(year <= "1996")
    wide = raw.filter(year.between("1997", "1998")).select(
        *[c for c in raw.columns if c not in ("from_zone", "l_linenumber", "o_orderdate")],
        F.col("from_zone").cast("bigint").alias("from_zone"),
        F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
        F.col("o_orderdate").alias("O_OrderDate"),
    )
    grown = (
        raw.filter(year >= "1999")
        .drop("charge")
        .withColumn("late", F.col("l_shipdate") > F.col("o_orderdate"))
    )
    return [declared, wide, grown]


def write_freight(spark: SparkSession, sf: str) -> str:
    """One directory of Parquet files per month, named after it.

    The tables are joined and dealt to months once; each layout then reads its months.
    """
    root = scratch_path(spark, "raw-freight")
    raw = b.freight_raw(spark, sf).drop("_ingestion_ts", "_source_file")
    months = raw.withColumn("source", F.concat(F.lit(PREFIX), "year_month")).drop("year_month")
    months = materialised(months.hint("rebalance", "source"), "freight", ["source"])
    for i, layout in enumerate(_layouts(months)):
        layout.write.partitionBy("source").parquet(f"{root}/layout{i}")
    return root
