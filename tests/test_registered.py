"""Every registered query: the same rows as its SQL, and plans fit for large inputs."""

import re

import pytest

from checks.compare import difference
from checks.oracle import ORACLE
from checks.queries import REGISTERED

# Slow to train; covered by test_models.
SLOW = {"model_gbt", "model_forest", "model_comparison"}


@pytest.mark.parametrize("name", sorted(REGISTERED.keys() - SLOW))
def test_query(spark, db, sf, name):
    assert difference(spark, db, sf, name) is None


def test_every_oracle_belongs_to_a_query():
    assert ORACLE.keys() <= REGISTERED.keys()


# Everything joined by exchange, and every partition past a few kilobytes split as skewed.
LARGE_INPUT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


@pytest.mark.parametrize(
    "name", ["top_routes", "zscores_any_feed", "anomalies_capped", "incident_trip_join"]
)
def test_query_planned_as_for_a_large_input(spark, db, sf, name):
    for key, value in LARGE_INPUT.items():
        spark.conf.set(key, value)
    try:
        assert difference(spark, db, sf, name) is None
    finally:
        for key in LARGE_INPUT:
            spark.conf.unset(key)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["top_routes", "trip_rollup", "quality_report", "zscores_any_feed", "incident_trip_join"]
)
def test_no_cross_join(spark, sf, name):
    plan = plan_of(REGISTERED[name](spark, sf))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan)


def test_dedup_limits_keys_before_the_exchange(spark, sf):
    plan = plan_of(REGISTERED["dedup_latest"](spark, sf))
    final, partial = [m.start() for m in re.finditer("WindowGroupLimit", plan)]
    assert final < plan.index("Exchange hashpartitioning") < partial


def test_top_routes_keeps_n_rows_per_task(spark, sf):
    assert "TakeOrderedAndProject" in plan_of(REGISTERED["top_routes"](spark, sf))


def test_filters_and_columns_reach_the_scan(spark, sf):
    df = REGISTERED["payment_distribution"](spark, sf)
    plan = plan_of(df)
    assert "PushedFilters: [Or(IsNull(l_extendedprice)" in plan
    assert "l_comment" not in plan and "o_totalprice" not in plan
