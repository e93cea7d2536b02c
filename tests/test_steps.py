"""Step records and gauges."""

import datetime as dt

import pytest

from tripmill.operators.steps import (
    STEP_SCHEMA,
    duration_rollup,
    gauge,
    lake_samples,
    last_steps,
    latest_steps,
    nonzero,
    ranked_samples,
    step_samples,
    table_inventory,
)
from tripmill.plans.reuse import materialised, persisted
from tripmill.plans.steplog import StepLog

T = dt.datetime(2025, 4, 1)


def steps(spark, *rows):
    """(layer, operation, duration, hours after T, sequence)"""
    return spark.createDataFrame(
        [
            (layer, op, "success", 10, 5, ms, 0.25, 0, 2, {}, T + dt.timedelta(hours=h), seq)
            for layer, op, ms, h, seq in rows
        ],
        STEP_SCHEMA,
    )


def test_a_failing_step_is_recorded_and_raised(spark, tmp_path):
    log = StepLog(spark, str(tmp_path / "steps"))
    with log.track("bronze", "good", feed="fhv") as step:
        step.rows_written = 3
    with pytest.raises(ZeroDivisionError):
        with log.track("silver", "bad"):
            1 / 0
    log.save()
    log.save()
    rows = sorted(spark.read.parquet(log.path).collect(), key=lambda r: r.sequence)
    assert [(r.operation, r.status, r.rows_written) for r in rows] == [
        ("good", "success", 3),
        ("bad", "error", 0),
    ]
    assert rows[0].extra == {"feed": "fhv"} and rows[1].extra["error"] == "division by zero"
    assert all(r.duration_ms >= 0 for r in rows)
    assert log.records().count() == 2


def test_latest_step_prefers_time_then_sequence(spark):
    df = steps(
        spark, ("a", "x", 1.0, 1, 1), ("a", "x", 2.0, 1, 2), ("a", "x", 3.0, 0, 9), ("a", "y", 4.0, 0, 3)
    )
    assert sorted(r.duration_ms for r in latest_steps(df).collect()) == [2.0, 4.0]
    assert [r.duration_ms for r in last_steps(df, 2).collect()] == [2.0, 1.0]


def test_six_gauges_with_labels(spark):
    rows = step_samples(steps(spark, ("silver", "x", 1.5, 0, 1))).collect()
    assert len(rows) == 6
    values = {r.name: r.value for r in rows}
    assert values["pipeline_duration_ms"] == 1.5 and values["pipeline_duplicates_removed"] == 0
    assert rows[0].labels == 'layer="silver",operation="x",status="success"'


def test_nonzero_gauges(spark):
    samples = step_samples(steps(spark, ("silver", "x", 1.0, 0, 1), ("gold", "y", 1.0, 0, 2)))
    gauges = ("null_rate", "duplicates_removed", "invalid_records")
    assert nonzero(samples, gauges, layer="silver").count() == 2
    assert nonzero(samples, ("rows_written",)).count() == 2


def test_duration_totals(spark):
    df = steps(spark, ("a", "x", 1.25, 0, 1), ("a", "y", 2.5, 0, 2), ("b", "x", 4.0, 0, 3))
    totals = {(r.layer, r.operation): r.duration_ms for r in duration_rollup(df).collect()}
    assert totals[(None, None)] == 7.75 and totals[("a", None)] == 3.75 and totals[("b", "x")] == 4.0


def test_labels_are_quoted_and_missing_values_left_out(spark):
    df = spark.createDataFrame([('say "hi"', 1.23456), (None, 2.0), ("x", None)], "z string, v double")
    rows = gauge(df, "g", {"zone": "z"}, "v", 4).collect()
    assert [(r.labels, r.value) for r in rows] == [("zone=\"say 'hi'\"", 1.2346), ('zone="unknown"', 2.0)]


def test_ranks(spark):
    df = spark.createDataFrame([("a", 5), ("b", 9), ("c", 5), ("d", 1)], "zone string, trip_count bigint")
    rows = ranked_samples(df, "top", {"zone": "zone"}, 3).collect()
    assert sorted(r.labels for r in rows) == [
        'rank="1",zone="b"',
        'rank="2",zone="a"',
        'rank="3",zone="c"',
    ]


def test_every_anomaly_and_every_filled_table_is_counted(spark):
    tables = {"kpi": [spark.range(n) for n in (3, 0, 1)], "lake": []}
    samples = lake_samples(spark.range(701), None, tables).collect()
    values = {r.name: r.value for r in samples}
    assert values["lake_anomaly_trips_total"] == 701
    assert (values["serving_kpi_tables"], values["serving_lake_tables"]) == (2, 0)
    assert "lake_ml_mae_seconds" not in values


def test_inventory_totals_per_prefix(spark):
    tables = {"kpi_a": spark.range(3), "kpi_b": spark.range(4), "lake_c": spark.range(5)}
    found = {(r.prefix, r.table_name): (r.row_count, r.tables) for r in table_inventory(tables).collect()}
    assert found[("kpi", None)] == (7, 2) and found[("lake", "lake_c")] == (5, 1)
    assert found[(None, None)] == (12, 3)


def test_persisted_is_released_even_on_failure(spark):
    df = spark.range(10)
    with pytest.raises(RuntimeError):
        with persisted(df) as kept:
            assert kept.storageLevel.useDisk and not kept.storageLevel.useMemory
            raise RuntimeError
    assert not df.storageLevel.useDisk


def test_materialised_has_no_lineage(spark):
    df = materialised(spark.range(10).repartition(3), "test")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert df.count() == 10 and "Range" not in plan and "Repartition" not in plan
