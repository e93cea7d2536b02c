"""Duration models."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripmill.operators import models
from tripmill.operators.models import (
    CATEGORY,
    NUMERIC,
    SPLIT_KEY,
    TARGET,
    compare_models,
    duration_pipeline,
    estimator_for,
    fit,
    fit_and_score,
    ml_features,
    ml_input,
    ml_split,
    regression_metrics,
)


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    """A known signal: distance, a rush hour and the feed set the duration."""
    ids = spark.range(1_500)
    noise = F.pmod(F.xxhash64("id"), F.lit(61)) - 30
    df = ids.select(
        F.when(F.col("id") % 3 == 0, "fhv").otherwise("fhvhv").alias(CATEGORY),
        (F.col("id") % 24).cast("int").alias("pickup_hour"),
        (F.col("id") % 7 + 1).cast("int").alias("pickup_dow"),
        (F.col("id") % 40 + 1).cast("int").alias("pu_location_id"),
        (F.pmod(F.hash("id"), F.lit(300)) / 10.0).alias("trip_distance"),
        F.substring(F.md5(F.col("id").cast("string")), 1, 8).alias(SPLIT_KEY),
        noise.alias("_noise"),
    )
    duration = (
        F.col("trip_distance") * 120
        + F.when(F.col("pickup_hour").between(7, 9), 600).otherwise(0)
        + F.when(F.col(CATEGORY) == "fhv", 300).otherwise(0)
        + F.col("_noise")
        + 200
    )
    path = str(tmp_path_factory.mktemp("models") / "rows")
    df.withColumn(TARGET, duration.cast("int")).drop("_noise").coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


def mean_error(rows):
    split = ml_split(ml_features(rows))
    mean = split.filter("not is_test").agg(F.avg(TARGET)).first()[0]
    return regression_metrics(split.withColumn("prediction", F.lit(mean))).first().mae_seconds


@pytest.mark.parametrize("name", models.MODEL_NAMES)
def test_models_beat_the_mean_and_repeat(rows, name, monkeypatch):
    monkeypatch.setattr(models, "TREES", 8)
    monkeypatch.setattr(models, "ROUNDS", 8)
    first, second = fit_and_score(rows, name).first(), fit_and_score(rows, name).first()
    assert first == second
    assert first.mae_seconds < 0.6 * mean_error(rows) and 0.5 < first.r2_score <= 1
    assert first.train_rows + first.test_rows == first.sample_rows == 1_500
    assert 0.15 < first.test_rows / 1_500 < 0.25
    assert first.coefficients is None


def test_parameters_are_the_declared_ones(rows):
    boosting, forest = estimator_for("GradientBoosting", rows), estimator_for("RandomForest", rows)
    assert (boosting.getMaxIter(), boosting.getMaxDepth(), boosting.getStepSize()) == (80, 5, 0.1)
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getMinInstancesPerNode()) == (80, 12, 5)
    with pytest.raises(ValueError):
        estimator_for("Oracle", rows)


def design(split):
    rows = split.filter("not is_test").toPandas()
    x = np.column_stack([rows[c] for c in NUMERIC] + [(rows[CATEGORY] == "fhvhv").astype(float), (rows[CATEGORY] == "fhv").astype(float)])
    return x, rows[TARGET].to_numpy()


def test_ridge_is_the_closed_form(rows):
    model, _ = fit(rows, "Ridge")
    x, y = design(ml_split(ml_features(rows)))
    centred = x - x.mean(axis=0)
    expected = np.linalg.solve(centred.T @ centred + np.eye(x.shape[1]), centred.T @ (y - y.mean()))
    assert model.stages[-1].coefficients.toArray() == pytest.approx(expected, abs=1e-6)


def test_coefficients_only_without_a_category(rows):
    report = fit_and_score(rows.drop(CATEGORY), "LinearRegression").first()
    assert set(report.coefficients) == set(NUMERIC)
    assert report.coefficients["trip_distance"] == pytest.approx(120, abs=2)
    assert report.features == ",".join(NUMERIC)


def test_unseen_category_is_an_all_zero_vector(rows):
    train = ml_split(ml_features(rows)).filter("not is_test")
    model = duration_pipeline((*NUMERIC, CATEGORY), estimator_for("LinearRegression", train)).fit(train)
    other = train.limit(1).withColumn(CATEGORY, F.lit("unseen"))
    vector = model.transform(other).first().features.toArray()
    assert len(vector) == len(NUMERIC) + 2 and list(vector[-2:]) == [0.0, 0.0]


def test_features_fill_nulls(spark):
    row = spark.createDataFrame(
        [(None, None, 3, None, None, 60, "00000000")],
        f"{CATEGORY} string, pickup_hour int, pickup_dow int, pu_location_id int, "
        f"trip_distance double, {TARGET} int, {SPLIT_KEY} string",
    )
    found = ml_features(row).first()
    assert (found.pickup_hour, found.pickup_dow, found.trip_distance) == (0.0, 3.0, 0.0)
    assert found.vehicle_type == "unknown"
    assert ml_split(row).first().is_test


def test_input_is_sampled_capped_and_needs_a_duration(spark):
    from test_analytics import many

    trips = many(spark, 400)
    positive = trips.filter(F.col(TARGET) > 0).count()
    assert ml_input(trips, 1.0, None).count() == positive
    assert ml_input(trips, 1.0, 50).count() == 50
    again = ml_input(trips.repartition(5), 1.0, 50).collect()
    assert sorted(map(str, again)) == sorted(map(str, ml_input(trips, 1.0, 50).collect()))
    assert 0 < ml_input(trips, 0.5, None).count() < positive
    assert {r.vehicle_type for r in ml_input(trips, 1.0, None, feeds=("fhv",)).collect()} == {"fhv"}


def test_metrics_against_numpy(spark):
    rng = np.random.default_rng(1)
    y, p = rng.normal(900, 200, 300), rng.normal(900, 200, 300)
    df = spark.createDataFrame(
        [(float(a), float(b), i % 4 == 0) for i, (a, b) in enumerate(zip(y, p))],
        f"{TARGET} double, prediction double, is_test boolean",
    )
    row, test = regression_metrics(df).first(), np.arange(300) % 4 == 0
    y, p = y[test], p[test]
    assert row.mae_seconds == pytest.approx(np.abs(y - p).mean(), abs=0.006)
    assert row.r2_score == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum(), abs=6e-5)
    assert (row.train_rows, row.test_rows) == (225, 75)


def test_comparison_ranks_by_error(rows):
    ranked = compare_models(rows, ("LinearRegression", "Ridge")).orderBy("place").collect()
    assert [r.place for r in ranked] == [1, 2] and ranked[0].is_best and not ranked[1].is_best
    assert ranked[0].mae_seconds <= ranked[1].mae_seconds


def coarse(rows, copies):
    """Few distinct features, and every row several times."""
    few = rows.withColumn("trip_distance", F.floor(F.col("trip_distance") / 3).cast("double"))
    return few.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("_copy")


def by_rows(rows, name):
    """Trained on every row by itself."""
    split = ml_split(ml_features(rows))
    train = split.filter("not is_test")
    model = duration_pipeline(models.feature_columns(rows), estimator_for(name, train)).fit(train)
    return model.transform(split)


def test_boosting_on_equal_rows_is_boosting_on_rows(rows, monkeypatch):
    monkeypatch.setattr(models, "ROUNDS", 5)
    trained, plain = [], models.GBTRegressor.fit

    def watched(self, dataset, *args):
        trained.append(dataset.count())
        return plain(self, dataset, *args)

    many = coarse(rows, 4)
    want = by_rows(many, "GradientBoosting")
    monkeypatch.setattr(models.GBTRegressor, "fit", watched)
    _, scored = fit(many, "GradientBoosting")
    keys = [*NUMERIC, CATEGORY]

    def known(found):  # of splits that part the training rows alike, either may be taken
        seen = found.filter("not is_test").select(*keys, "prediction").distinct().collect()
        return {tuple(r)[:-1]: r.prediction for r in seen}

    one, two = known(want), known(scored)
    assert one.keys() == two.keys() and scored.count() == 6_000
    assert [two[k] for k in one] == pytest.approx([one[k] for k in one], rel=1e-6)
    assert trained == [len(one)]


def test_forest_on_equal_rows_errs_like_one_on_rows(rows, monkeypatch):
    monkeypatch.setattr(models, "TREES", 20)
    many = coarse(rows, 3)
    plain = regression_metrics(by_rows(many, "RandomForest")).first()
    model, scored = fit(many, "RandomForest")
    found = regression_metrics(scored).first()
    assert (found.train_rows, found.test_rows) == (plain.train_rows, plain.test_rows)
    assert found.mae_seconds == pytest.approx(plain.mae_seconds, rel=0.1)
    trees = [s for s in model.stages if hasattr(s, "toDebugString")]
    assert len(trees) == 20 and max(t.depth for t in trees) <= 12 and len({t.toDebugString for t in trees}) == 20
    again = fit(many.repartition(7), "RandomForest")[1]
    assert regression_metrics(again).first() == found


def test_samples_are_poisson_and_do_not_depend_on_partitions(spark):
    numbers = F.array(*map(F.lit, (1, 7, 5_000)))
    ids = spark.range(4_000).withColumn("n", F.element_at(numbers, F.col("id").cast("int") % 3 + 1))
    seen = ids.select("id", "n", models.drawn(F.col("n").cast("long"), F.xxhash64("id"), 6).alias("w"))
    again = ids.repartition(9).select("id", models.drawn(F.col("n").cast("long"), F.xxhash64("id"), 6).alias("w"))
    got = {r.id: (r.n, r.w) for r in seen.collect()}
    assert {r.id: r.w for r in again.collect()} == {i: w for i, (_, w) in got.items()}
    for n in (1, 7, 5_000):
        w = np.array([w for k, w in got.values() if k == n])
        assert w.shape[1] == 6 and abs(w.mean() - n) < 5 * (n / w.size) ** 0.5
        assert w.var() == pytest.approx(n, rel=0.1)
        assert abs(np.corrcoef(w.T) - np.eye(6)).max() < 0.15
    ones = np.array([w for k, w in got.values() if k == 1])
    assert (ones == 0).mean() == pytest.approx(np.exp(-1), abs=0.02)
