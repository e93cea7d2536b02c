"""Trip duration models on MLlib."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.functions.hashing import SAMPLE, SPLIT, below_fraction, key_hash
from tripmill.functions.numbers import rounded
from tripmill.functions.ordering import by
from tripmill.operators.conform import only_feeds
from tripmill.operators.flows import hash_sample
from tripmill.operators.topn import top_n
from tripmill.plans.reuse import materialised
from tripmill.session import ensure_checkpoints
from tripmill.specs import TRIP_IDENTITY

TARGET = "trip_duration_sec"
NUMERIC = ("pickup_hour", "pickup_dow", "pu_location_id", "trip_distance")
CATEGORY = "vehicle_type"
SPLIT_KEY = "split_hash"

# Model names and parameters.
MODEL_NAMES = ("LinearRegression", "Ridge", "RandomForest", "GradientBoosting")
RIDGE_ALPHA = 1.0
TREES, FOREST_DEPTH, MIN_LEAF = 80, 12, 5
ROUNDS, BOOST_DEPTH, RATE = 80, 5, 0.1
SEED = 42
# Split candidates per feature; enough to treat each zone as its own value.
MAX_BINS = 256
#: Trees of a forest that are grown side by side.
SIDE_BY_SIDE = 8
#: Trained on groups of equal rows, whose work does not grow with the rows.
GROUPED = ("RandomForest", "GradientBoosting")


def ml_input(
    trips: DataFrame,
    fraction: float = 1.0,
    cap: int | None = 10_000,
    feeds: Sequence[str] | None = None,
    keys: Sequence[str] = TRIP_IDENTITY,
) -> DataFrame:
    """Trips with a positive duration, cut to the ``cap`` smallest hashes.

    ``cap`` bounds the rows a model is fitted to. Carries a second, independent hash of
    the key for the split.
    """
    known = only_feeds(trips, feeds).filter(F.col(TARGET) > 0)
    sampled = hash_sample(known, fraction, keys)
    columns = (CATEGORY, *NUMERIC, TARGET, SPLIT_KEY)
    rows = sampled.withColumns(
        {
            "_hash": key_hash(sampled, keys, SAMPLE),
            SPLIT_KEY: key_hash(sampled, keys, SPLIT),
        }
    ).select("_hash", *columns)
    if cap is not None:
        leading = F.conv(F.substring("_hash", 1, 4), 16, 10).cast("bigint")
        rows = top_n(rows, by("_hash", *columns), cap, bucket=leading)
    return rows.drop("_hash")


def feature_columns(df: DataFrame) -> list[str]:
    return [c for c in (*NUMERIC, CATEGORY) if c in df.columns]


def ml_features(rows: DataFrame) -> DataFrame:
    """The available features with nulls filled (0 and ``unknown``), target and split key."""
    names = feature_columns(rows)
    values = [
        F.coalesce(F.col(c), F.lit("unknown")).alias(c)
        if c == CATEGORY
        else F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
        for c in names
    ]
    return rows.select(*values, F.col(TARGET).cast("double").alias(TARGET), SPLIT_KEY)


def ml_split(rows: DataFrame, test_fraction: float = 0.2) -> DataFrame:
    """Marks the held-out rows by their split hash: the same rows on every run."""
    return rows.withColumn("is_test", below_fraction(F.col(SPLIT_KEY), test_fraction))


def duration_pipeline(features: Sequence[str], estimator) -> Pipeline:
    """One-hot category next to the plain numbers, then the estimator.

    A category unseen in training is an all-zero vector: it indexes past the
    known ones and the encoder drops that last index.
    """
    numeric = [c for c in features if c != CATEGORY]
    stages = []
    inputs = list(numeric)
    if CATEGORY in features:
        stages += [
            StringIndexer(inputCol=CATEGORY, outputCol="_index", handleInvalid="keep"),
            OneHotEncoder(inputCol="_index", outputCol="_onehot", dropLast=True),
        ]
        inputs.append("_onehot")
    stages += [VectorAssembler(inputCols=inputs, outputCol="features"), estimator]
    return Pipeline(stages=stages)


def ridge(alpha: float, n: int, deviation: float) -> LinearRegression:
    """Ridge with penalty ``alpha``. MLlib averages the squared error and scales the label
    by its (population) deviation, so the penalty is scaled the same way."""
    return LinearRegression(
        labelCol=TARGET,
        elasticNetParam=0.0,
        regParam=alpha * deviation / n,
        standardization=False,
        solver="normal",
    )


def estimator_for(name: str, train: DataFrame):
    """The named estimator; only ridge looks at the training rows (count and deviation)."""
    if name == "LinearRegression":
        return LinearRegression(labelCol=TARGET, solver="normal")
    if name == "Ridge":
        size = train.agg(
            F.count(F.lit(1)).alias("n"), F.stddev_pop(TARGET).alias("deviation")
        ).first()
        return ridge(RIDGE_ALPHA, max(size["n"], 1), size["deviation"] or 0.0)
    if name == "RandomForest":
        return RandomForestRegressor(
            labelCol=TARGET,
            numTrees=TREES,
            maxDepth=FOREST_DEPTH,
            minInstancesPerNode=MIN_LEAF,
            featureSubsetStrategy="all",
            maxBins=MAX_BINS,
            seed=SEED,
        )
    if name == "GradientBoosting":
        return GBTRegressor(
            labelCol=TARGET,
            maxIter=ROUNDS,
            maxDepth=BOOST_DEPTH,
            stepSize=RATE,
            maxBins=MAX_BINS,
            seed=SEED,
        )
    raise ValueError(f"unknown model {name!r}; choose from {MODEL_NAMES}")


def equal_rows(split: DataFrame, names: Sequence[str]) -> DataFrame:
    """Training rows that are alike in features and target as one row and their number ``n``."""
    train = split.filter(~F.col("is_test"))
    return train.groupBy(*names, TARGET).agg(F.count(F.lit(1)).alias("n"))


def drawn(number: Column, seed: Column, trees: int) -> Column:
    """For each tree, how often rows are in its sample that stand for ``number`` equal rows.

    Sampling with replacement takes a row Poisson(1) times, so ``number`` of them Poisson(number)
    times. The draw depends on the seed and the tree alone, not on partitions or batches.
    """

    @F.arrow_udf("array<long>")
    def draw(numbers: pa.Array, seeds: pa.Array) -> pa.Array:
        import math

        import numpy as np

        n, first = numbers.to_numpy(), seeds.to_numpy().view(np.uint64)
        step = np.arange(1, trees + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        mixed = first[:, None] + step[None]
        for shift, odd in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(odd)
        even = ((mixed ^ (mixed >> np.uint64(31))) >> np.uint64(11)) * 2.0**-53
        found = np.empty(even.shape, np.int64)
        for k in np.unique(n).tolist():  # inverse of the distribution where it is not zero
            far = int(12 * math.sqrt(k)) + 20
            low = max(k - far, 0)
            logs = np.log(k / np.arange(low + 1, k + far + 1))
            start = low * math.log(k) - k - math.lgamma(low + 1)
            reached = np.cumsum(np.exp(start + np.append(0.0, np.cumsum(logs))))
            found[n == k] = low + np.searchsorted(reached, even[n == k], side="right")
        ends = np.arange(len(n) + 1, dtype=np.int32) * trees
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(found.ravel()))

    return draw(number, seed)


def _samples(groups: DataFrame, names: Sequence[str], trees: int) -> DataFrame:
    """Each distinct combination of features with its weight and sum of targets in every tree's sample."""
    seed = F.xxhash64(F.lit(SEED), *names, TARGET)
    taken = groups.select(*names, TARGET, drawn(F.col("n"), seed, trees).alias("w"))
    weights = [F.sum(F.col("w")[t]).cast("double") for t in range(trees)]
    sums = [F.sum(F.col("w")[t] * F.col(TARGET)) for t in range(trees)]
    return taken.groupBy(*names).agg(F.array(*weights).alias("weights"), F.array(*sums).alias("sums"))


def _forest(spec: RandomForestRegressor, shape: PipelineModel, samples: DataFrame) -> list:
    """Stages of a forest: trees grown on their samples, and the mean of what they predict.

    A leaf holds so many rows, not groups: the sample's weight is its number of rows.
    """
    trees = spec.getNumTrees()
    samples = materialised(shape.transform(samples).select("features", "weights", "sums"), "samples")
    sizes = samples.agg(*[F.sum(F.col("weights")[t]) for t in range(trees)]).first()

    def grow(t: int):
        weight = F.col("weights")[t]
        rows = samples.filter(weight > 0).select(
            "features", weight.alias("weight"), (F.col("sums")[t] / weight).alias(TARGET)
        )
        return DecisionTreeRegressor(
            labelCol=TARGET,
            weightCol="weight",
            predictionCol=f"_tree_{t}",
            maxDepth=spec.getMaxDepth(),
            maxBins=spec.getMaxBins(),
            minWeightFractionPerNode=min((spec.getMinInstancesPerNode() - 0.5) / max(sizes[t] or 0, 1), 0.499),
            seed=spec.getSeed(),
        ).fit(rows)

    with ThreadPool(SIDE_BY_SIDE) as pool:
        grown = pool.map(inheritable_thread_target(samples.sparkSession)(grow), range(trees), chunksize=1)
    each = [f"_tree_{t}" for t in range(trees)]
    mean = f"SELECT * EXCEPT ({', '.join(each)}), ({' + '.join(each)}) / {trees} AS prediction FROM __THIS__"
    return [*grown, SQLTransformer(statement=mean)]


def _fit_grouped(split: DataFrame, names: Sequence[str], estimator) -> tuple[PipelineModel, DataFrame]:
    """Trees split by feature values and see of the targets only sums, so equal rows are one row.

    Boosting needs each combination of features once, with its number of rows as weight and
    their mean target: what is left of the variance is the same on both sides of every split.
    The forest draws its samples from the groups as it would from the rows.
    """
    train = split.filter(~F.col("is_test"))
    stages = duration_pipeline(names, estimator).getStages()[:-1]
    shape = Pipeline(stages=stages).fit(train)
    groups = materialised(equal_rows(split, names), "groups")
    if isinstance(estimator, RandomForestRegressor):
        last = _forest(estimator, shape, _samples(groups, names, estimator.getNumTrees()))
    else:
        sums = groups.groupBy(*names).agg(
            F.sum("n").cast("double").alias("weight"), F.sum(F.col("n") * F.col(TARGET)).alias("_sum")
        )
        cells = sums.withColumn(TARGET, F.col("_sum") / F.col("weight"))
        cells = materialised(shape.transform(cells).select("features", "weight", TARGET), "cells")
        last = [estimator.copy({estimator.weightCol: "weight"}).fit(cells)]
    model = PipelineModel(stages=[*shape.stages, *last])
    distinct = materialised(split.select(*names).distinct(), "distinct")
    predicted = materialised(model.transform(distinct).select(*names, "prediction"), "predicted")
    return model, split.join(predicted, list(names))


def fit(rows: DataFrame, name: str, test_fraction: float = 0.2) -> tuple[PipelineModel, DataFrame]:
    """Train on the rows not held out and predict every row. Starts jobs.

    ``rows`` is read several times: pass a written table, not a long plan. Boosting
    checkpoints every few rounds, so a lost executor does not replay all of them. Trees are
    trained and asked on distinct rows only, as many as features and target have combinations.
    """
    ensure_checkpoints(rows.sparkSession)
    split = ml_split(ml_features(rows), test_fraction)
    names = feature_columns(rows)
    train = split.filter(~F.col("is_test"))
    estimator = estimator_for(name, train)
    if name in GROUPED:
        return _fit_grouped(split, names, estimator)
    model = duration_pipeline(names, estimator).fit(train)
    return model, model.transform(split)


def regression_metrics(
    scored: DataFrame, label: str = TARGET, prediction: str = "prediction"
) -> DataFrame:
    """MAE (2 decimals) and R2 (4 decimals) of the held-out rows, and the row counts."""
    test = F.col("is_test") & F.col(prediction).isNotNull()
    error = F.when(test, F.col(label) - F.col(prediction))
    spread = F.count(error) * F.var_pop(F.when(test, F.col(label)))
    return scored.agg(
        rounded(F.avg(F.abs(error)), 2).alias("mae_seconds"),
        rounded(1 - F.try_divide(F.sum(error * error), spread), 4).alias("r2_score"),
        F.count_if(~F.col("is_test")).alias("train_rows"),
        F.count_if("is_test").alias("test_rows"),
    )


def fit_and_score(rows: DataFrame, name: str, test_fraction: float = 0.2) -> DataFrame:
    """One report row for one model. Starts jobs.

    Coefficients are reported for the linear model, and only without a category.
    """
    model, scored = fit(rows, name, test_fraction)
    names = feature_columns(rows)
    coefficients = F.lit(None).cast("map<string,double>")
    if name == "LinearRegression" and CATEGORY not in names:
        pairs = zip(names, model.stages[-1].coefficients.toArray())
        coefficients = F.create_map(
            *[F.lit(v) for n, c in pairs for v in (n, round(float(c), 4))]
        )
    return regression_metrics(scored).select(
        F.lit(name).alias("model"),
        F.lit(TARGET).alias("target"),
        F.lit(",".join(names)).alias("features"),
        (F.col("train_rows") + F.col("test_rows")).alias("sample_rows"),
        "mae_seconds",
        "r2_score",
        "train_rows",
        "test_rows",
        coefficients.alias("coefficients"),
    )


def rank_models(reports: DataFrame) -> DataFrame:
    """Reports (one row per model) ranked by MAE, then R2; rank 1 is the best."""
    order = Window.orderBy(*by("mae_seconds", "-r2_score", "model"))
    return reports.withColumn("place", F.row_number().over(order)).withColumn(
        "is_best", F.col("place") == 1
    )


def compare_models(
    rows: DataFrame, names: Sequence[str] = MODEL_NAMES, test_fraction: float = 0.2
) -> DataFrame:
    """All models on the same split, ranked. Starts jobs."""
    reports = [fit_and_score(rows, name, test_fraction) for name in names]
    return rank_models(reduce(DataFrame.unionByName, reports))
