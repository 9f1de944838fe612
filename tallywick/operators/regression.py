"""Regression models on Spark ML and the tables that compare them.

Imputation and scaling are fitted inside the pipeline, on training rows only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywick.operators.features import MedianScaler, columns_with_gaps, split_by_key, with_fold


def linear_model(target: str) -> LinearRegression:
    """Ordinary least squares by the normal equations, summed up in one pass."""
    return LinearRegression(labelCol=target, regParam=0.0, solver="normal", standardization=False)


def forest_model(target: str, trees: int = 500, depth: int = 30, bins: int = 32, seed: int = 42) -> RandomForestRegressor:
    """Random forest that looks at all features in every split."""
    return RandomForestRegressor(
        labelCol=target,
        numTrees=trees,
        maxDepth=depth,
        maxBins=bins,
        featureSubsetStrategy="all",
        seed=seed,
    )


def pipeline(features: Sequence[str], estimator: Estimator, impute: Sequence[str] | None = None) -> Pipeline:
    return Pipeline(stages=[MedianScaler(features, impute=impute), estimator])


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """MAE, RMSE and R2 of a prediction table in one pass."""
    rows = df.select(F.col(actual).cast("double").alias("y"), F.col(predicted).cast("double").alias("f")).na.drop()
    error = F.col("y") - F.col("f")
    sums = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.var_pop("y").alias("spread"),
    )
    return sums.select("n", "mae", F.sqrt("mse").alias("rmse"), (1 - F.try_divide("mse", "spread")).alias("r2"))


def _settled(table: DataFrame, source: DataFrame) -> DataFrame:
    """A table of a few result rows, computed now so that its cached source can go."""
    rows = table.collect()
    source.unpersist()
    return table.sparkSession.createDataFrame(rows, table.schema)


def train(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    target: str,
    estimators: Mapping[str, Estimator],
    percent: int = 80,
    leaky: bool = False,
    spread: bool = False,
) -> tuple[dict[str, PipelineModel], DataFrame]:
    """Fits every estimator on the training part and scores it on the rest.

    Returns the fitted models and one row of metrics per estimator.  ``leaky``
    fits imputation and scaling on all rows, only to compare.  ``spread``
    redistributes the rows by key before they are cached, for sources that arrive
    in few partitions: every pass of a fit then uses all executors.
    """
    models, scores = train_targets(df, key, features, {target: estimators}, percent, leaky, spread)
    return models[target], scores


def train_targets(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    estimators: Mapping[str, Mapping[str, Estimator]],
    percent: int = 80,
    leaky: bool = False,
    spread: bool = False,
) -> tuple[dict[str, dict[str, PipelineModel]], DataFrame]:
    """:func:`train` for several targets, ``estimators`` by target, over one cached copy of the rows.

    The key only decides the part and is not cached.  Imputation and scaling are
    fitted once for all targets where none has a gap, else per target on its rows.
    """
    targets = list(estimators)
    rows = df.select(key, *targets, *features).na.drop(how="all", subset=targets)
    rows = split_by_key(rows.repartition(key) if spread else rows, key, percent)
    rows = rows.select("part", *targets, *features).persist(StorageLevel.MEMORY_AND_DISK)
    gaps = len(targets) > 1 and not rows.where(F.array_contains(F.array(*[F.col(t).isNull() for t in targets]), True)).isEmpty()
    models, tables, scaler = {}, [], None
    for target in targets:
        own = rows.na.drop(subset=[target])
        training, holdout = own.where("part = 'train'"), own.where("part = 'test'")
        if scaler is None or gaps:
            scaler = MedianScaler(features).fit(own if leaky else training)
        models[target] = {}
        for name, estimator in estimators[target].items():
            fitted = PipelineModel(stages=[scaler, estimator.fit(scaler.transform(training))])
            models[target][name] = fitted
            scores = regression_metrics(fitted.transform(holdout), target, "prediction")
            tables.append(scores.select(F.lit(target).alias("target"), F.lit(name).alias("model"), "*"))
    # one row per target and estimator
    return models, _settled(reduce(lambda a, b: a.unionByName(b), tables), rows)


def fold_scores(
    df: DataFrame, key: str, features: Sequence[str], target: str, estimator: Estimator, folds: int = 5
) -> DataFrame:
    """R2 of every fold; each fold is scored by a model fitted on the others."""
    rows = with_fold(df.select(key, target, *features).na.drop(subset=[target]), key, folds)
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    gaps = columns_with_gaps(rows, features)  # the models are not used on other tables
    tables = []
    for fold in range(folds):
        model = pipeline(features, estimator, gaps).fit(rows.where(F.col("fold") != fold))
        scores = regression_metrics(model.transform(rows.where(F.col("fold") == fold)), target, "prediction")
        tables.append(scores.select(F.lit(fold).alias("fold"), "n", "r2"))
    return _settled(reduce(lambda a, b: a.unionByName(b), tables), rows)  # one row per fold


def fold_summary(scores: DataFrame) -> DataFrame:
    """Mean and population standard deviation over the folds."""
    return scores.agg(F.count("r2").alias("folds"), F.avg("r2").alias("mean_r2"), F.stddev_pop("r2").alias("std_r2"))


def grid_search(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    target: str,
    estimator: Estimator,
    grid: Mapping[str, Sequence],
    folds: int = 5,
) -> tuple[PipelineModel, DataFrame]:
    """Every setting of a parameter grid scored by cross-validation.

    Returns the pipeline refitted with the best setting on all rows, and one
    row per setting with its mean and population standard deviation of R2 over
    the folds.  Each fold's imputation and scaling is fitted once, on that
    fold's training rows, and shared by all settings: the prepared rows are
    cached and every setting's model is fitted on them (``fitMultiple``).
    """
    import numpy as np

    rows = with_fold(df.select(key, target, *features).na.drop(subset=[target]), key, folds)
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    settings = builder.build()
    gaps = columns_with_gaps(rows, features)
    evaluator = RegressionEvaluator(labelCol=target, metricName="r2")
    metrics = np.zeros((len(settings), folds))
    for fold in range(folds):
        training = rows.where(F.col("fold") != fold)
        scaler = MedianScaler(features, impute=gaps).fit(training)
        prepared = scaler.transform(training).persist(StorageLevel.MEMORY_AND_DISK)
        checked = scaler.transform(rows.where(F.col("fold") == fold))
        for index, fitted in estimator.fitMultiple(prepared, settings):
            metrics[index, fold] = evaluator.evaluate(fitted.transform(checked))
        prepared.unpersist()
    means, spreads = metrics.mean(axis=1), metrics.std(axis=1)
    best = int(np.argmax(means))
    table = [
        (*[str(setting[estimator.getParam(name)]) for name in grid], float(mean), float(std), bool(i == best))
        for i, (setting, mean, std) in enumerate(zip(settings, means, spreads))
    ]
    names = [*grid, "mean_r2", "std_r2", "best"]
    types = ["string"] * len(grid) + ["double", "double", "boolean"]
    schema = ", ".join(f"`{n}` {t}" for n, t in zip(names, types))
    # refitted on all rows, with a fill value for every column of tables to come
    scaler = MedianScaler(features).fit(rows)
    model = PipelineModel(stages=[scaler, estimator.fit(scaler.transform(rows), settings[best])])
    rows.unpersist()
    return model, df.sparkSession.createDataFrame(table, schema)


def importances(spark: SparkSession, model: Model, features: Sequence[str]) -> DataFrame:
    """Importance of every feature, descending; one row per feature name."""
    fitted = model.stages[-1] if isinstance(model, PipelineModel) else model
    rows = [(name, float(x)) for name, x in zip(features, fitted.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def scored(model: Model, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """A whole table with the model's prediction."""
    return model.transform(df).select(*keep, "prediction")
