"""Feature engineering: labels, bands, scaling, imputation, stable splits."""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywick.functions.values import banded, key_hash, labelled, not_nan
from tallywick.operators.profiling import per_column
from tallywick.operators.ranking import quantiles, stacked


def with_labels(df: DataFrame, column: str, labels: Mapping, target: str) -> DataFrame:
    return df.withColumn(target, labelled(F.col(column), labels))


def with_bands(
    df: DataFrame, column: str, edges: Sequence[float], names: Sequence[str], target: str, closed: str = "right"
) -> DataFrame:
    return df.withColumn(target, banded(F.col(column), edges, names, closed))


def _location_and_spread(df: DataFrame, columns: Sequence[str], spread) -> Column:
    """Means and standard deviations of all columns as one scalar struct."""
    parts = [
        F.struct(F.avg(not_nan(F.col(c))).alias("mean"), spread(not_nan(F.col(c))).alias("std")).alias(c)
        for c in columns
    ]
    return df.agg(F.struct(*parts)).scalar()


def with_z_scores(df: DataFrame, columns: Sequence[str], suffix: str = "_zscore") -> DataFrame:
    """Z-scores with the sample standard deviation, NULL where it is 0 or undefined."""
    stats = _location_and_spread(df, columns, F.stddev_samp)
    scores = {c + suffix: (F.col(c) - stats[c]["mean"]) / F.nullif(stats[c]["std"], F.lit(0.0)) for c in columns}
    return df.withColumns(scores)


def standardised_columns(df: DataFrame, columns: Sequence[str], suffix: str = "_std") -> DataFrame:
    """Centred columns over the population standard deviation; a constant becomes 0."""
    stats = _location_and_spread(df, columns, F.stddev_pop)

    def scaled(c: str) -> Column:
        spread = stats[c]["std"]
        return (F.col(c) - stats[c]["mean"]) / F.when(spread == 0, F.lit(1.0)).otherwise(spread)

    return df.withColumns({c + suffix: scaled(c) for c in columns})


def column_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact median of every column."""
    return quantiles(stacked(df, columns), ["variable"], {"median": 0.5}, small=True)


def with_medians_filled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing values replaced by the exact median of their column."""
    # one entry per listed column
    entries = F.map_from_entries(F.collect_list(F.struct("variable", "median")))
    medians = column_medians(df, columns).agg(entries).scalar()
    filled = {c: F.coalesce(not_nan(F.col(c)), F.try_element_at(medians, F.lit(c))) for c in columns}
    return df.withColumns(filled)


def split_by_key(df: DataFrame, key: str, percent: int = 80, target: str = "part") -> DataFrame:
    """Marks every row ``train`` or ``test`` by a hash of its key.

    A row keeps its part under any partitioning or order; the share is close to
    ``percent``, not exactly it.
    """
    return df.withColumn(
        target, F.when(key_hash(F.col(key), 100) < percent, F.lit("train")).otherwise(F.lit("test"))
    )


def with_fold(df: DataFrame, key: str, folds: int = 5, target: str = "fold") -> DataFrame:
    return df.withColumn(target, key_hash(F.col(key), folds))


def columns_with_gaps(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The columns that have a missing value anywhere; one row comes back."""
    gaps = df.agg(*[F.count_if(not_nan(F.col(c)).isNull()).alias(c) for c in columns]).first()
    return [c for c in columns if gaps[c]]


class _ScalerParams(Params):
    inputCols = Param(Params._dummy(), "inputCols", "columns to impute and scale", TypeConverters.toListString)  # noqa: N815
    outputCol = Param(Params._dummy(), "outputCol", "vector column written", TypeConverters.toString)  # noqa: N815
    imputeCols = Param(Params._dummy(), "imputeCols", "columns whose gaps take the median", TypeConverters.toListString)  # noqa: N815

    @property
    def columns(self) -> list[str]:
        return self.getOrDefault(self.inputCols)

    @property
    def output(self) -> str:
        return self.getOrDefault(self.outputCol)


class MedianScaler(Estimator, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Imputes with the exact median, standardises, and assembles a vector.

    Unlike ``Imputer`` the median interpolates, and unlike ``StandardScaler``
    the spread is the population one.  As a pipeline stage it sees only the
    rows the pipeline is fitted on.  ``impute`` lists the columns that may have
    gaps; by default all of them may.  The stage and its model are saved and
    loaded like Spark ML's own (``write().save(path)``, ``load(path)``), also
    inside a saved pipeline.
    """

    def __init__(self, columns: Sequence[str] = (), output: str = "features", impute: Sequence[str] | None = None):
        super().__init__()
        self._set(inputCols=list(columns), outputCol=output, imputeCols=list(columns if impute is None else impute))

    @property
    def impute(self) -> list[str]:
        return self.getOrDefault(self.imputeCols)

    def _fit(self, dataset: DataFrame) -> MedianScalerModel:
        def measures(_: str, x: Column) -> list[Column]:
            n = F.count(x)
            return [n.alias("n"), (F.count(F.lit(1)) - n).alias("gaps"), F.avg(x).alias("mean"), F.var_pop(x).alias("spread")]

        # both collects return one row per column of the list
        found = per_column(dataset, self.columns, measures).collect()
        medians = {}
        if self.impute:
            medians = {r["variable"]: r["median"] for r in column_medians(dataset, self.impute).collect()}
        stats = {}
        for r in found:
            n, gaps, fill = r["n"], r["gaps"], medians.get(r["variable"], 0.0)
            if n == 0:  # no value at all: every gap becomes 0
                medians[r["variable"]] = 0.0
                stats[r["variable"]] = (0.0, 1.0)
                continue
            if r["variable"] not in medians:
                gaps = 0
            # mean and variance of the filled column follow from those of the values
            mean = (n * r["mean"] + gaps * fill) / (n + gaps)
            spread = (n * (r["spread"] + (r["mean"] - mean) ** 2) + gaps * (fill - mean) ** 2) / (n + gaps)
            stats[r["variable"]] = (mean, math.sqrt(spread) or 1.0)
        return MedianScalerModel(self.columns, self.output, medians, stats)


class MedianScalerModel(Model, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Medians and (mean, std) per column, kept as JSON parameters so that the model is saved with them."""

    mediansJson = Param(Params._dummy(), "mediansJson", "median per imputed column", TypeConverters.toString)  # noqa: N815
    statsJson = Param(Params._dummy(), "statsJson", "mean and std per column", TypeConverters.toString)  # noqa: N815

    def __init__(self, columns=(), output="features", medians=None, stats=None):
        super().__init__()
        self._set(
            inputCols=list(columns), outputCol=output, mediansJson=json.dumps(medians or {}), statsJson=json.dumps({k: list(v) for k, v in (stats or {}).items()})
        )

    @property
    def medians(self) -> dict[str, float]:
        return json.loads(self.getOrDefault(self.mediansJson))

    @property
    def stats(self) -> dict[str, tuple[float, float]]:
        return {k: tuple(v) for k, v in json.loads(self.getOrDefault(self.statsJson)).items()}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        medians, stats = self.medians, self.stats

        def scaled(c: str) -> Column:
            mean, std = stats[c]
            value = not_nan(F.col(c))
            if c in medians:
                value = F.coalesce(value, F.lit(medians[c]))
            return (value - F.lit(mean)) / F.lit(std)

        return dataset.withColumn(self.output, array_to_vector(F.array(*map(scaled, self.columns))))

