"""One-variable summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywick.functions.values import not_nan
from tallywick.operators.ranking import quantiles, smallest_mode, stacked, value_counts

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
FENCE = 1.5


def per_column(df: DataFrame, columns: Sequence[str], measures) -> DataFrame:
    """One row per column from a single aggregation without a reshape.

    ``measures(name, value)`` gives the aggregate columns of one variable.
    """
    rows = [F.struct(F.lit(c).alias("variable"), *measures(c, not_nan(F.col(c)))) for c in columns]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def adjusted_skewness(x: Column) -> Column:
    """Sample skewness; NULL below three values, 0 for a constant."""
    n = F.count(x).cast("double")
    factor = F.sqrt(n * (n - 1)) / (n - 2)
    return F.when(n < 3, None).when(F.min(x) == F.max(x), 0.0).otherwise(F.skewness(x) * factor)


def moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """n, missing, mean, variance, std, min, max and skewness of every column in one pass."""

    def measures(_: str, x: Column) -> list[Column]:
        return [
            F.count(x).alias("n"),
            (F.count(F.lit(1)) - F.count(x)).alias("missing"),
            F.avg(x).alias("mean"),
            F.var_samp(x).alias("variance"),
            F.stddev_samp(x).alias("std"),
            F.min(x).alias("min"),
            F.max(x).alias("max"),
            adjusted_skewness(x).alias("skewness"),
        ]

    return per_column(df, columns, measures)


def with_fences(quartiles: DataFrame, reach: float = FENCE) -> DataFrame:
    """Adds ``iqr``, ``low_fence`` and ``high_fence`` to q1 and q3."""
    iqr = F.col("q3") - F.col("q1")
    return quartiles.withColumns(
        {
            "iqr": iqr,
            "low_fence": F.col("q1") - reach * iqr,
            "high_fence": F.col("q3") + reach * iqr,
        }
    )


def _outside(value: Column) -> Column:
    beyond = (value < F.col("low_fence")) | (value > F.col("high_fence"))
    return beyond & (F.col("iqr") != 0)


def outlier_counts(counts: DataFrame, fences: DataFrame) -> DataFrame:
    """Values beyond the fences, 0 where the IQR is 0.

    ``fences`` has one row per variable of a fixed list, so it is broadcast.
    """
    hit = F.when(_outside(F.col("value")), F.col("n")).otherwise(F.lit(0))
    return (
        counts.join(F.broadcast(fences), "variable")
        .groupBy("variable")
        .agg(F.sum(hit).alias("outliers"))
    )


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Full numeric profile, one row per column.

    ``n`` counts all rows, ``missing`` those without a value; with one value the
    variance and std are 0, with none they are NULL.

    Two scans, both lazy: the moments in one aggregation, and one shuffle of
    (variable, value) counts that mode, quartiles and outlier counts share.
    """
    rows = stacked(df, columns)
    counts = value_counts(rows, ["variable"])
    quartiles = with_fences(quantiles(counts, ["variable"], QUARTILES, weight="n"))
    parts = [quartiles, smallest_mode(counts, ["variable"]), outlier_counts(counts, quartiles)]
    summary = moments(df, columns)
    for part in parts:  # one row per listed variable on each side
        summary = summary.join(F.broadcast(part), "variable", "left")
    # n counts every row, missing ones too; one value has no spread (0), none has none (NULL)
    single = F.col("n") == 1
    summary = summary.withColumns(
        {
            "n": F.col("n") + F.col("missing"),
            "variance": F.when(single, F.lit(0.0)).otherwise(F.col("variance")),
            "std": F.when(single, F.lit(0.0)).otherwise(F.col("std")),
        }
    )
    return summary.select(
        "variable", "n", "missing", "mean", "median", "mode", "variance", "std", "iqr", "q1", "q3",
        "min", "max", "skewness", F.coalesce("outliers", F.lit(0)).alias("outliers"),
    )


def frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count and percent of every category, NULL being a category of its own.

    NULL is counted, so every variable has as many rows as the table and the
    percent needs no window.
    """
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    rows = df.agg(F.count(F.lit(1)).alias("rows"))
    return (
        texts.unpivot([], list(columns), "variable", "category")
        .groupBy("variable", "category")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("percent", 100.0 * F.col("n") / rows.scalar())
    )


def missing_counts(df: DataFrame) -> DataFrame:
    """NULLs of every column, plus a row named ``(all)`` with their sum."""
    nulls = {c: F.count(F.lit(1)) - F.count(F.col(c)) for c in df.columns}
    rows = [F.struct(F.lit(c).alias("variable"), n.alias("missing")) for c, n in nulls.items()]
    whole = F.struct(F.lit("(all)").alias("variable"), sum(nulls.values(), F.lit(0)).alias("missing"))
    return df.agg(F.array(*rows, whole).alias("rows")).select(F.inline("rows"))


def table_shape(df: DataFrame, stage: str) -> DataFrame:
    """Rows and columns of a table at a named stage."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(stage).alias("stage"), "rows", F.lit(len(df.columns)).alias("columns")
    )
