"""Crosstabs and group summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywick.functions.values import not_nan
from tallywick.operators.ranking import quantiles


def crosstab(df: DataFrame, x: str, y: str, missing: bool = True) -> DataFrame:
    """Counts of every pair of categories that occurs, in long form.

    ``missing=True`` keeps NULL as a category of its own.
    """
    pairs = df.select(x, y)
    pairs = pairs if missing else pairs.na.drop()
    return pairs.groupBy(x, y).agg(F.count(F.lit(1)).alias("n"))


def listed_only(column: Column, names: Sequence[str], what: str) -> Column:
    """The column's text, or a run-time error for a value outside ``names`` (NULL passes).

    Refusing is lazy: the check is part of the plan and costs no extra job.
    """
    text = column.cast("string")
    message = F.concat(F.lit(f"{what} is not listed: "), text)
    return F.when(text.isNull() | text.isin(list(names)), text).otherwise(F.raise_error(message).cast("string"))


def full_crosstab(df: DataFrame, x: str, y: str, y_values: Sequence) -> DataFrame:
    """Crosstab without NULLs in which empty cells are zeros, in long form.

    The pivot creates the empty cells; ``y_values`` lists the categories of y.
    A y value outside the list stops the job with an error rather than vanish.
    """
    names = [str(v) for v in y_values]
    wide = df.select(x, listed_only(F.col(y), names, y).alias(y)).na.drop().groupBy(x).pivot(y, names).count()
    return wide.na.fill(0, subset=names).unpivot([x], names, y, "n")


def with_margins(cells: DataFrame, margins: Mapping[str, Sequence[str]]) -> DataFrame:
    """Adds the sums of ``n`` over the cells that share some keys, NULLs being equal.

    ``margins`` maps the name of a sum to its keys.  Margins are added up and
    joined back: a window would hold all cells of a frequent category in one
    task.
    """
    placed = cells
    for name, keys in margins.items():
        margin = cells.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.sum("n").alias(name))
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
        placed = placed.join(margin, same).drop(*[f"_{k}" for k in keys])
    return placed


def row_percent(cells: DataFrame, x: str, digits: int | None = None) -> DataFrame:
    """Share of every cell in its row, NULL for an empty row."""
    percent = F.try_divide(100.0 * F.col("n"), F.col("row_n"))
    placed = with_margins(cells, {"row_n": [x]})
    return placed.withColumn("percent", percent if digits is None else F.round(percent, digits)).drop("row_n")


def group_summary(
    df: DataFrame,
    group: str,
    value: str,
    limits: bool = False,
    digits: int | None = None,
) -> DataFrame:
    """n, mean, median and std per group, with min and max on request.

    The std of a single value is 0.  Rows without group or value do not count.
    """
    rows = df.select(group, not_nan(F.col(value)).alias("value")).na.drop()
    measures = [
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.coalesce(F.stddev_samp("value"), F.lit(0.0)).alias("std"),
    ]
    if limits:
        measures += [F.min("value").alias("min"), F.max("value").alias("max")]
    medians = quantiles(rows, [group], {"median": 0.5})
    summary = rows.groupBy(group).agg(*measures).join(medians, group)
    order = ["n", "mean", "median", "std"] + (["min", "max"] if limits else [])

    def shown(name: str) -> Column:
        return F.col(name) if digits is None or name == "n" else F.round(name, digits).alias(name)

    return summary.select(group, *[shown(name) for name in order])


def group_summaries(df: DataFrame, pairs: Sequence[tuple[str, str]], labels: Mapping[str, str] | None = None) -> DataFrame:
    """Group summaries of several (value, group) pairs in one report, from one reshape."""
    rows = F.array(
        *[
            F.struct(
                F.lit((labels or {}).get(value, value)).alias("variable"),
                F.lit(group).alias("grouping"),
                F.col(group).cast("string").alias("category"),
                not_nan(F.col(value)).alias("value"),
            )
            for value, group in pairs
        ]
    )
    long = df.select(F.inline(rows)).na.drop()
    keys = ["variable", "grouping", "category"]
    medians = quantiles(long, keys, {"median": 0.5})
    return (
        long.groupBy(*keys)
        .agg(
            F.count("value").alias("n"),
            F.avg("value").alias("mean"),
            F.coalesce(F.stddev_samp("value"), F.lit(0.0)).alias("std"),
        )
        .join(medians, keys)
        .select(*keys, "n", "mean", "median", "std")
    )
