"""The tables behind common charts."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywick.functions.values import not_nan
from tallywick.operators.association import correlation_matrix, lower_triangle
from tallywick.operators.bounds import broadcast_if
from tallywick.operators.grouping import crosstab, row_percent
from tallywick.operators.profiling import FENCE, QUARTILES, frequencies, per_column, with_fences
from tallywick.operators.ranking import quantiles, stacked, sums_before
from tallywick.operators.shaping import complete_pairs

# a Gaussian kernel is below 1e-17 of its peak beyond nine bandwidths


def _limits(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Least and greatest value per column; a constant gets a range of one around it."""
    found = per_column(df, columns, lambda _, x: [F.min(x).alias("lo"), F.max(x).alias("hi")])
    flat = F.col("lo") == F.col("hi")
    return found.select(
        "variable",
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    ).where(F.col("lo").isNotNull())


def _bin_of(value: Column, lo: Column, hi: Column, bins: int) -> Column:
    width = (hi - lo) / bins
    return F.least(F.floor((value - lo) / width), F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 20) -> DataFrame:
    """Equal-width bins, the last one closed on both sides, empty bins included."""
    limits = _limits(df, columns)
    counted = (
        stacked(df, columns)
        .where(F.col("value").isNotNull())
        .join(F.broadcast(limits), "variable")  # one row per listed column
        .groupBy("variable", _bin_of(F.col("value"), F.col("lo"), F.col("hi"), bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    width = (F.col("hi") - F.col("lo")) / bins
    frame = limits.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return frame.join(F.broadcast(counted), ["variable", "bin"], "left").select(
        "variable",
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("left_edge"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("right_edge"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def box_statistics(rows: DataFrame, groups: Sequence[str], value: str = "value", small: bool = False) -> DataFrame:
    """Quartiles, whiskers (last values inside the fences) and outlier counts per group.

    ``small`` states that the number of groups is bounded: their boxes are then
    broadcast, and no row is shuffled to the task of its group.
    """
    groups = list(groups)
    present = rows.select(*groups, not_nan(F.col(value)).alias("value")).na.drop()
    boxes = with_fences(quantiles(present, groups, QUARTILES, small=small), FENCE)
    placed = present.join(broadcast_if(boxes, small), groups)
    inside = F.col("value").between(F.col("low_fence"), F.col("high_fence"))
    box = [F.max(c).alias(c) for c in ("q1", "median", "q3")]
    return placed.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"),
        *box,
        F.min(F.when(inside, F.col("value"))).alias("low_whisker"),
        F.max(F.when(inside, F.col("value"))).alias("high_whisker"),
        F.count_if(~inside).alias("outliers"),
    )


def box_outliers(rows: DataFrame, groups: Sequence[str], value: str = "value", small: bool = False) -> DataFrame:
    """The values beyond the whiskers, one row per value and how often it occurs.

    ``small`` states that the number of groups is bounded: their boxes are then
    broadcast, and no row is shuffled to the task of its group.
    """
    groups = list(groups)
    present = rows.select(*groups, not_nan(F.col(value)).alias("value")).na.drop()
    boxes = with_fences(quantiles(present, groups, QUARTILES, small=small), FENCE)
    placed = present.join(broadcast_if(boxes, small), groups)
    beyond = placed.where(~F.col("value").between(F.col("low_fence"), F.col("high_fence")))
    return beyond.groupBy(*groups, "value").agg(F.count(F.lit(1)).alias("n"))


def column_boxes(df: DataFrame, columns: Sequence[str], log10: bool = False) -> DataFrame:
    """Box statistics of several columns; with ``log10`` of the positive values' logarithm."""
    long = stacked(df, columns)
    if log10:
        long = long.withColumn("value", F.when(F.col("value") > 0, F.log10("value")))
    return box_statistics(long, ["variable"], small=True)  # one group per listed column


#: bandwidths beyond which exp(-z*z/2) is exactly 0.0 in doubles (below the smallest subnormal)
UNDERFLOW_REACH = 39.0
#: Taylor terms per bin; with |d| <= 1/4 the series is exact to double rounding wherever a kernel counts
TERMS = 30


def density(df: DataFrame, columns: Sequence[str], points: int = 1000) -> DataFrame:
    """Gaussian kernel density with Scott's bandwidth, on a grid half a range beyond both ends.

    No row is copied to grid points.  Each value falls into one bin of width h/2
    and adds ``exp(-d*d/2) d^m / m!`` (d its distance to the bin's centre in
    bandwidths, m < TERMS) to the bin's moments, summed before the shuffle.  A
    grid point at u bandwidths from a centre then gets ``exp(-u*u/2)`` times the
    moments' polynomial in u (Horner), which is the sum of the bin's kernels,
    since ``exp(-(u-d)^2/2) = exp(-u*u/2) exp(u d) exp(-d*d/2)``.  Bins reach
    UNDERFLOW_REACH bandwidths, beyond which every kernel is 0.0 in doubles, so
    the result equals the sum over all values up to rounding.  Columns with
    fewer than two values or without spread are left out.
    """

    def measures(_: str, x: Column) -> list[Column]:
        n, lo, hi = F.count(x), F.min(x), F.max(x)
        return [
            n.alias("n"),
            (lo - 0.5 * (hi - lo)).alias("start"),
            (2.0 * (hi - lo) / (points - 1)).alias("step"),
            (F.stddev_samp(x) * F.pow(n.cast("double"), F.lit(-0.2))).alias("h"),
        ]

    setup = per_column(df, columns, measures).where((F.col("n") >= 2) & (F.col("h") > 0))
    placed = stacked(df, columns).where(F.col("value").isNotNull()).join(F.broadcast(setup), "variable")  # one row per listed column
    width = F.col("h") / 2
    binned = placed.withColumn("bin", F.floor((F.col("value") - F.col("start")) / width)).withColumn(
        "d", (F.col("value") - (F.col("start") + (F.col("bin") + 0.5) * width)) / F.col("h")
    )
    weight = F.exp(-0.5 * F.col("d") * F.col("d"))
    moments = binned.groupBy("variable", "bin").agg(
        F.array(*[F.sum(weight * F.pow("d", F.lit(float(m)))) / float(math.factorial(m)) for m in range(TERMS)]).alias("moments")
    )
    centre = F.col("start") + (F.col("bin") + 0.5) * width
    reach = UNDERFLOW_REACH * F.col("h")
    first = F.greatest(F.lit(0), F.ceil((centre - reach - F.col("start")) / F.col("step")))
    last = F.least(F.lit(points - 1), F.floor((centre + reach - F.col("start")) / F.col("step")))
    # one row per bin and grid point in reach: bounded by bins x points, whatever the number of rows
    near = (
        moments.join(F.broadcast(setup), "variable")
        .where(first <= last)
        .select("variable", "moments", centre.alias("centre"), "h", "start", "step", F.explode(F.sequence(first.cast("int"), last.cast("int"))).alias("point"))
    )
    u = (F.col("start") + F.col("point") * F.col("step") - F.col("centre")) / F.col("h")
    series = F.aggregate(F.reverse("moments"), F.lit(0.0), lambda total, c: total * F.col("u") + c)
    sums = near.withColumn("u", u).groupBy("variable", "point").agg(F.sum(F.exp(-0.5 * F.col("u") * F.col("u")) * series).alias("kernels"))
    grid = setup.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    scale = F.col("n") * F.col("h") * math.sqrt(2 * math.pi)
    return grid.join(sums, ["variable", "point"], "left").select(
        "variable",
        "point",
        (F.col("start") + F.col("point") * F.col("step")).alias("x_value"),
        (F.coalesce("kernels", F.lit(0.0)) / scale).alias("density"),
    )


def category_bars(df: DataFrame, columns: Sequence[str], share: bool = False) -> DataFrame:
    """Bar heights per category, counts or shares, in category order."""
    height = F.col("percent") / 100.0 if share else F.col("n")
    return frequencies(df, columns).select("variable", "category", height.alias("height")).orderBy("variable", "category")


def scatter_points(df: DataFrame, x: str, y: str, key: str) -> DataFrame:
    """Every complete point with its key."""
    return complete_pairs(df, x, y, [key])


def scatter_bins(df: DataFrame, x: str, y: str, bins: int = 50) -> DataFrame:
    """Complete points counted on a grid of ``bins`` by ``bins`` equal cells."""
    points = df.select(not_nan(F.col(x)).alias("x"), not_nan(F.col(y)).alias("y")).na.drop()
    edges = points.agg(
        F.struct(*[f(c).alias(f"{f.__name__}_{c}") for c in ("x", "y") for f in (F.min, F.max)])
    ).scalar()

    def cell(c: str) -> Column:
        lo, hi = edges[f"min_{c}"], edges[f"max_{c}"]
        flat = lo == hi
        return _bin_of(F.col(c), F.when(flat, lo - 0.5).otherwise(lo), F.when(flat, hi + 0.5).otherwise(hi), bins)

    return points.groupBy(cell("x").alias("x_bin"), cell("y").alias("y_bin")).agg(F.count(F.lit(1)).alias("n"))


def stacked_bars(df: DataFrame, x: str, y: str, percent: bool = True) -> DataFrame:
    """Height and base of every segment of a stacked bar chart, stacked in y order.

    Bases are running totals over range partitions (:func:`sums_before`), so a
    bar of millions of segments is spread over tasks, not one window.
    """
    cells = row_percent(crosstab(df, x, y, missing=False), x)
    height = F.col("percent") if percent else F.col("n").cast("double")
    return sums_before(cells.select(x, y, height.alias("height")), [x], [y], "height").withColumnRenamed("before", "base")


def heat_map(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cells of a correlation heat map: the lower triangle in long form."""
    return lower_triangle(correlation_matrix(df, columns)).select("x", "y", "r")
