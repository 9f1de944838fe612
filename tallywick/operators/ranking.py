"""Exact quantiles, modes and average ranks without a global sort.

Spark's ``percentile``, ``median`` and ``mode`` keep every distinct value of a
group in the memory of one task.  Here bucket totals are sorted instead of
values: first at most about 270,000 coarse buckets per group, then the fine
buckets of the few coarse ones that hold a wanted rank, then the values of
those fine buckets.  All three steps are map-side combined counts, so no step
shuffles the rows themselves and a value that fills a third of the table is one
row after the first combine.  The plan is one lazy DataFrame whatever the
data: nothing is counted or collected while it is built, and the planner (with
adaptive execution) chooses broadcasts from measured sizes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywick.functions.ordering import coarse_bucket, fine_bucket
from tallywick.functions.values import not_nan
from tallywick.operators.bounds import broadcast_if


def stacked(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Numeric columns as rows ``(keep..., variable, value)``; NaN becomes NULL."""
    prepared = df.select(*keep, *[not_nan(F.col(c)).alias(c) for c in columns])
    return prepared.unpivot(list(keep), list(columns), "variable", "value")


def value_counts(df: DataFrame, groups: Sequence[str], value: str = "value") -> DataFrame:
    """How often every value occurs in its group; missing values are left out."""
    present = df.where(F.col(value).isNotNull())
    return present.groupBy(*groups, value).agg(F.count(F.lit(1)).alias("n"))


def smallest_mode(counts: DataFrame, groups: Sequence[str], value: str = "value", small: bool = False) -> DataFrame:
    """Most frequent value of every group, the smallest one on ties.

    Two hash aggregations of the counts; picking a whole record per group would
    sort them.  ``small`` states that the number of groups is bounded.
    """
    most = counts.groupBy(*groups).agg(F.max("n").alias("most"))
    return (
        counts.join(broadcast_if(most, small), list(groups))
        .where(F.col("n") == F.col("most"))
        .groupBy(*groups)
        .agg(F.min(value).alias("mode"))
    )


def _wanted(probabilities: Sequence[float], total: Column) -> Column:
    """Zero-based ranks on both sides of every quantile position."""
    positions = [F.lit(float(p)) * (total - 1) for p in probabilities]
    return F.array_distinct(F.array(*[f(p) for p in positions for f in (F.floor, F.ceil)]))


def _holding(totals: DataFrame, by: Sequence[str], order: str, probabilities: Sequence[float]) -> DataFrame:
    """Buckets that hold a wanted rank, with the count before them and the group size."""
    running = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    upto = totals.withColumn("upto", F.col("before") + F.sum("n").over(running))
    first = F.col("upto") - F.col("n")
    inside = F.exists(
        _wanted(probabilities, F.col("total")),
        lambda rank: (rank >= first) & (rank < F.col("upto")),
    )
    return upto.where(inside).withColumn("before", first)


def quantiles(
    df: DataFrame,
    groups: Sequence[str],
    probabilities: Mapping[str, float],
    value: str = "value",
    weight: str | None = None,
    small: bool = False,
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group.

    ``probabilities`` maps output names to shares.  ``weight`` names a column of
    repeat counts, as in :func:`value_counts`, whose values are never missing.
    ``small`` states that the number of groups is bounded: the buckets that hold a
    wanted rank, at most two per share and group, are then broadcast.
    Rows whose group key is NULL are left out.  No job runs while the plan is
    built, and no task holds more than one bucket's values.
    """
    groups = list(groups)
    source = df.select(
        *groups,
        not_nan(F.col(value)).alias("v"),
        (F.col(weight) if weight else F.lit(1)).cast("bigint").alias("w"),
    )
    for key in groups:
        source = source.where(F.col(key).isNotNull())
    if weight is None:  # counted values are present already
        source = source.where(F.col("v").isNotNull())
    return _bucket_quantiles(source, groups, probabilities, small)


def _bucket_quantiles(source: DataFrame, groups: Sequence[str], probabilities: Mapping[str, float], small: bool) -> DataFrame:
    """Quantiles of any number of distinct values, in three levels of buckets."""
    shares = list(probabilities.values())
    source = source.withColumn("fine", fine_bucket(F.col("v"))).withColumn(
        "coarse", coarse_bucket(F.col("fine"))
    )

    whole = Window.partitionBy(*groups)
    coarse = source.groupBy(*groups, "coarse").agg(F.sum("w").alias("n"))
    coarse = coarse.withColumn("total", F.sum("n").over(whole))
    coarse = coarse.withColumn("before", F.lit(0).cast("bigint"))
    coarse = _holding(coarse, groups, "coarse", shares).select(*groups, "coarse", "before", "total")

    fine = (
        source.join(broadcast_if(coarse, small), [*groups, "coarse"])
        .groupBy(*groups, "coarse", "fine")
        .agg(F.sum("w").alias("n"), F.max("before").alias("before"), F.max("total").alias("total"))
    )
    fine = _holding(fine, [*groups, "coarse"], "fine", shares).select(*groups, "fine", "before", "total")

    values = (
        source.join(broadcast_if(fine, small), [*groups, "fine"])
        .groupBy(*groups, "fine", "v")
        .agg(F.sum("w").alias("n"), F.max("before").alias("before"), F.max("total").alias("total"))
    )
    values = _holding(values, [*groups, "fine"], "v", shares)

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("before")) & (rank < F.col("upto")), F.col("v")))

    parts = []
    for i, p in enumerate(shares):
        position = F.lit(float(p)) * (F.col("total") - 1)
        parts += [at(F.floor(position)).alias(f"low_{i}"), at(F.ceil(position)).alias(f"high_{i}")]
    picked = values.groupBy(*groups).agg(F.max("total").alias("total"), *parts)

    def interpolated(i: int, p: float) -> Column:
        position = F.lit(float(p)) * (F.col("total") - 1)
        low, high = F.col(f"low_{i}"), F.col(f"high_{i}")
        # equal neighbours first: a difference of infinities would be NaN
        return F.when(low == high, low).otherwise(low + (high - low) * (position - F.floor(position)))

    return picked.select(*groups, *[interpolated(i, p).alias(n) for i, (n, p) in enumerate(probabilities.items())])


def quick_quantiles(
    df: DataFrame,
    groups: Sequence[str],
    probabilities: Mapping[str, float],
    value: str = "value",
    accuracy: int = 10_000,
) -> DataFrame:
    """Approximate quantiles in one pass (a data value, rank error 1/accuracy)."""
    shares = [float(p) for p in probabilities.values()]
    sketch = F.percentile_approx(not_nan(F.col(value)), F.array(*map(F.lit, shares)), F.lit(accuracy))
    picked = df.groupBy(*groups).agg(sketch.alias("picked"))
    return picked.select(*groups, *[F.get("picked", F.lit(i)).alias(n) for i, n in enumerate(probabilities)])


def average_ranks(counts: DataFrame, groups: Sequence[str], value: str = "value", small: bool = False) -> DataFrame:
    """Average rank of every value: ``(groups..., value, rank, total)``.

    ``counts`` comes from :func:`value_counts`.  The running count is built in
    three levels (coarse buckets, fine buckets, values), each window holding one
    bucket of the level above.  ``small`` states that the number of groups is
    bounded; the coarse level has at most about 270,000 rows per group.
    """
    groups = list(groups)
    keyed = counts.withColumn("fine", fine_bucket(F.col(value))).withColumn(
        "coarse", coarse_bucket(F.col("fine"))
    )

    def before(window_keys: Sequence[str], order: str) -> Column:
        running = Window.partitionBy(*window_keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return F.sum("n").over(running) - F.col("n")

    fine = keyed.groupBy(*groups, "coarse", "fine").agg(F.sum("n").alias("n"))
    coarse = fine.groupBy(*groups, "coarse").agg(F.sum("n").alias("n"))
    coarse = coarse.select(
        *groups,
        "coarse",
        before(groups, "coarse").alias("coarse_before"),
        F.sum("n").over(Window.partitionBy(*groups)).alias("total"),
    )
    fine = fine.join(broadcast_if(coarse, small), [*groups, "coarse"]).select(
        *groups,
        "fine",
        (F.col("coarse_before") + before([*groups, "coarse"], "fine")).alias("fine_before"),
        "total",
    )
    ranked = keyed.select(*groups, "fine", value, "n").join(fine, [*groups, "fine"])
    first = F.col("fine_before") + before([*groups, "fine"], value)
    return ranked.select(*groups, value, (first + (F.col("n") + 1) / 2).alias("rank"), "total")


def range_ranks(counts: DataFrame, groups: Sequence[str], values: Sequence[str], parts: int | None = None) -> DataFrame:
    """Average ranks as a prefix sum over range partitions: ``(groups..., values..., n, twice_rank, total)``.

    ``counts`` holds one row per distinct ``values`` of a group with its count
    ``n``; rows are ordered by ``values`` as given (NULLs first).  The rows are
    range-partitioned on ``(groups, values)`` into ``parts`` ranges (default:
    ``spark.sql.shuffle.partitions``), so a range holds about ``1 / parts`` of the
    distinct values whatever their counts.  Inside a range a running sum gives
    each value the count before it; the totals of the ranges, at most ``parts``
    rows per group, give each range the count of the ranges before it.
    ``twice_rank`` is twice the average rank, an integer: ``2 before + n + 1``.
    """
    groups, values = list(groups), list(values)
    spark = counts.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = counts.repartitionByRange(parts, *[F.col(c).asc_nulls_first() for c in [*groups, *values]]).withColumn(
        "range", F.spark_partition_id()
    )
    within = Window.partitionBy("range", *groups)
    running = within.orderBy(*[F.col(c).asc_nulls_first() for c in values]).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.select(
        *groups, *values, "n", "range",
        F.coalesce(F.sum("n").over(running), F.lit(0)).alias("inside"),
        F.sum("n").over(within).alias("range_total"),
    )
    ranges = local.groupBy("range", *groups).agg(F.max("range_total").alias("range_total"))
    earlier = Window.partitionBy(*groups).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select(
        "range", *groups,
        F.coalesce(F.sum("range_total").over(earlier), F.lit(0)).alias("offset"),
        F.sum("range_total").over(Window.partitionBy(*groups)).alias("total"),
    )
    return local.join(offsets, ["range", *groups]).select(
        *groups, *values, "n", (2 * (F.col("offset") + F.col("inside")) + F.col("n") + 1).alias("twice_rank"), "total"
    )


def sums_before(df: DataFrame, groups: Sequence[str], order: Sequence[str], value: str, parts: int | None = None) -> DataFrame:
    """Adds ``before``: the sum of ``value`` over the earlier rows of the row's group, in ``order``.

    A running total over range partitions: rows are range-partitioned on
    ``(groups, order)``, summed inside each range, and each range adds the
    totals of the earlier ranges of the group (at most ``parts`` rows a group).
    One group may hold any number of rows: no window holds more than a range.
    Rows with equal ``order`` within a group are taken in an undefined order.
    """
    groups, order = list(groups), list(order)
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in [*groups, *order]]
    ranged = df.repartitionByRange(parts, *keys).withColumn("_range", F.spark_partition_id())
    within = Window.partitionBy("_range", *groups)
    running = within.orderBy(*[F.col(c).asc_nulls_first() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumns(
        {"_inside": F.coalesce(F.sum(value).over(running), F.lit(0).cast(df.schema[value].dataType)), "_range_total": F.sum(value).over(within)}
    )
    ranges = local.groupBy("_range", *groups).agg(F.max("_range_total").alias("_range_total"))
    earlier = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select("_range", *groups, F.coalesce(F.sum("_range_total").over(earlier), F.lit(0)).alias("_offset"))
    joined = local.join(offsets, ["_range", *groups])
    return joined.select(*df.columns, (F.col("_offset") + F.col("_inside")).alias("before"))
