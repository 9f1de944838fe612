"""Correlations and straight-line fits."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywick.functions.tails import correlation_p
from tallywick.functions.values import not_nan
from tallywick.operators.ranking import range_ranks
from tallywick.operators.shaping import listed

Pair = tuple[str, str]


def _sides(pair: Pair) -> tuple[Column, Column]:
    """Both values where both are present, else two NULLs."""
    a, b = (not_nan(F.col(c)) for c in pair)
    both = a.isNotNull() & b.isNotNull()
    return F.when(both, a), F.when(both, b)


def _per_pair(df: DataFrame, pairs: Sequence[Pair], measures) -> DataFrame:
    """One row per pair from one aggregation over the whole table."""
    rows = []
    for pair in pairs:
        a, b = _sides(pair)
        rows.append(F.struct(F.lit(pair[0]).alias("x"), F.lit(pair[1]).alias("y"), *measures(a, b)))
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def _pearson(a: Column, b: Column) -> list[Column]:
    # corr() raises for a constant in ANSI mode, so the quotient is written out;
    # rounding can carry a perfect correlation a little beyond one
    r = F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))
    bounded = F.when(r > 1, F.lit(1.0)).when(r < -1, F.lit(-1.0)).otherwise(r)
    return [F.count(a).alias("n"), F.when(F.count(a) >= 3, bounded).alias("r")]


def pearson(df: DataFrame, pairs: Sequence[Pair]) -> DataFrame:
    """r and two-sided p per pair; NULL below three rows or for a constant."""
    return _per_pair(df, pairs, _pearson).withColumn("p", correlation_p("r", "n"))


def spearman(df: DataFrame, pairs: Sequence[Pair]) -> DataFrame:
    """Rank correlation with average ranks for ties, and its two-sided p.

    Rows are combined to (x, y) cell counts first, under the pair's number.  Both sides of all pairs are
    ranked in one pass: their value counts are stacked and ranked by a prefix
    sum over range partitions (:func:`range_ranks`); each cell then takes the rank of
    either side by a join, in narrow rows of numbers.  Twice a rank is an integer, and so is twice its distance from the mean rank, so the sums
    behind rho are exact (decimal) integers.
    """
    rows = []
    for number, pair in enumerate(pairs):
        a, b = _sides(pair)
        rows.append(F.struct(F.lit(number).alias("pair"), a.alias("a"), b.alias("b")))
    cells = (
        df.select(F.inline(F.array(*rows)))
        .where(F.col("a").isNotNull() & F.col("b").isNotNull())
        .groupBy("pair", "a", "b")
        .agg(F.count(F.lit(1)).alias("c"))
    )
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.col("a").alias("va"), F.lit(None).cast(cells.schema["b"].dataType).alias("vb")),
        F.struct(F.lit(1).alias("side"), F.lit(None).cast(cells.schema["a"].dataType).alias("va"), F.col("b").alias("vb")),
    )
    # each cell adds to one value per side; all sides are ranked in one pass
    counts = cells.select("pair", "c", F.inline(sides)).groupBy("pair", "side", "va", "vb").agg(F.sum("c").alias("n"))
    ranks = range_ranks(counts, ["pair", "side"], ["va", "vb"])
    distance = F.col("twice_rank") - F.col("total") - 1
    left = ranks.where("side = 0").select("pair", F.col("va").alias("a"), distance.alias("da"), "total")
    right = ranks.where("side = 1").select("pair", F.col("vb").alias("b"), distance.alias("db"))
    ranked = cells.join(left, ["pair", "a"]).select("pair", "b", "c", "da", "total").join(right, ["pair", "b"])
    exact = "decimal(38, 0)"
    da, db, c = (F.col(n).cast(exact) for n in ("da", "db", "c"))
    sums = ranked.groupBy("pair").agg(
        F.max("total").alias("n"),
        F.sum(c * da * db).cast("double").alias("ab"),
        F.sum(c * da * da).cast("double").alias("aa"),
        F.sum(c * db * db).cast("double").alias("bb"),
    )
    rho = F.try_divide(F.col("ab"), F.sqrt("aa") * F.sqrt("bb"))
    # one row per listed pair: a bound known before the job runs
    names = listed(df.sparkSession, ["pair", "x", "y"], [(number, *pair) for number, pair in enumerate(pairs)])
    asked = names.join(F.broadcast(sums), "pair", "left")
    rows = asked.select("x", "y", F.coalesce("n", F.lit(0)).alias("n"), F.when(F.col("n") >= 3, rho).alias("rho"))
    return rows.withColumn("p", correlation_p("rho", "n"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All cells of the matrix in long form, every pair over its own complete rows.

    ``i`` and ``j`` are the positions of the columns in the given list.
    """
    place = {c: i for i, c in enumerate(columns)}
    pairs = [(b, a) for a, b in combinations(columns, 2)] + [(c, c) for c in columns]
    lower = _per_pair(df, pairs, _pearson)

    def position(col: str) -> Column:
        return F.element_at(F.create_map(*[F.lit(v) for kv in place.items() for v in kv]), F.col(col))

    lower = lower.select(position("x").alias("i"), position("y").alias("j"), "x", "y", "n", "r")
    swapped = F.struct(
        F.col("j").alias("i"), F.col("i").alias("j"), F.col("y").alias("x"), F.col("x").alias("y"), "n", "r"
    )
    same = F.struct("i", "j", "x", "y", "n", "r")
    both = F.when(F.col("i") == F.col("j"), F.array(same)).otherwise(F.array(same, swapped))
    return lower.select(F.inline(both))


def lower_triangle(matrix: DataFrame) -> DataFrame:
    """Cells strictly below the diagonal."""
    return matrix.where(F.col("i") > F.col("j"))


def line_fits(df: DataFrame, pairs: Sequence[Pair]) -> DataFrame:
    """Least-squares line of y on x per pair, with what its band needs.

    ``residual_std`` is the residual standard error, ``x_mean`` and ``x_spread``
    are the mean and the sum of squared deviations of x.
    """

    def measures(a: Column, b: Column) -> list[Column]:
        n, va, vb = F.count(a), F.var_pop(a), F.var_pop(b)
        slope = F.when(va > 0, F.covar_pop(a, b) / F.nullif(va, F.lit(0.0)))
        explained = F.when(vb == 0, F.lit(1.0)).otherwise(slope * F.try_divide(F.covar_pop(a, b), vb))
        residual = n * F.greatest(vb - slope * F.covar_pop(a, b), F.lit(0.0))
        return [
            n.alias("n"),
            slope.alias("slope"),
            (F.avg(b) - slope * F.avg(a)).alias("intercept"),
            F.when(va > 0, explained).alias("r2"),
            F.when((n > 2) & (va > 0), F.sqrt(residual / F.nullif(n - 2, F.lit(0)))).alias("residual_std"),
            F.avg(a).alias("x_mean"),
            (n * va).alias("x_spread"),
            F.min(a).alias("x_min"),
            F.max(a).alias("x_max"),
        ]

    return _per_pair(df, pairs, measures)


def line_bands(fits: DataFrame, points: int = 100, multiplier: float = 1.959963984540054) -> DataFrame:
    """Fitted line with its mean confidence band on an even grid from min to max.

    The multiplier is the wanted quantile of t; the default is the 95 % value
    for large samples.
    """
    step = (F.col("x_max") - F.col("x_min")) / (points - 1)
    grid = fits.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    grid = grid.withColumn("x_value", F.col("x_min") + F.col("point") * step)
    fit = F.col("intercept") + F.col("slope") * F.col("x_value")
    offset = F.col("x_value") - F.col("x_mean")
    half = multiplier * F.col("residual_std") * F.sqrt(1 / F.col("n") + offset * offset / F.col("x_spread"))
    return grid.select(
        "x", "y", "point", "x_value", fit.alias("fit"), (fit - half).alias("low"), (fit + half).alias("high")
    )
