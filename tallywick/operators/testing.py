"""Hypothesis tests from sufficient statistics.

Every test reduces the table to one row per cell or per group in a single pass;
everything after that runs on those few rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywick.functions.tails import chi2_upper, f_upper
from tallywick.functions.values import finite
from tallywick.operators.grouping import with_margins
from tallywick.operators.shaping import listed

RESULT_COLUMNS = ["test", "kind", "n", "statistic", "dof", "dof2", "p", "effect", "effect_name", "notes"]


def pair_cells(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Crosstabs of several pairs, without NULLs, from one scan: ``(x, y, a, b, n)``."""
    rows = [
        F.struct(
            F.lit(x).alias("x"), F.lit(y).alias("y"),
            F.col(x).cast("string").alias("a"), F.col(y).cast("string").alias("b"),
        )
        for x, y in pairs
    ]
    long = df.select(F.inline(F.array(*rows))).na.drop(subset=["a", "b"])
    return long.groupBy("x", "y", "a", "b").agg(F.count(F.lit(1)).alias("n"))


def with_expected(cells: DataFrame) -> DataFrame:
    """Adds both margins, the total and the expected count to crosstab cells."""
    totals = cells.groupBy("x", "y").agg(F.sum("n").alias("total"))
    placed = with_margins(cells, {"row_n": ["x", "y", "a"], "col_n": ["x", "y", "b"]})
    placed = placed.join(F.broadcast(totals), ["x", "y"])  # one row per listed pair
    return placed.withColumn("expected", F.col("row_n") * (F.col("col_n") / F.col("total")))


def chi_square(
    df: DataFrame,
    pairs: Sequence[tuple[str, str]],
    correction: bool = True,
    low_expected: float = 5.0,
) -> DataFrame:
    """Chi-square test of independence and Cramér's V per pair.

    ``correction`` applies Yates' correction where dof is 1.  With fewer than
    two rows or columns statistic and p are NULL.  Empty cells are never
    generated: together they add the total minus the expected counts of the
    filled cells.
    """
    cells = with_expected(pair_cells(df, pairs))
    gap = F.col("n") - F.col("expected")
    sums = cells.groupBy("x", "y").agg(
        F.sum("n").alias("n"),
        F.count_distinct("a").alias("rows"),
        F.count_distinct("b").alias("cols"),
        F.count(F.lit(1)).alias("filled"),
        F.sum(gap * gap / F.col("expected")).alias("filled_part"),
        F.sum("expected").alias("filled_expected"),
        F.max(F.abs(gap)).alias("gap"),
        F.min("row_n").alias("row_min"),
        F.max("row_n").alias("row_max"),
        F.min("col_n").alias("col_min"),
        F.max("col_n").alias("col_max"),
    )
    dof = (F.col("rows") - 1) * (F.col("cols") - 1)
    has_empty = F.col("filled") < F.col("rows") * F.col("cols")
    plain = F.col("filled_part") + F.when(has_empty, F.col("n") - F.col("filled_expected")).otherwise(F.lit(0.0))
    # in a 2 x 2 table all four gaps are equal, and the reciprocals of the
    # expected counts add up to this product of margins
    shrunk = F.col("gap") - F.least(F.lit(0.5), F.col("gap"))
    reciprocals = (
        F.col("n")
        * (1 / F.col("row_min") + 1 / F.col("row_max"))
        * (1 / F.col("col_min") + 1 / F.col("col_max"))
    )
    yates = shrunk * shrunk * reciprocals
    chosen = F.when((F.col("dof") == 1) & F.lit(correction), yates).otherwise(plain)
    shorter = F.greatest(F.least(F.col("rows") - 1, F.col("cols") - 1), F.lit(1))
    smallest = F.col("row_min") * (F.col("col_min") / F.col("n"))
    asked = listed(df.sparkSession, ["x", "y"], pairs)
    return (
        asked.join(F.broadcast(sums), ["x", "y"], "left")  # one row per listed pair
        .withColumn("dof", dof)
        .withColumn("statistic", F.when(F.col("dof") >= 1, chosen))
        .select(
            "x", "y", F.coalesce("n", F.lit(0)).alias("n"), "statistic",
            F.when(F.col("dof") >= 1, F.col("dof")).alias("dof"),
            chi2_upper("statistic", "dof").alias("p"),
            F.sqrt(F.col("statistic") / F.col("n") / shorter).alias("cramers_v"),
            smallest.alias("min_expected"),
            F.coalesce(smallest < low_expected, F.lit(True)).alias("low_expected"),
        )
    )


def expected_counts(grid: DataFrame, x: str, y: str) -> DataFrame:
    """Expected count of every cell of a full crosstab ``(x, y, n)``."""
    total = grid.agg(F.sum("n")).scalar()
    placed = with_margins(grid, {"row_n": [x], "col_n": [y]})
    return placed.withColumn("expected", F.col("row_n") * (F.col("col_n") / total)).drop("row_n", "col_n")


def group_statistics(df: DataFrame, tests: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Size, mean and variance per (test, group), for ``(test, value, group)`` triples.

    Non-finite values are left out.  One scan for all tests.
    """
    rows = [
        F.struct(
            F.lit(test).alias("test"),
            F.col(group).cast("string").alias("category"),
            finite(F.col(value)).alias("value"),
        )
        for test, value, group in tests
    ]
    long = df.select(F.inline(F.array(*rows))).na.drop(subset=["category", "value"])
    return long.groupBy("test", "category").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.var_samp("value").alias("variance")
    )


def _welch(first: Column, second: Column) -> tuple[Column, Column, Column]:
    """t, Satterthwaite's dof and Cohen's d from two group records."""
    e1, e2 = first["variance"] / first["n"], second["variance"] / second["n"]
    gap = first["mean"] - second["mean"]
    t = F.try_divide(gap, F.sqrt(e1 + e2))
    dof = F.try_divide((e1 + e2) * (e1 + e2), e1 * e1 / (first["n"] - 1) + e2 * e2 / (second["n"] - 1))
    free1, free2 = first["n"] - 1, second["n"] - 1
    pooled = F.sqrt((free1 * first["variance"] + free2 * second["variance"]) / (free1 + free2))
    d = F.when(pooled == 0, F.lit(0.0)).otherwise(F.try_divide(gap, pooled))
    return t, dof, d


def mean_tests(df: DataFrame, tests: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Comparison of means, one row per test.

    Two groups give Welch's t-test with Cohen's d, three or more a one-way
    ANOVA with eta squared, fewer none.  The number of groups is known from the
    aggregate, so all tests share one plan.
    """
    groups = group_statistics(df, tests)
    # both aggregations read sizes, means and variances, so they share one scan
    record = F.struct("category", "n", "mean", "variance")
    totals = groups.groupBy("test").agg(
        F.count(F.lit(1)).alias("groups"),
        F.sum("n").alias("total"),
        F.min("n").alias("smallest"),
        F.min(record).alias("first"),
        F.max(record).alias("second"),
        (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("grand"),
    )
    carried = ["groups", "total", "smallest", "first", "second"]
    distance = F.col("mean") - F.col("grand")
    sums = (
        groups.join(F.broadcast(totals), "test")  # one row per listed test
        .groupBy("test")
        .agg(
            *[F.max(c).alias(c) for c in carried],
            F.sum(F.col("n") * distance * distance).alias("between"),
            F.sum((F.col("n") - 1) * F.coalesce("variance", F.lit(0.0))).alias("within"),
        )
        .withColumnRenamed("total", "n")
    )
    t, welch_dof, d = _welch(F.col("first"), F.col("second"))
    df_between = (F.col("groups") - 1).cast("double")
    df_within = (F.col("n") - F.col("groups")).cast("double")
    ratio = F.try_divide(F.col("between") / df_between, F.try_divide(F.col("within"), df_within))
    two = (F.col("groups") == 2) & (F.col("smallest") >= 2)
    more = (F.col("groups") >= 3) & (F.col("n") > F.col("groups"))
    kind = F.when(two, F.lit("welch")).when(more, F.lit("anova")).otherwise(F.lit("none"))
    eta = F.try_divide(F.col("statistic") * df_between, F.col("statistic") * df_between + df_within)
    asked = listed(df.sparkSession, ["test"], [(test,) for test, _, _ in tests])
    chosen = (
        asked.join(F.broadcast(sums), "test", "left")
        .withColumn("groups", F.coalesce("groups", F.lit(0)))
        .withColumn("n", F.coalesce("n", F.lit(0)))
        .withColumn("kind", kind)
        .withColumn("statistic", F.when(two, t).when(more, ratio))
        .withColumn("dof", F.when(two, welch_dof).when(more, df_between))
        .withColumn("dof2", F.when(more, df_within))
    )
    # the square of Welch's t is an F with one degree of freedom in front
    p = f_upper(
        "if(kind = 'welch', statistic * statistic, statistic)",
        "if(kind = 'welch', 1D, dof)",
        "if(kind = 'welch', dof, dof2)",
    )
    return chosen.select(
        "test", "kind", "groups", "n", "statistic", "dof", "dof2",
        p.alias("p"),
        F.when(two, d).when(more, eta).alias("effect"),
        F.when(two, F.lit("cohen_d")).when(more, F.lit("eta_squared")).alias("effect_name"),
    )


def decision(p: Column, alpha: float, reject: str, keep: str, undefined: str) -> Column:
    """The caller's text for p below alpha, not below, or undefined."""
    missing = p.isNull() | F.isnan(p)
    return F.when(missing, F.lit(undefined)).when(p < alpha, F.lit(reject)).otherwise(F.lit(keep))


def test_report(
    df: DataFrame,
    pairs: Sequence[tuple[str, str]] = (),
    means: Sequence[tuple[str, str, str]] = (),
    correction: bool = True,
    alpha: float = 0.05,
    texts: tuple[str, str, str] = ("rejected", "not rejected", "not applicable"),
) -> DataFrame:
    """All tests as one table with a fixed schema, with the decision at ``alpha``.

    ``notes`` warns of expected counts below 5 (with the smallest one, two
    decimals) and of mean tests with fewer than two groups with data.
    """
    parts = []
    if pairs:
        table = chi_square(df, pairs, correction)
        smallest = F.when(F.col("min_expected").isNotNull(), F.format_string("smallest expected count: %.2f", F.col("min_expected")))
        notes = F.when(F.col("low_expected"), F.array_compact(F.array(F.lit("low expected counts"), smallest))).otherwise(
            F.array().cast("array<string>")
        )
        parts.append(
            table.select(
                F.concat_ws(" x ", "x", "y").alias("test"),
                F.lit("chi_square").alias("kind"),
                "n",
                "statistic",
                F.col("dof").cast("double").alias("dof"),
                F.lit(None).cast("double").alias("dof2"),
                "p",
                F.col("cramers_v").alias("effect"),
                F.lit("cramers_v").alias("effect_name"),
                notes.alias("notes"),
            )
        )
    if means:
        few = F.when(F.col("groups") < 2, F.array(F.lit("fewer than two groups with data")))
        table = mean_tests(df, means).withColumn("notes", F.coalesce(few, F.array().cast("array<string>")))
        parts.append(table.select(*RESULT_COLUMNS))
    if not parts:
        raise ValueError("no test was asked for")
    report = reduce(lambda a, b: a.unionByName(b), parts)
    return report.withColumn("decision", decision(F.col("p"), alpha, *texts))


test_report.__test__ = False  # not a test case, whatever its name says
