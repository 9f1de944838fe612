"""Correlations and line fits."""

from itertools import combinations

from tallywick.operators import association as ops
from tallywick.plans import tails_sql
from tallywick.plans.registry import LINEITEM_WITH_GAPS, lineitem_with_gaps, query, steady, steady_query
from tallywick.sources.files import table

PAIRS = [("l_quantity", "l_extendedprice"), ("l_discount", "l_tax"), ("l_quantity", "l_discount")]
GAPS = f"WITH gaps AS ({LINEITEM_WITH_GAPS})"
P_OF_R = tails_sql.t_two_sided("t", "dof")


def _p_sql(inner: str, r: str) -> str:
    return (
        f"WITH c AS ({inner}), k AS (SELECT *, {r} * sqrt((n - 2) / (1 - {r} * {r})) AS t, (n - 2)::DOUBLE AS dof FROM c) "
        f"SELECT x, y, n, {r}, {P_OF_R} AS p FROM k"
    )


@query(
    "pearson",
    steady_query(
        _p_sql(
            f"{GAPS} "
            + " UNION ALL ".join(
                f"SELECT '{x}' AS x, '{y}' AS y, count(*) AS n, corr({x}, {y}) AS r FROM gaps "
                f"WHERE {x} IS NOT NULL AND {y} IS NOT NULL"
                for x, y in PAIRS
            ),
            "r",
        ),
        ["x", "y", "n"],
        ["r", "p"],
    ),
)
def pearson(spark, folder):
    return steady(ops.pearson(lineitem_with_gaps(spark, folder), PAIRS))


def _rank_sql(x, y):
    def average(c):
        return f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE"

    return f"""SELECT '{x}' AS x, '{y}' AS y, count(*) AS n, corr(a, b) AS rho FROM (
        SELECT {average(x)} AS a, {average(y)} AS b FROM gaps WHERE {x} IS NOT NULL AND {y} IS NOT NULL)"""


@query(
    "spearman",
    steady_query(
        _p_sql(f"{GAPS} " + " UNION ALL ".join(_rank_sql(x, y) for x, y in PAIRS), "rho"),
        ["x", "y", "n"],
        ["rho", "p"],
    ),
)
def spearman(spark, folder):
    return steady(ops.spearman(lineitem_with_gaps(spark, folder), PAIRS))


COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "correlation_matrix",
    steady_query(
        f"{GAPS} "
        + " UNION ALL ".join(
            f"SELECT {i} AS i, {j} AS j, '{a}' AS x, '{b}' AS y, count(*) AS n, corr({a}, {b}) AS r FROM gaps "
            f"WHERE {a} IS NOT NULL AND {b} IS NOT NULL"
            for i, a in enumerate(COLUMNS)
            for j, b in enumerate(COLUMNS)
        ),
        ["i", "j", "x", "y", "n"],
        ["r"],
    ),
)
def correlation_matrix(spark, folder):
    return steady(ops.correlation_matrix(lineitem_with_gaps(spark, folder), COLUMNS))


@query(
    "lower_triangle",
    steady_query(
        " UNION ALL ".join(
            f"SELECT {COLUMNS.index(b)} AS i, {COLUMNS.index(a)} AS j, '{b}' AS x, '{a}' AS y, count(*) AS n, "
            f"corr({b}, {a}) AS r FROM lineitem"
            for a, b in combinations(COLUMNS, 2)
        ),
        ["i", "j", "x", "y", "n"],
        ["r"],
    ),
)
def lower_triangle(spark, folder):
    return steady(ops.lower_triangle(ops.correlation_matrix(table(spark, folder, "lineitem"), COLUMNS)))


FITS = " UNION ALL ".join(
    f"""SELECT '{x}' AS x, '{y}' AS y, count(*) AS n, regr_slope({y}, {x}) AS slope, regr_intercept({y}, {x}) AS intercept,
        regr_r2({y}, {x}) AS r2,
        sqrt((regr_syy({y}, {x}) - regr_sxy({y}, {x}) ** 2 / regr_sxx({y}, {x})) / (count(*) - 2)) AS residual_std,
        avg({x}) AS x_mean, regr_sxx({y}, {x}) AS x_spread, min({x}) AS x_min, max({x}) AS x_max
        FROM gaps WHERE {x} IS NOT NULL AND {y} IS NOT NULL"""
    for x, y in PAIRS
)


@query(
    "line_fits",
    steady_query(
        f"{GAPS} {FITS}",
        ["x", "y", "n"],
        ["slope", "intercept", "r2", "residual_std", "x_mean", "x_spread", "x_min", "x_max"],
    ),
)
def line_fits(spark, folder):
    return steady(ops.line_fits(lineitem_with_gaps(spark, folder), PAIRS))


@query(
    "line_bands",
    steady_query(
        f"""{GAPS}, fits AS ({FITS}),
            grid AS (SELECT *, i AS point, x_min + i * ((x_max - x_min) / 99) AS x_value FROM fits, range(100) r(i)),
            half AS (SELECT *, intercept + slope * x_value AS fit,
                            1.959963984540054 * residual_std * sqrt(1.0 / n + (x_value - x_mean) ** 2 / x_spread) AS h
                     FROM grid)
            SELECT x, y, point, x_value, fit, fit - h AS low, fit + h AS high FROM half""",
        ["x", "y", "point"],
        ["x_value", "fit", "low", "high"],
    ),
)
def line_bands(spark, folder):
    return steady(ops.line_bands(ops.line_fits(lineitem_with_gaps(spark, folder), PAIRS)))
