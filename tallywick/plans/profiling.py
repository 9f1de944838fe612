"""Summaries of single variables."""

from pyspark.sql import functions as F

from tallywick.operators import profiling as ops
from tallywick.operators.charts import category_bars
from tallywick.operators.ranking import quantiles, quick_quantiles, smallest_mode, stacked, value_counts
from tallywick.plans.registry import (
    LINEITEM_WITH_GAPS,
    lineitem_with_gaps,
    long_sql,
    query,
    steady,
    steady_query,
)
from tallywick.sources.files import table

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
FLAGS = ["l_returnflag", "l_linestatus"]
LONG = f"WITH gaps AS ({LINEITEM_WITH_GAPS}), long AS ({long_sql('gaps', NUMBERS)})"

QUARTILES_SQL = """
    SELECT variable, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
           quantile_cont(value, 0.75) AS q3
    FROM long WHERE value IS NOT NULL GROUP BY variable
"""
MODES_SQL = """
    SELECT variable, min(value) AS mode FROM (
        SELECT variable, value, n, max(n) OVER (PARTITION BY variable) AS most FROM (
            SELECT variable, value, count(*) AS n FROM long WHERE value IS NOT NULL GROUP BY variable, value))
    WHERE n = most GROUP BY variable
"""
SKEWNESS_SQL = "SELECT variable, skewness(value) AS skewness FROM long GROUP BY variable"
OUTLIERS_SQL = f"""
    SELECT l.variable, count(*) FILTER (WHERE q3 > q1 AND (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)))
           AS outliers
    FROM long l JOIN ({QUARTILES_SQL}) q ON l.variable = q.variable GROUP BY l.variable
"""


@query(
    "numeric_summary",
    steady_query(
        f"""{LONG}
        SELECT s.*, m.mode, q.q3 - q.q1 AS iqr, q.q1, q.median, q.q3, k.skewness, o.outliers
        FROM (SELECT variable, count(*) AS n, count(*) - count(value) AS missing, avg(value) AS mean,
                     CASE WHEN count(value) = 1 THEN 0.0 ELSE var_samp(value) END AS variance,
                     CASE WHEN count(value) = 1 THEN 0.0 ELSE stddev_samp(value) END AS std, min(value) AS min, max(value) AS max
              FROM long GROUP BY variable) s
        JOIN ({QUARTILES_SQL}) q ON s.variable = q.variable
        JOIN ({MODES_SQL}) m ON s.variable = m.variable
        JOIN ({SKEWNESS_SQL}) k ON s.variable = k.variable
        JOIN ({OUTLIERS_SQL}) o ON s.variable = o.variable""",
        ["variable", "n", "missing", "outliers"],
        ["mean", "median", "mode", "variance", "std", "iqr", "q1", "q3", "min", "max", "skewness"],
    ),
)
def numeric_summary(spark, folder):
    return steady(ops.numeric_summary(lineitem_with_gaps(spark, folder), NUMBERS))


@query("quartiles_of_many_values", steady_query(f"{LONG} {QUARTILES_SQL}", ["variable"], ["q1", "median", "q3"]))
def quartiles_of_many_values(spark, folder):
    """The same quartiles from value counts: each distinct value once, with its count as weight."""
    counts = value_counts(stacked(lineitem_with_gaps(spark, folder), NUMBERS), ["variable"])
    return steady(quantiles(counts, ["variable"], ops.QUARTILES, weight="n"))


@query("quartiles", steady_query(f"{LONG} {QUARTILES_SQL}", ["variable"], ["q1", "median", "q3"]))
def quartiles(spark, folder):
    long = stacked(lineitem_with_gaps(spark, folder), NUMBERS)
    return steady(quantiles(long, ["variable"], ops.QUARTILES, small=True))


@query("quartiles_approximate")
def quartiles_approximate(spark, folder):
    long = stacked(lineitem_with_gaps(spark, folder), NUMBERS)
    return quick_quantiles(long, ["variable"], ops.QUARTILES)


@query("smallest_modes", f"{LONG} {MODES_SQL}")
def smallest_modes(spark, folder):
    counts = value_counts(stacked(lineitem_with_gaps(spark, folder), NUMBERS), ["variable"])
    return smallest_mode(counts, ["variable"])


@query("adjusted_skewness", steady_query(f"{LONG} {SKEWNESS_SQL}", ["variable"], ["skewness"]))
def adjusted_skewness(spark, folder):
    rows = ops.per_column(
        lineitem_with_gaps(spark, folder), NUMBERS, lambda _, x: [ops.adjusted_skewness(x).alias("skewness")]
    )
    return steady(rows)


@query(
    "outlier_counts",
    f"""WITH long AS ({long_sql("events", ["value"])} UNION ALL {long_sql("orders", ["o_totalprice"])})
        {OUTLIERS_SQL}""",
)
def outlier_counts(spark, folder):
    long = stacked(table(spark, folder, "events"), ["value"]).unionByName(
        stacked(table(spark, folder, "orders"), ["o_totalprice"])
    )
    counts = value_counts(long, ["variable"])
    fences = ops.with_fences(quantiles(counts, ["variable"], ops.QUARTILES, weight="n"))
    return ops.outlier_counts(counts, fences)


FREQUENCIES_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS variable, {c} AS category, count(*) AS n,
               round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM gaps), 8) AS percent
        FROM gaps GROUP BY {c}"""
    for c in FLAGS
)


@query("category_frequencies", f"WITH gaps AS ({LINEITEM_WITH_GAPS}) {FREQUENCIES_SQL}")
def category_frequencies(spark, folder):
    return steady(ops.frequencies(lineitem_with_gaps(spark, folder), FLAGS))


@query(
    "category_bars",
    f"""WITH gaps AS ({LINEITEM_WITH_GAPS}), counts AS ({FREQUENCIES_SQL})
        SELECT variable, category, round(n::DOUBLE / (SELECT count(*) FROM gaps), 8) AS height
        FROM counts ORDER BY variable, category NULLS FIRST""",
)
def bars(spark, folder):
    return steady(category_bars(lineitem_with_gaps(spark, folder), FLAGS, share=True))


def _missing_sql(columns):
    parts = [f"SELECT '{c}' AS variable, count(*) - count({c}) AS missing FROM gaps" for c in columns]
    whole = " + ".join(f"(count(*) - count({c}))" for c in columns)
    return " UNION ALL ".join([*parts, f"SELECT '(all)' AS variable, {whole} AS missing FROM gaps"])


@query("missing_counts", f"WITH gaps AS ({LINEITEM_WITH_GAPS}) {_missing_sql([*NUMBERS, *FLAGS])}")
def missing_counts(spark, folder):
    return ops.missing_counts(lineitem_with_gaps(spark, folder).select(*NUMBERS, *FLAGS))


@query(
    "table_shapes",
    f"""WITH gaps AS ({LINEITEM_WITH_GAPS})
        SELECT 'before' AS stage, count(*) AS rows, 11 AS columns FROM gaps
        UNION ALL SELECT 'after', count(*), 11 FROM gaps WHERE l_quantity IS NOT NULL AND l_returnflag IS NOT NULL""",
)
def table_shapes(spark, folder):
    before = lineitem_with_gaps(spark, folder)
    after = before.where(F.col("l_quantity").isNotNull() & F.col("l_returnflag").isNotNull())
    return ops.table_shape(before, "before").unionByName(ops.table_shape(after, "after"))
