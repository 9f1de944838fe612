"""Crosstabs and group summaries."""

from tallywick.operators import grouping as ops
from tallywick.plans.registry import LINEITEM_WITH_GAPS, lineitem_with_gaps, query, steady, steady_query
from tallywick.sources.files import table

GAPS = f"WITH gaps AS ({LINEITEM_WITH_GAPS})"


@query(
    "crosstab_with_missing",
    f"{GAPS} SELECT l_returnflag, l_linestatus, count(*) AS n FROM gaps GROUP BY l_returnflag, l_linestatus",
)
def crosstab_with_missing(spark, folder):
    return ops.crosstab(lineitem_with_gaps(spark, folder), "l_returnflag", "l_linestatus")


@query(
    "crosstab_complete",
    f"""{GAPS} SELECT l_returnflag, l_linestatus, count(*) AS n FROM gaps
        WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag, l_linestatus""",
)
def crosstab_complete(spark, folder):
    return ops.crosstab(lineitem_with_gaps(spark, folder), "l_returnflag", "l_linestatus", missing=False)


@query(
    "crosstab_with_zeros",
    """WITH kinds AS (SELECT DISTINCT event_type FROM events), users AS (SELECT DISTINCT user_id FROM events)
       SELECT u.user_id, k.event_type, count(e.event_id) AS n FROM users u CROSS JOIN kinds k
       LEFT JOIN events e ON e.user_id = u.user_id AND e.event_type = k.event_type GROUP BY u.user_id, k.event_type""",
)
def crosstab_with_zeros(spark, folder):
    kinds = ["click", "error", "purchase", "signup", "view"]
    return ops.full_crosstab(table(spark, folder, "events"), "user_id", "event_type", kinds)


@query(
    "row_percents",
    f"""{GAPS} SELECT l_returnflag, l_linestatus, count(*) AS n,
            round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (PARTITION BY l_returnflag), 4) AS percent
        FROM gaps GROUP BY l_returnflag, l_linestatus""",
)
def row_percents(spark, folder):
    cells = ops.crosstab(lineitem_with_gaps(spark, folder), "l_returnflag", "l_linestatus")
    return ops.row_percent(cells, "l_returnflag", digits=4)


GROUPED = """
    SELECT {group} AS {group}, count({value}) AS n, avg({value}) AS mean, median({value}) AS median,
           coalesce(stddev_samp({value}), 0) AS std{more}
    FROM {source} WHERE {group} IS NOT NULL AND {value} IS NOT NULL GROUP BY {group}
"""


@query(
    "group_summary",
    steady_query(
        f"{GAPS} {GROUPED.format(group='l_returnflag', value='l_quantity', source='gaps', more='')}",
        ["l_returnflag", "n"],
        ["mean", "median", "std"],
    ),
)
def group_summary(spark, folder):
    return steady(ops.group_summary(lineitem_with_gaps(spark, folder), "l_returnflag", "l_quantity"))


@query(
    "group_summary_rounded",
    "WITH g AS ("
    + GROUPED.format(
        group="user_id", value="value", source="events", more=", min(value) AS min, max(value) AS max"
    )
    + ") SELECT user_id, n, round(mean, 3) AS mean, round(median, 3) AS median, round(std, 3) AS std, "
    "round(min, 3) AS min, round(max, 3) AS max FROM g",
)
def group_summary_rounded(spark, folder):
    return ops.group_summary(table(spark, folder, "events"), "user_id", "value", limits=True, digits=3)


PAIRS = [("l_quantity", "l_returnflag"), ("l_extendedprice", "l_returnflag"), ("l_quantity", "l_linestatus")]


@query(
    "stacked_group_summaries",
    steady_query(
        GAPS
        + " UNION ALL ".join(
            f"""SELECT '{v}' AS variable, '{g}' AS grouping, {g} AS category, count({v}) AS n, avg({v}) AS mean,
                       median({v}) AS median, coalesce(stddev_samp({v}), 0) AS std
                FROM gaps WHERE {g} IS NOT NULL AND {v} IS NOT NULL GROUP BY {g}"""
            for v, g in PAIRS
        ),
        ["variable", "grouping", "category", "n"],
        ["mean", "median", "std"],
    ),
)
def stacked_group_summaries(spark, folder):
    return steady(ops.group_summaries(lineitem_with_gaps(spark, folder), PAIRS))
