"""Tables behind charts."""

from pyspark.sql import functions as F

from tallywick.operators import charts as ops
from tallywick.plans.registry import LINEITEM_WITH_GAPS, lineitem_with_gaps, long_sql, query, steady, steady_query
from tallywick.sources.files import table

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount"]
GAPS = f"WITH gaps AS ({LINEITEM_WITH_GAPS})"
LONG = f"{GAPS}, long AS (SELECT * FROM ({long_sql('gaps', NUMBERS)}) WHERE value IS NOT NULL)"


@query(
    "histogram",
    steady_query(
        f"""{LONG}, e AS (SELECT variable, min(value) AS lo, max(value) AS hi FROM long GROUP BY variable),
            c AS (SELECT variable, least(floor((value - lo) / ((hi - lo) / 25)), 24)::INT AS bin, count(*) AS n
                  FROM long JOIN e USING (variable) GROUP BY ALL)
            SELECT e.variable, b.bin::INT AS bin, lo + b.bin * ((hi - lo) / 25) AS left_edge,
                   lo + (b.bin + 1) * ((hi - lo) / 25) AS right_edge, coalesce(c.n, 0) AS n
            FROM e CROSS JOIN range(25) b(bin) LEFT JOIN c ON c.variable = e.variable AND c.bin = b.bin""",
        ["variable", "bin", "n"],
        ["left_edge", "right_edge"],
    ),
)
def histogram(spark, folder):
    return steady(ops.histogram(lineitem_with_gaps(spark, folder), NUMBERS, bins=25))


def _boxes_sql(keys: str) -> str:
    """Box statistics of a relation ``long`` with a ``value`` column, per key columns."""
    same = " AND ".join(f"l.{k} = q.{k}" for k in keys.split(", "))
    listed = ", ".join(f"l.{k}" for k in keys.split(", "))
    return f"""
        SELECT {listed}, count(*) AS n, max(q1) AS q1, max(med) AS median, max(q3) AS q3,
               min(value) FILTER (WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS low_whisker,
               max(value) FILTER (WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS high_whisker,
               count(*) FILTER (WHERE value NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
        FROM long l JOIN (SELECT {keys}, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS med,
                                 quantile_cont(value, 0.75) AS q3 FROM long GROUP BY {keys}) q ON {same}
        GROUP BY {listed}"""


BOX = ["q1", "median", "q3", "low_whisker", "high_whisker"]


@query("column_boxes", steady_query(f"{LONG} {_boxes_sql('variable')}", ["variable", "n", "outliers"], BOX))
def column_boxes(spark, folder):
    return steady(ops.column_boxes(lineitem_with_gaps(spark, folder), NUMBERS))


@query(
    "column_boxes_log10",
    steady_query(
        f"""WITH shifted AS (SELECT l_quantity, l_extendedprice - 50000 AS profit FROM lineitem),
            long AS (SELECT variable, log10(value) AS value FROM ({long_sql("shifted", ["l_quantity", "profit"])})
                     WHERE value > 0)
            {_boxes_sql("variable")}""",
        ["variable", "n", "outliers"],
        BOX,
    ),
)
def column_boxes_log10(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn("profit", F.col("l_extendedprice") - 50000)
    return steady(ops.column_boxes(lines, ["l_quantity", "profit"], log10=True))


@query(
    "grouped_boxes",
    steady_query(
        f"WITH long AS (SELECT event_type, value FROM events) {_boxes_sql('event_type')}",
        ["event_type", "n", "outliers"],
        BOX,
    ),
)
def grouped_boxes(spark, folder):
    # a handful of event types, whatever the number of events
    return steady(ops.box_statistics(table(spark, folder, "events"), ["event_type"], small=True))


@query(
    "boxes_of_many_groups",
    steady_query(
        f"WITH long AS (SELECT o_custkey, o_totalprice AS value FROM orders) {_boxes_sql('o_custkey')}",
        ["o_custkey", "n", "outliers"],
        BOX,
    ),
)
def boxes_of_many_groups(spark, folder):
    return steady(ops.box_statistics(table(spark, folder, "orders"), ["o_custkey"], "o_totalprice"))


@query(
    "box_outliers",
    """WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
                  FROM events GROUP BY event_type)
       SELECT e.event_type, value, count(*) AS n FROM events e JOIN q ON e.event_type = q.event_type
       WHERE value NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) GROUP BY e.event_type, value""",
)
def box_outliers(spark, folder):
    return ops.box_outliers(table(spark, folder, "events"), ["event_type"], small=True)


@query(
    "density",
    steady_query(
        f"""WITH long AS ({long_sql("events", ["value"])} UNION ALL {long_sql("part", ["p_size", "p_retailprice"])}),
            s AS (SELECT variable, count(*) AS n, min(value) - 0.5 * (max(value) - min(value)) AS start,
                         2.0 * (max(value) - min(value)) / 199 AS step,
                         stddev_samp(value) * pow(count(*), -0.2) AS h FROM long GROUP BY variable),
            g AS (SELECT s.*, point, start + point * step AS x_value FROM s, range(200) r(point))
            SELECT g.variable, point, x_value,
                   sum(exp(-0.5 * ((x_value - value) / h) ** 2)) / (max(n) * max(h) * sqrt(2 * pi())) AS density
            FROM g JOIN long l ON l.variable = g.variable GROUP BY g.variable, point, x_value""",
        ["variable", "point"],
        ["x_value", "density"],
    ),
)
def density(spark, folder):
    events = ops.density(table(spark, folder, "events"), ["value"], points=200)
    parts = ops.density(table(spark, folder, "part"), ["p_size", "p_retailprice"], points=200)
    return steady(events.unionByName(parts))


@query("scatter_points", f"{GAPS} SELECT l_orderkey, l_quantity, l_extendedprice FROM gaps WHERE l_quantity IS NOT NULL")
def scatter_points(spark, folder):
    return ops.scatter_points(lineitem_with_gaps(spark, folder), "l_quantity", "l_extendedprice", "l_orderkey")


@query(
    "scatter_bins",
    f"""{GAPS}, p AS (SELECT l_quantity AS x, l_extendedprice AS y FROM gaps WHERE l_quantity IS NOT NULL),
        e AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM p)
        SELECT least(floor((x - x0) / ((x1 - x0) / 50)), 49)::INT AS x_bin,
               least(floor((y - y0) / ((y1 - y0) / 50)), 49)::INT AS y_bin, count(*) AS n
        FROM p, e GROUP BY ALL""",
)
def scatter_bins(spark, folder):
    return ops.scatter_bins(lineitem_with_gaps(spark, folder), "l_quantity", "l_extendedprice")


@query(
    "stacked_bars",
    steady_query(
        f"""{GAPS}, c AS (SELECT l_returnflag, l_linenumber, count(*) AS n FROM gaps WHERE l_returnflag IS NOT NULL
                         GROUP BY ALL),
            h AS (SELECT l_returnflag, l_linenumber,
                         100.0::DOUBLE * n / sum(n) OVER (PARTITION BY l_returnflag) AS height FROM c)
            SELECT *, coalesce(sum(height) OVER (PARTITION BY l_returnflag ORDER BY l_linenumber
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base FROM h""",
        ["l_returnflag", "l_linenumber"],
        ["height", "base"],
    ),
)
def stacked_bars(spark, folder):
    return steady(ops.stacked_bars(lineitem_with_gaps(spark, folder), "l_returnflag", "l_linenumber"))


@query(
    "heat_map",
    steady_query(
        f"{GAPS} "
        + " UNION ALL ".join(
            f"SELECT '{a}' AS x, '{b}' AS y, corr({a}, {b}) AS r FROM gaps"
            for i, a in enumerate(NUMBERS)
            for b in NUMBERS[:i]
        ),
        ["x", "y"],
        ["r"],
    ),
)
def heat_map(spark, folder):
    return steady(ops.heat_map(lineitem_with_gaps(spark, folder), NUMBERS))
