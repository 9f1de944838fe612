"""Selecting, filtering and reshaping."""

from pyspark.sql import functions as F

from tallywick.functions.values import slug
from tallywick.operators import shaping as ops
from tallywick.plans.registry import LINEITEM_WITH_GAPS, lineitem_with_gaps, query, steady, steady_query
from tallywick.sources.files import table

TYPES = ["click", "error", "purchase", "signup", "view"]
EVENT_VALUES = """
    SELECT user_id, event_type, CASE WHEN user_id % 10 <> 0 THEN value END AS value FROM events
"""


def _event_values(spark, folder):
    return table(spark, folder, "events").select(
        "user_id", "event_type", F.when(F.col("user_id") % 10 != 0, F.col("value")).alias("value")
    )


@query(
    "standardised_source",
    """SELECT o_orderkey AS id, CASE WHEN o_custkey % 19 <> 0 THEN o_custkey END AS customer, o_totalprice AS amount
       FROM orders WHERE year(o_orderdate) = 1997 AND o_custkey % 19 <> 0""",
)
def standardised_source(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_custkey") % 19 != 0, F.col("o_custkey")).alias("o_custkey"),
        "o_totalprice",
        "o_orderdate",
    )
    names = {"o_orderkey": "id", "o_custkey": "customer", "o_totalprice": "amount"}
    return ops.standardised(orders, names, required=["customer"], years={"o_orderdate": 1997})


@query("copied_column", "SELECT p_partkey, p_size, p_size AS size FROM part")
def copied_column(spark, folder):
    return ops.copied(table(spark, folder, "part").select("p_partkey", "p_size"), "p_size", "size")


@query(
    "code_filter",
    "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')",
)
def code_filter(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return ops.only_codes(customers, "c_mktsegment", ["BUILDING", "MACHINERY"])


@query(
    "code_table_filter",
    """SELECT n_nationkey, n_name FROM nation
       WHERE n_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 0)""",
)
def code_table_filter(spark, folder):
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    codes = table(spark, folder, "supplier").where("s_acctbal > 0").select("s_nationkey")
    return ops.only_codes(nations, "n_nationkey", codes)


YEARS = [str(y) for y in range(1995, 2002)]
TOTALS_BY_YEAR = (
    "SELECT o_custkey, "
    + ", ".join(f'sum(CASE WHEN year(o_orderdate) = {y} THEN o_totalprice END) AS "{y}"' for y in YEARS)
    + " FROM orders GROUP BY o_custkey"
)


def _totals_by_year(spark, folder):
    orders = table(spark, folder, "orders").withColumn("year", F.year("o_orderdate").cast("string"))
    return orders.groupBy("o_custkey").pivot("year", YEARS).agg(F.sum("o_totalprice"))


@query(
    "year_column",
    steady_query(f'WITH w AS ({TOTALS_BY_YEAR}) SELECT o_custkey, "1996" AS total FROM w', ["o_custkey"], ["total"]),
)
def year_column(spark, folder):
    return steady(ops.column_as_value(_totals_by_year(spark, folder), ["o_custkey"], "1996", "total"))


@query(
    "years_as_rows",
    steady_query(
        f"WITH w AS ({TOTALS_BY_YEAR}) "
        + " UNION ALL ".join(f"SELECT o_custkey, '{y}' AS year, \"{y}\" AS total FROM w" for y in YEARS),
        ["o_custkey", "year"],
        ["total"],
    ),
)
def years_as_rows(spark, folder):
    return steady(ops.wide_to_long(_totals_by_year(spark, folder), ["o_custkey"], YEARS, "year", "total"))


@query(
    "complete_pairs",
    f"""WITH gaps AS ({LINEITEM_WITH_GAPS}) SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM gaps
        WHERE l_quantity IS NOT NULL AND l_returnflag IS NOT NULL""",
)
def complete_pairs(spark, folder):
    return ops.complete_pairs(
        lineitem_with_gaps(spark, folder), "l_quantity", "l_returnflag", ["l_orderkey", "l_linenumber"]
    )


@query(
    "stacked_parts",
    "SELECT event_id, value, event_type AS part FROM events",
)
def stacked_parts(spark, folder):
    events = table(spark, folder, "events")
    parts = {t: events.where(F.col("event_type") == t).select("event_id", "value") for t in TYPES}
    return ops.stacked_parts(parts, "part")


def _cells_sql(kinds):
    return ", ".join(f"avg(CASE WHEN event_type = '{k}' THEN value END) AS {k}" for k in kinds)


WIDE = f"""WITH v AS ({EVENT_VALUES}), w AS (SELECT user_id, {_cells_sql(TYPES)} FROM v GROUP BY user_id)
    SELECT * FROM w WHERE coalesce({", ".join(TYPES)}) IS NOT NULL"""


@query("wide_means", steady_query(WIDE, ["user_id"], TYPES))
def wide_means(spark, folder):
    return steady(ops.wide_means(_event_values(spark, folder), "user_id", "event_type", "value", TYPES))


@query(
    "row_means",
    steady_query(
        f"""WITH m AS ({WIDE})
            SELECT user_id, list_avg([{", ".join(TYPES)}]) AS composite FROM m""",
        ["user_id"],
        ["composite"],
    ),
)
def row_means(spark, folder):
    wide = ops.wide_means(_event_values(spark, folder), "user_id", "event_type", "value", TYPES)
    return steady(ops.with_row_mean(wide, TYPES, "composite").select("user_id", "composite"))


@query(
    "group_means",
    steady_query(
        """SELECT l_returnflag, count(*) AS n, avg(l_quantity) AS l_quantity, avg(l_extendedprice) AS l_extendedprice,
                  avg(l_discount) AS l_discount, avg(l_tax) AS l_tax FROM lineitem GROUP BY l_returnflag""",
        ["l_returnflag", "n"],
        ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
    ),
)
def group_means(spark, folder):
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return steady(ops.group_means(table(spark, folder, "lineitem"), "l_returnflag", columns))


@query("distinct_groups", "SELECT DISTINCT c_mktsegment FROM customer ORDER BY c_mktsegment")
def distinct_groups(spark, folder):
    return ops.distinct_groups(table(spark, folder, "customer"), "c_mktsegment")


@query(
    "first_rows",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
)
def first_rows(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return ops.first_rows(orders, [F.desc("o_totalprice"), "o_orderkey"], 10)


@query(
    "name_slugs",
    """SELECT p_name || ' ' || p_brand AS pair, regexp_replace(lower(trim(p_name || ' ' || p_brand)), '[^a-z0-9]+', '_', 'g')
           AS slug, count(*) AS n FROM part GROUP BY ALL""",
)
def name_slugs(spark, folder):
    pairs = table(spark, folder, "part").select(F.concat_ws(" ", "p_name", "p_brand").alias("pair"))
    return pairs.groupBy("pair", slug(F.col("pair")).alias("slug")).agg(F.count(F.lit(1)).alias("n"))
