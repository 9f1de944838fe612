"""Joins of several tables."""

from pyspark.sql import functions as F

from tallywick.operators import joining as ops
from tallywick.operators.features import standardised_columns
from tallywick.plans.registry import query, steady, steady_query
from tallywick.sources.files import table


def _customer_parts(spark, folder):
    orders = table(spark, folder, "orders").withColumn(
        "custkey", F.when(F.col("o_custkey") % 19 != 0, F.col("o_custkey"))
    )
    return {
        "customer": table(spark, folder, "customer").select(F.col("c_custkey").alias("custkey"), "c_acctbal"),
        "orders": orders.groupBy("custkey").agg(
            F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total")
        ),
        "urgent": orders.where(F.col("o_orderpriority").startswith("1"))
        .groupBy("custkey")
        .agg(F.count(F.lit(1)).alias("n")),
    }


CUSTOMER_PARTS = """
    WITH o AS (SELECT *, CASE WHEN o_custkey % 19 <> 0 THEN o_custkey END AS custkey FROM orders),
    per AS (SELECT custkey, count(*) AS n, sum(o_totalprice) AS total FROM o GROUP BY custkey),
    urgent AS (SELECT custkey, count(*) AS n FROM o WHERE o_orderpriority LIKE '1%' GROUP BY custkey)
"""


@query(
    "inner_chain",
    steady_query(
        f"""{CUSTOMER_PARTS} SELECT c_custkey AS custkey, c_acctbal, per.n AS n_orders, total, urgent.n AS n_urgent
            FROM customer JOIN per ON c_custkey = per.custkey JOIN urgent ON c_custkey = urgent.custkey""",
        ["custkey", "n_orders", "n_urgent"],
        ["c_acctbal", "total"],
    ),
)
def inner_chain(spark, folder):
    return steady(ops.chained(_customer_parts(spark, folder), "custkey"))


@query(
    "outer_chain",
    steady_query(
        f"""{CUSTOMER_PARTS}, known AS (SELECT * FROM per WHERE custkey IS NOT NULL),
            hurry AS (SELECT * FROM urgent WHERE custkey IS NOT NULL)
            SELECT coalesce(c_custkey, known.custkey, hurry.custkey) AS custkey, c_acctbal, known.n AS n_orders, total,
                   hurry.n AS n_urgent
            FROM customer FULL JOIN known ON c_custkey = known.custkey
            FULL JOIN hurry ON coalesce(c_custkey, known.custkey) = hurry.custkey""",
        ["custkey", "n_orders", "n_urgent"],
        ["c_acctbal", "total"],
    ),
)
def outer_chain(spark, folder):
    return steady(ops.full_chain(_customer_parts(spark, folder), "custkey"))


@query(
    "null_safe_join",
    steady_query(
        f"""{CUSTOMER_PARTS} SELECT per.custkey, per.n AS n_orders, total, urgent.n AS n_urgent
            FROM per JOIN urgent ON per.custkey IS NOT DISTINCT FROM urgent.custkey""",
        ["custkey", "n_orders", "n_urgent"],
        ["total"],
    ),
)
def null_safe_join(spark, folder):
    parts = _customer_parts(spark, folder)
    return steady(ops.chained({k: parts[k] for k in ("orders", "urgent")}, "custkey", null_safe=True))


TYPES = ["click", "error", "purchase", "signup", "view"]


@query(
    "outer_chain_by_pivot",
    steady_query(
        "SELECT user_id, "
        + ", ".join(f"avg(CASE WHEN event_type = '{t}' THEN value END) AS {t}" for t in TYPES)
        + " FROM events GROUP BY user_id",
        ["user_id"],
        TYPES,
    ),
)
def outer_chain_by_pivot(spark, folder):
    events = table(spark, folder, "events")
    parts = {t: events.where(F.col("event_type") == t).select("user_id", "value") for t in TYPES}
    return steady(ops.wide_from_parts(parts, "user_id", "value"))


@query(
    "star_chain",
    steady_query(
        """SELECT r_name, n_name, count(*) AS lines, sum(l_extendedprice * (1 - l_discount)) AS revenue
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
           JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
           GROUP BY r_name, n_name""",
        ["r_name", "n_name", "lines"],
        ["revenue"],
    ),
)
def star_chain(spark, folder):
    """Inner joins along the foreign keys, from the fact table to the region."""
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue")
    )
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("orderkey"), F.col("o_custkey").alias("custkey")
    )
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("custkey"), F.col("c_nationkey").alias("nationkey")
    )
    nations = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("nationkey"), "n_name", F.col("n_regionkey").alias("regionkey")
    )
    regions = table(spark, folder, "region").select(F.col("r_regionkey").alias("regionkey"), "r_name")
    wide = ops.joined(ops.joined(lines, orders, "orderkey"), customers, "custkey")
    wide = ops.joined(ops.joined(wide, nations, "nationkey"), regions, "regionkey")
    return steady(wide.groupBy("r_name", "n_name").agg(F.count(F.lit(1)).alias("lines"), F.sum("revenue").alias("revenue")))


@query(
    "colliding_names",
    """SELECT n_nationkey AS nationkey, n_customers AS n_customer, n_suppliers AS n_supplier
       FROM nation JOIN (SELECT c_nationkey, count(*) AS n_customers FROM customer GROUP BY c_nationkey)
            ON n_nationkey = c_nationkey
       JOIN (SELECT s_nationkey, count(*) AS n_suppliers FROM supplier GROUP BY s_nationkey) ON n_nationkey = s_nationkey""",
)
def colliding_names(spark, folder):
    def counted(name, column):
        rows = table(spark, folder, name).groupBy(F.col(column).alias("nationkey"))
        return rows.agg(F.count(F.lit(1)).alias("n"))

    parts = {
        "nation": table(spark, folder, "nation").select(F.col("n_nationkey").alias("nationkey")),
        "customer": counted("customer", "c_nationkey"),
        "supplier": counted("supplier", "s_nationkey"),
    }
    return ops.chained(parts, "nationkey")


@query(
    "compared_tables",
    steady_query(
        """SELECT a.event_type, a.n AS n_low, b.n AS n_high, a.mean AS mean_low, b.mean AS mean_high
           FROM (SELECT event_type, count(*) AS n, avg(value) AS mean FROM events WHERE value < 50 GROUP BY event_type) a
           JOIN (SELECT event_type, count(*) AS n, avg(value) AS mean FROM events WHERE value >= 50 GROUP BY event_type) b
           ON a.event_type = b.event_type""",
        ["event_type", "n_low", "n_high"],
        ["mean_low", "mean_high"],
    ),
)
def compared_tables(spark, folder):
    def summary(condition):
        rows = table(spark, folder, "events").where(condition).groupBy("event_type")
        return rows.agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"))

    return steady(ops.compared(summary("value < 50"), summary("value >= 50"), "event_type", ("_low", "_high")))


NAMED = """
    SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'Somewhere ' || c_nationkey
                           ELSE '  ' || lower(n_name) || ' ' END AS place
    FROM customer JOIN nation ON c_nationkey = n_nationkey
"""


def _named_customers(spark, folder):
    """Every customer with a nation name in free spelling, a fifth of them unknown."""
    nations = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    odd = F.concat(F.lit("Somewhere "), F.col("c_nationkey").cast("string"))
    usual = F.concat(F.lit("  "), F.lower("n_name"), F.lit(" "))
    customers = table(spark, folder, "customer").join(nations, "c_nationkey")
    return customers.select("c_custkey", F.when(F.col("c_custkey") % 5 == 0, odd).otherwise(usual).alias("place"))


@query(
    "resolved_names",
    f"""WITH named AS ({NAMED}) SELECT c_custkey, place, n_nationkey
        FROM named LEFT JOIN nation ON lower(trim(place)) = lower(trim(n_name))""",
)
def resolved_names(spark, folder):
    nations = table(spark, folder, "nation")
    return ops.resolved(_named_customers(spark, folder), "place", nations, "n_name", "n_nationkey")


@query(
    "unresolved_names",
    f"""WITH named AS ({NAMED}) SELECT place, count(*) AS n FROM named
        WHERE lower(trim(place)) NOT IN (SELECT lower(trim(n_name)) FROM nation) GROUP BY place""",
)
def unresolved_names(spark, folder):
    nations = table(spark, folder, "nation")
    return ops.unresolved(_named_customers(spark, folder), "place", nations, "n_name", "n_nationkey")


@query(
    "attached_by_key",
    steady_query(
        """SELECT c_custkey, c_mktsegment,
                  (c_acctbal - avg(c_acctbal) OVER ()) / stddev_pop(c_acctbal) OVER () AS c_acctbal_std FROM customer""",
        ["c_custkey", "c_mktsegment"],
        ["c_acctbal_std"],
        digits=6,
    ),
)
def attached_by_key(spark, folder):
    customers = table(spark, folder, "customer")
    computed = standardised_columns(customers.select("c_custkey", "c_acctbal"), ["c_acctbal"])
    rows = ops.with_attached(customers.select("c_custkey", "c_mktsegment"), computed, "c_custkey", ["c_acctbal_std"])
    return steady(rows, digits=6)
