"""Cleaning rules and reading of delimited text."""

from functools import partial

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tallywick.functions.values import finite
from tallywick.operators import cleaning as ops
from tallywick.operators.features import with_bands, with_labels, with_z_scores
from tallywick.operators.profiling import per_column
from tallywick.operators.runs import run_facts
from tallywick.operators.shaping import copied
from tallywick.plans.registry import LINEITEM_WITH_GAPS, lineitem_with_gaps, query, steady, steady_query, steady_sql
from tallywick.sources.files import parse_delimited, table

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]

# every order as text, some customers unreadable, with one repeated header row
ORDERS_AS_TEXT = """
    SELECT o_orderkey::VARCHAR AS o_orderkey,
           CASE WHEN o_orderkey % 23 = 0 THEN '?' ELSE o_custkey::VARCHAR END AS o_custkey,
           o_orderstatus, (o_totalprice * 100)::BIGINT::VARCHAR AS o_totalprice
    FROM orders UNION ALL SELECT 'o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice'
"""


def _orders_as_text(spark, folder):
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.when(F.col("o_orderkey") % 23 == 0, F.lit("?")).otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        "o_orderstatus",
        F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string").alias("o_totalprice"),
    )
    header = spark.range(1).select(*[F.lit(c).alias(c) for c in orders.columns])
    return orders.unionByName(header)


@query("header_rows_removed", f"WITH t AS ({ORDERS_AS_TEXT}) SELECT * FROM t WHERE o_orderkey <> 'o_orderkey'")
def header_rows_removed(spark, folder):
    return ops.without_header_rows(_orders_as_text(spark, folder))


@query(
    "duplicates_removed",
    """SELECT DISTINCT * FROM (
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
        UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 50 = 0)""",
)
def duplicates_removed(spark, folder):
    orders = table(spark, folder, "orders").select(*ORDER_COLUMNS)
    return ops.without_duplicates(orders.unionByName(orders.where(F.col("o_orderkey") % 50 == 0)))


@query(
    "typed_columns",
    f"""WITH t AS ({ORDERS_AS_TEXT})
        SELECT floor(try_cast(o_orderkey AS DOUBLE))::BIGINT AS o_orderkey,
               floor(try_cast(o_custkey AS DOUBLE))::BIGINT AS o_custkey,
               o_orderstatus, try_cast(o_totalprice AS DOUBLE) AS o_totalprice
        FROM t""",
)
def typed_columns(spark, folder):
    return ops.typed(_orders_as_text(spark, folder), ["o_orderkey", "o_custkey"], ["o_totalprice"])


@query(
    "rest_as_text",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderstatus FROM orders",
)
def rest_as_text(spark, folder):
    return ops.rest_as_text(table(spark, folder, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus"))


KEYS = ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"]
GAPS = f"WITH gaps AS ({LINEITEM_WITH_GAPS})"


def _gaps(spark, folder):
    return lineitem_with_gaps(spark, folder).select(*KEYS)


RANGE_DROP = {"name": "quantity range", "column": "l_quantity", "min": 5, "max": 45, "action": "drop"}
RANGE_NULL = RANGE_DROP | {"action": "null"}
ALLOWED = {"name": "known flags", "column": "l_returnflag", "allowed": ["A", "N"], "action": "null"}
BOTH = {
    "name": "first line returned",
    "any": [[{"column": "l_linenumber", "equals": 1}, {"column": "l_returnflag", "equals": "R"}]],
    "action": "drop",
}
ANY_OF = {
    "name": "two patterns",
    "any": [
        [{"column": "l_linenumber", "equals": 1}, {"column": "l_returnflag", "equals": "R"}],
        [{"column": "l_linenumber", "equals": 2}, {"column": "l_quantity", "equals": 10}],
    ],
    "action": "drop",
}
NEGATED = {
    "name": "third line not returned",
    "any": [[{"column": "l_linenumber", "equals": 3}, {"column": "l_returnflag", "differs": "R"}]],
    "action": "null",
    "clear": ["l_quantity"],
}


@query(
    "range_rule_drop",
    f"""{GAPS} SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM gaps
        WHERE l_quantity IS NULL OR l_quantity BETWEEN 5 AND 45""",
)
def range_rule_drop(spark, folder):
    return ops.apply_rules(_gaps(spark, folder), [RANGE_DROP])


@query(
    "range_rule_drop_missing",
    f"""{GAPS} SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM gaps
        WHERE l_quantity BETWEEN 5 AND 45""",
)
def range_rule_drop_missing(spark, folder):
    return ops.apply_rules(_gaps(spark, folder), [RANGE_DROP | {"nulls": "drop"}])


@query(
    "range_rule_null",
    f"""{GAPS} SELECT l_orderkey, l_linenumber,
        CASE WHEN l_quantity BETWEEN 5 AND 45 THEN l_quantity END AS l_quantity, l_returnflag FROM gaps""",
)
def range_rule_null(spark, folder):
    return ops.apply_rules(_gaps(spark, folder), [RANGE_NULL])


@query(
    "allowed_rule_null",
    f"""{GAPS} SELECT l_orderkey, l_linenumber, l_quantity,
        CASE WHEN l_returnflag IN ('A', 'N') THEN l_returnflag END AS l_returnflag FROM gaps""",
)
def allowed_rule_null(spark, folder):
    return ops.apply_rules(_gaps(spark, folder), [ALLOWED])


@query(
    "allowed_rule_drop",
    f"""{GAPS} SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM gaps
        WHERE l_returnflag IS NULL OR l_returnflag IN ('A', 'N')""",
)
def allowed_rule_drop(spark, folder):
    return ops.apply_rules(_gaps(spark, folder), [ALLOWED | {"action": "drop"}])


@query(
    "equality_rule",
    f"""{GAPS} SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM gaps
        WHERE NOT (l_linenumber = 1 AND coalesce(l_returnflag = 'R', false))""",
)
def equality_rule(spark, folder):
    return ops.apply_rules(_gaps(spark, folder), [BOTH])


@query(
    "any_of_rule",
    f"""{GAPS} SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM gaps
        WHERE NOT (l_linenumber = 1 AND coalesce(l_returnflag = 'R', false))
          AND NOT (l_linenumber = 2 AND coalesce(l_quantity = 10, false))""",
)
def any_of_rule(spark, folder):
    return ops.apply_rules(_gaps(spark, folder), [ANY_OF])


@query(
    "negated_rule",
    f"""{GAPS} SELECT l_orderkey, l_linenumber,
        CASE WHEN l_linenumber = 3 AND l_returnflag <> 'R' THEN NULL ELSE l_quantity END AS l_quantity,
        l_returnflag FROM gaps""",
)
def negated_rule(spark, folder):
    return ops.apply_rules(_gaps(spark, folder), [NEGATED])


@query(
    "attrition",
    f"""{GAPS}, flags AS (
        SELECT coalesce(l_quantity < 5 OR l_quantity > 45, false) AS f1,
               coalesce(l_returnflag NOT IN ('A', 'N'), false) AS f2,
               l_linenumber = 1 AND coalesce(l_returnflag = 'R', false) AS f3,
               coalesce(l_linenumber = 3 AND l_returnflag <> 'R', false) AS f4
        FROM gaps)
        SELECT 'quantity range' AS rule, 'drop' AS action, count(*) FILTER (WHERE f1) AS alone,
               count(*) FILTER (WHERE f1) AS in_order FROM flags
        UNION ALL SELECT 'first line returned', 'drop', count(*) FILTER (WHERE f3),
               count(*) FILTER (WHERE f3 AND NOT f1) FROM flags
        UNION ALL SELECT 'known flags', 'null', count(*) FILTER (WHERE f2),
               count(*) FILTER (WHERE f2 AND NOT f1 AND NOT f3) FROM flags
        UNION ALL SELECT 'third line not returned', 'null', count(*) FILTER (WHERE f4),
               count(*) FILTER (WHERE f4 AND NOT f2 AND NOT f1 AND NOT f3) FROM flags""",
)
def attrition(spark, folder):
    return ops.attrition(_gaps(spark, folder), [RANGE_DROP, BOTH, ALLOWED, NEGATED])


@query(
    "missing_dropped",
    f"""{GAPS} SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM gaps
        WHERE l_quantity IS NOT NULL AND l_returnflag IS NOT NULL""",
)
def missing_dropped(spark, folder):
    return ops.without_missing(_gaps(spark, folder), ["l_quantity", "l_returnflag"])


@query(
    "finite_samples",
    f"""SELECT 'x' AS variable, count(*) AS n, {steady_sql("avg(value)")} AS mean
        FROM events WHERE event_id % 7 NOT IN (0, 1, 2)""",
)
def finite_samples(spark, folder):
    odd = F.col("event_id") % 7
    events = table(spark, folder, "events").select(
        F.when(odd == 0, F.lit(float("nan")))
        .when(odd == 1, F.lit(float("inf")))
        .when(odd == 2, F.lit(float("-inf")))
        .otherwise(F.col("value"))
        .alias("x")
    )
    return steady(
        per_column(
            events.withColumn("x", finite(F.col("x"))),
            ["x"],
            lambda _, x: [F.count(x).alias("n"), F.avg(x).alias("mean")],
        )
    )


@query(
    "cleaning_chain",
    steady_query(
        f"""WITH t AS ({ORDERS_AS_TEXT}
                       UNION ALL SELECT o_orderkey::VARCHAR,
                           CASE WHEN o_orderkey % 23 = 0 THEN '?' ELSE o_custkey::VARCHAR END,
                           o_orderstatus, (o_totalprice * 100)::BIGINT::VARCHAR
                       FROM orders WHERE o_orderkey % 50 = 0),
            d AS (SELECT DISTINCT * FROM t WHERE o_orderkey <> 'o_orderkey'),
            c AS (SELECT try_cast(o_orderkey AS BIGINT) AS o_orderkey, try_cast(o_custkey AS BIGINT) AS o_custkey,
                         o_orderstatus, o_totalprice::DOUBLE AS o_totalprice FROM d),
            k AS (SELECT * FROM c WHERE o_totalprice BETWEEN 2000000 AND 45000000
                  AND NOT (o_orderstatus = 'P' AND coalesce(o_custkey <> 1, false)))
            SELECT *, o_totalprice AS price,
                   (o_totalprice - (SELECT avg(o_totalprice) FROM k)) / (SELECT stddev_samp(o_totalprice) FROM k)
                       AS o_totalprice_zscore,
                   CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS status,
                   CASE WHEN o_totalprice <= 10000000 THEN 'low' WHEN o_totalprice <= 30000000 THEN 'middle'
                        ELSE 'high' END AS band
            FROM k""",
        ["o_orderkey", "o_custkey", "o_orderstatus", "status", "band"],
        ["o_totalprice", "price", "o_totalprice_zscore"],
        digits=6,
    ),
)
def cleaning_chain(spark, folder):
    texts = _orders_as_text(spark, folder)
    raw = texts.unionByName(texts.where(F.col("o_orderkey").try_cast("bigint") % 50 == 0))
    rules = [
        {"name": "price", "column": "o_totalprice", "min": 2_000_000, "max": 45_000_000, "action": "drop"},
        {
            "name": "pending",
            "any": [[{"column": "o_orderstatus", "equals": "P"}, {"column": "o_custkey", "differs": 1}]],
            "action": "drop",
        },
    ]
    clean = ops.cleaned(
        raw,
        [
            ops.without_header_rows,
            ops.without_duplicates,
            partial(ops.typed, integers=["o_orderkey", "o_custkey"], floats=["o_totalprice"]),
            partial(ops.apply_rules, rules=rules),
            partial(copied, source="o_totalprice", target="price"),
            partial(with_z_scores, columns=["o_totalprice"]),
            partial(with_labels, column="o_orderstatus", labels={"F": "finished", "O": "open"}, target="status"),
            partial(
                with_bands,
                column="o_totalprice",
                edges=[0, 10_000_000, 30_000_000, 100_000_000],
                names=["low", "middle", "high"],
                target="band",
            ),
            ops.rest_as_text,
        ],
    )
    return steady(clean, digits=6)


@query(
    "parsed_lines",
    """SELECT o_orderkey AS key, CASE WHEN o_orderkey % 23 NOT IN (0, 1) THEN o_custkey END AS customer,
              CASE WHEN o_orderkey % 23 <> 2 THEN o_totalprice END AS price,
              CASE WHEN o_orderkey % 23 <> 3 THEN o_orderstatus END AS status FROM orders""",
)
def parsed_lines(spark, folder):
    """Delimited lines with three null tokens, read with a given schema."""
    odd = F.col("o_orderkey") % 23
    lines = table(spark, folder, "orders").select(
        F.concat_ws(
            ",",
            F.col("o_orderkey").cast("string"),
            F.when(odd == 0, F.lit("?")).when(odd == 1, F.lit("NA")).otherwise(F.col("o_custkey").cast("string")),
            F.when(odd == 2, F.lit("NaN")).otherwise(F.col("o_totalprice").cast("string")),
            F.when(odd == 3, F.lit("?")).otherwise(F.col("o_orderstatus")),
        ).alias("line")
    )
    schema = StructType(
        [
            StructField("key", LongType()),
            StructField("customer", LongType()),
            StructField("price", DoubleType()),
            StructField("status", StringType()),
        ]
    )
    return parse_delimited(lines, "line", schema, ["?", "NA", "NaN"])


@query(
    "run_facts",
    f"""{GAPS} SELECT (SELECT count(*) FROM gaps) AS rows_before, 4 AS columns_before,
               count(*) AS rows_after, 4 AS columns_after,
               count(*) - count(l_returnflag) AS missing_returnflag, 0.05::DOUBLE AS alpha
        FROM gaps WHERE l_quantity IS NOT NULL""",
)
def facts(spark, folder):
    before = _gaps(spark, folder)
    rows = run_facts(before, ops.without_missing(before, ["l_quantity"]), ["summary"], 0.05)
    return rows.select(
        F.col("before.rows").alias("rows_before"),
        F.col("before.columns").alias("columns_before"),
        F.col("after.rows").alias("rows_after"),
        F.col("after.columns").alias("columns_after"),
        F.col("after.missing.l_returnflag").alias("missing_returnflag"),
        "alpha",
    )
