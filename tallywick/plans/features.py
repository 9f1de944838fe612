"""Feature engineering."""

from pyspark.sql import functions as F

from tallywick.operators import features as ops
from tallywick.plans.registry import LINEITEM_WITH_GAPS, lineitem_with_gaps, query, steady, steady_query
from tallywick.sources.files import table

GAPS = f"WITH gaps AS ({LINEITEM_WITH_GAPS})"
ROW = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"]


@query(
    "labels_of_codes",
    """SELECT s_suppkey, CASE s_nationkey WHEN 0 THEN 'zero' WHEN 1 THEN 'one' WHEN 2 THEN 'two' END AS label
       FROM supplier""",
)
def labels_of_codes(spark, folder):
    suppliers = table(spark, folder, "supplier")
    named = ops.with_labels(suppliers, "s_nationkey", {0: "zero", 1: "one", 2: "two"}, "label")
    return named.select("s_suppkey", "label")


EDGES, NAMES = [5, 10, 20, 40], ["few", "some", "many"]


@query(
    "bands_closed_right",
    """SELECT p_partkey, CASE WHEN p_size BETWEEN 5 AND 10 THEN 'few' WHEN p_size > 10 AND p_size <= 20 THEN 'some'
              WHEN p_size > 20 AND p_size <= 40 THEN 'many' END AS band FROM part""",
)
def bands_closed_right(spark, folder):
    return ops.with_bands(table(spark, folder, "part"), "p_size", EDGES, NAMES, "band").select("p_partkey", "band")


@query(
    "bands_closed_left",
    """SELECT p_partkey, CASE WHEN p_size >= 5 AND p_size < 10 THEN 'few' WHEN p_size >= 10 AND p_size < 20 THEN 'some'
              WHEN p_size >= 20 AND p_size < 40 THEN 'many' END AS band FROM part""",
)
def bands_closed_left(spark, folder):
    banded = ops.with_bands(table(spark, folder, "part"), "p_size", EDGES, NAMES, "band", closed="left")
    return banded.select("p_partkey", "band")


@query(
    "z_scores",
    steady_query(
        """SELECT o_orderkey, (o_totalprice - avg(o_totalprice) OVER ()) / stddev_samp(o_totalprice) OVER ()
                  AS o_totalprice_zscore, NULL::DOUBLE AS same_zscore FROM orders""",
        ["o_orderkey"],
        ["o_totalprice_zscore", "same_zscore"],
        digits=6,
    ),
)
def z_scores(spark, folder):
    orders = table(spark, folder, "orders").withColumn("same", F.lit(3.0))
    rows = ops.with_z_scores(orders, ["o_totalprice", "same"])
    return steady(rows.select("o_orderkey", "o_totalprice_zscore", "same_zscore"), digits=6)


@query(
    "medians_filled",
    f"""{GAPS} SELECT l_orderkey, l_linenumber,
            coalesce(l_quantity, (SELECT median(l_quantity) FROM gaps)) AS l_quantity, l_extendedprice FROM gaps""",
)
def medians_filled(spark, folder):
    lines = lineitem_with_gaps(spark, folder).select(*ROW)
    return ops.with_medians_filled(lines, ["l_quantity", "l_extendedprice"])


@query(
    "standardised_columns",
    steady_query(
        """SELECT o_orderkey, (o_totalprice - avg(o_totalprice) OVER ()) / stddev_pop(o_totalprice) OVER ()
                  AS o_totalprice_std FROM orders""",
        ["o_orderkey"],
        ["o_totalprice_std"],
        digits=6,
    ),
)
def standardised_columns(spark, folder):
    rows = ops.standardised_columns(table(spark, folder, "orders"), ["o_totalprice"])
    return steady(rows.select("o_orderkey", "o_totalprice_std"), digits=6)


HASH = "('0x' || substr(md5({key}::VARCHAR), 1, 8))::UBIGINT::BIGINT"


@query(
    "split_by_key",
    f"""SELECT o_orderkey, CASE WHEN {HASH.format(key="o_orderkey")} % 100 < 80 THEN 'train' ELSE 'test' END AS part,
               ({HASH.format(key="o_orderkey")} % 5)::INT AS fold FROM orders""",
)
def split_by_key(spark, folder):
    rows = ops.split_by_key(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey")
    return ops.with_fold(rows, "o_orderkey")
