"""Registration of queries, and the tables with gaps that several of them use."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tallywick.sources.files import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query under a name, with the SQL that must give the same rows."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def steady(df: DataFrame, digits: int = 8) -> DataFrame:
    """Rounds doubles to places that a different order of summation does not reach.

    Results with a row per input row use fewer digits: the more values there
    are, the closer one of them lies to the edge between two roundings.
    """

    def rounded(x: Column) -> Column:
        return F.when(F.abs(x) < 1000, F.round(x, digits)).otherwise(F.round(x, 4)) + F.lit(0.0)

    doubles = [f.name for f in df.schema if isinstance(f.dataType, DoubleType)]
    return df.withColumns({c: rounded(F.col(c)) for c in doubles})


def steady_sql(expression: str, digits: int = 8) -> str:
    return (
        f"(CASE WHEN abs({expression}) < 1000 THEN round(({expression})::DOUBLE, {digits}) "
        f"ELSE round(({expression})::DOUBLE, 4) END + 0.0::DOUBLE)"
    )


def steady_query(inner: str, plain: Sequence[str], doubles: Sequence[str], digits: int = 8) -> str:
    """Selects columns of an inner query, the doubles rounded as by :func:`steady`."""
    parts = [*plain, *[f"{steady_sql(c, digits)} AS {c}" for c in doubles]]
    return f"WITH result AS ({inner}) SELECT {', '.join(parts)} FROM result"


def lineitem_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """The whole lineitem table, some quantities and flags missing."""
    return (
        table(spark, folder, "lineitem")
        .withColumn("l_quantity", F.when(F.col("l_orderkey") % 17 != 0, F.col("l_quantity")))
        .withColumn("l_returnflag", F.when(F.col("l_orderkey") % 13 != 0, F.col("l_returnflag")))
    )


LINEITEM_WITH_GAPS = """
    SELECT * REPLACE (
        CASE WHEN l_orderkey % 17 <> 0 THEN l_quantity END AS l_quantity,
        CASE WHEN l_orderkey % 13 <> 0 THEN l_returnflag END AS l_returnflag)
    FROM lineitem
"""


def long_sql(source: str, columns: Sequence[str], keep: Sequence[str] = ()) -> str:
    """The numeric columns of a relation as ``(keep..., variable, value)`` rows."""
    kept = "".join(f"{k}, " for k in keep)
    return " UNION ALL ".join(
        f"SELECT {kept}'{c}' AS variable, {c}::DOUBLE AS value FROM {source}" for c in columns
    )
