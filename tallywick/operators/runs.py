"""Facts about a run: what went in, what came out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_facts(before: DataFrame, after: DataFrame, outputs: Sequence[str], alpha: float) -> DataFrame:
    """One row: time, table sizes, NULLs per column of the result, outputs and alpha."""
    nulls = F.struct(*[F.count_if(F.col(c).isNull()).alias(c) for c in after.columns])
    result = after.agg(
        F.struct(
            F.count(F.lit(1)).alias("rows"), F.lit(len(after.columns)).alias("columns"), nulls.alias("missing")
        ).alias("after")
    )
    source = before.agg(F.struct(F.count(F.lit(1)).alias("rows"), F.lit(len(before.columns)).alias("columns")))
    return result.select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("run_at"),
        source.scalar().alias("before"),
        "after",
        F.array(*map(F.lit, outputs)).alias("outputs"),
        F.lit(alpha).alias("alpha"),
    )


def as_json(df: DataFrame, name: str = "json") -> DataFrame:
    """Every row as one JSON object, missing values included."""
    whole = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return df.select(whole.alias(name))


def from_json_rows(df: DataFrame, name: str, schema) -> DataFrame:
    """The rows that JSON objects describe."""
    return df.select(F.from_json(F.col(name), schema).alias("row")).select("row.*")
