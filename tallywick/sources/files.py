"""Delimited text, Parquet and JSON tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallywick.operators.shaping import stacked_parts


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a folder of tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def without_null_tokens(df: DataFrame, tokens: Sequence[str]) -> DataFrame:
    """Text that stands for a missing value becomes NULL."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    return df.withColumns({c: F.when(~F.trim(c).isin(*tokens), F.col(c)) for c in texts})


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    header: bool = True,
    null_tokens: Sequence[str] = ("",),
    separator: str = ",",
    spread: int | None = None,
) -> DataFrame:
    """Delimited text with a given schema, plain or gzip-compressed.

    Everything is read as text first, so that any of several null tokens is
    missing in any column; what cannot be cast becomes NULL.  A gzip file is one
    split whatever its size: ``spread`` redistributes its rows for the work
    after the scan.
    """
    raw = StructType([StructField(f.name, StringType()) for f in schema])
    rows = spark.read.schema(raw).csv(path, header=header, sep=separator, enforceSchema=False)
    rows = rows.repartition(spread) if spread else rows
    rows = without_null_tokens(rows, null_tokens)
    return rows.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def parse_delimited(lines: DataFrame, column: str, schema: StructType, null_tokens: Sequence[str]) -> DataFrame:
    """The same for lines of text that are already a column."""
    raw = StructType([StructField(f.name, StringType()) for f in schema])
    rows = lines.select(F.from_csv(F.col(column), raw.simpleString()[7:-1].replace(":", " ")).alias("r")).select("r.*")
    rows = without_null_tokens(rows, null_tokens)
    return rows.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def landed(spark: SparkSession, path: str, produce: Callable[[], DataFrame], refresh: bool = False) -> DataFrame:
    """A stored Parquet table, produced when it is absent, empty or a refresh is forced.

    While the stored table has rows, ``produce`` is not called, so its source may be gone.
    """
    if not refresh:
        try:
            stored = spark.read.parquet(path)
            if not stored.isEmpty():
                return stored
        except AnalysisException as missing:
            if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    produced = produce()
    produced.write.mode("overwrite").parquet(path)
    return spark.read.schema(produced.schema).parquet(path)


def read_parts(spark: SparkSession, paths: Mapping[str, str], tag: str) -> DataFrame:
    """Parquet tables of one shape below each other, each tagged with its name."""
    return stacked_parts({name: spark.read.parquet(path) for name, path in paths.items()}, tag)


def write_delimited(df: DataFrame, path: str, null_token: str = "NA") -> None:
    df.write.mode("overwrite").option("nullValue", null_token).option("emptyValue", "").csv(path, header=True)


def write_table(df: DataFrame, path: str, form: str = "parquet", partitions: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite").partitionBy(*partitions) if partitions else df.write.mode("overwrite")
    if form == "csv":
        writer.csv(path, header=True)
    else:
        writer.format(form).save(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per row, NULL fields included."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
