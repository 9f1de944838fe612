"""Selecting, renaming, filtering and reshaping tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywick.functions.values import row_mean


def in_year(df: DataFrame, column: str, year: int) -> Column:
    """``year(column) = year`` written as a half-open range of the column itself.

    A function of a column hides it from the scan; the range is two plain
    comparisons, which Parquet's statistics and row-group filters use.  Dates
    compare with dates, timestamps with the first instant of the year in the
    session's time zone.
    """
    kind = df.schema[column].dataType.typeName()
    if kind == "date":
        low, high = F.make_date(F.lit(year), F.lit(1), F.lit(1)), F.make_date(F.lit(year + 1), F.lit(1), F.lit(1))
    else:
        parse = F.to_timestamp_ntz if kind == "timestamp_ntz" else F.to_timestamp
        low, high = (parse(F.lit(f"{y:04d}-01-01 00:00:00")) for y in (year, year + 1))
    return (F.col(column) >= low) & (F.col(column) < high)


def standardised(
    df: DataFrame,
    columns: Mapping[str, str],
    where: Mapping[str, object] | None = None,
    required: Sequence[str] = (),
    years: Mapping[str, int] | None = None,
) -> DataFrame:
    """One source brought to a common form.

    ``columns`` maps old names to new ones and is also the selection, ``where``
    holds equality filters on the old names, ``years`` the year wanted of date
    or timestamp columns, ``required`` the new names that must be present.
    Filters (years as ranges) and selection reach the file scan.
    """
    for name, year in (years or {}).items():
        df = df.where(in_year(df, name, year))
    for name, wanted in (where or {}).items():
        df = df.where(F.col(name) == F.lit(wanted))
    df = df.select(*columns).withColumnsRenamed(dict(columns))
    return df.na.drop(subset=list(required)) if required else df


def copied(df: DataFrame, source: str, target: str) -> DataFrame:
    """The same column under a second name; nothing happens where it is absent."""
    return df.withColumn(target, F.col(source)) if source in df.columns else df


def only_codes(df: DataFrame, column: str, codes) -> DataFrame:
    """Rows whose code is listed; ``codes`` is a list or a one-column table."""
    if isinstance(codes, DataFrame):
        wanted = codes.select(F.col(codes.columns[0]).alias(column)).distinct()
        return df.join(wanted, column, "left_semi")
    return df.where(F.col(column).isin(*codes))


def column_as_value(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """One column of a wide table, for instance a year, as the value column."""
    return df.select(*keys, F.col(column).alias(name))


def wide_to_long(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    """Wide columns, for instance years, as rows."""
    return df.unpivot(list(keys), list(columns), name, value)


def complete_pairs(df: DataFrame, x: str, y: str, keep: Sequence[str] = ()) -> DataFrame:
    """The two columns where both are present."""
    return df.select(*keep, x, y).na.drop(subset=[x, y])


def wide_means(df: DataFrame, key: str, name: str, value: str, names: Sequence) -> DataFrame:
    """Long to wide with the mean of every cell; keys without any value are left out.

    A name outside ``names`` stops the job with an error rather than vanish.
    """
    from tallywick.operators.grouping import listed_only

    texts = [str(n) for n in names]
    checked = df.withColumn(name, listed_only(F.col(name), texts, name))
    wide = checked.groupBy(key).pivot(name, texts).agg(F.avg(value))
    return wide.na.drop("all", subset=[str(n) for n in names])


def with_row_mean(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Mean across columns over the values present, NULL where none is."""
    return df.withColumn(target, row_mean([F.col(c) for c in columns]))


def group_means(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """Mean of many columns per group, with the group size."""
    means = [F.avg(c).alias(c) for c in columns]
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), *means)


def distinct_groups(df: DataFrame, column: str) -> DataFrame:
    """The groups that occur, sorted."""
    return df.select(column).na.drop().distinct().orderBy(column)


def first_rows(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """The first rows in a given order, for display."""
    return df.orderBy(*order).limit(n)


def stacked_parts(parts: Mapping[str, DataFrame], tag: str) -> DataFrame:
    """Tables of one shape below each other, each tagged with its name."""
    tagged = [part.withColumn(tag, F.lit(name)) for name, part in parts.items()]
    result = tagged[0]
    for part in tagged[1:]:
        result = result.unionByName(part)
    return result


def listed(spark: SparkSession, columns: Sequence[str], rows: Sequence[Sequence]) -> DataFrame:
    """A few given rows as a table, for results that must have one row per request."""
    structs = [F.struct(*[F.lit(v).alias(c) for c, v in zip(columns, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
