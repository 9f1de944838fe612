"""Checks of a table's columns before a plan is built."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.types import NumericType


class ContractError(ValueError):
    """A table lacks columns that an operator needs."""


def require_columns(df: DataFrame, expected: Sequence[str], where: str = "table") -> DataFrame:
    """Returns the table unchanged, or raises with the names that are missing."""
    missing = [c for c in expected if c not in df.columns]
    if missing:
        raise ContractError(f"{where}: missing columns {missing}")
    return df


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType)]


def present_columns(df: DataFrame, wanted: Sequence[str], strict: bool = False) -> list[str]:
    """The wanted columns that exist; with ``strict`` all of them must."""
    if strict:
        require_columns(df, wanted)
    return [c for c in wanted if c in df.columns]
