"""Small column expressions: safe casts, guards, keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(col: Column) -> Column:
    """The value as a double, with NaN and both infinities turned into NULL."""
    x = col.cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x)


def not_nan(col: Column) -> Column:
    """The value as a double, with NaN turned into NULL (infinities stay)."""
    x = col.cast("double")
    return F.when(F.isnan(x), None).otherwise(x)


def to_integer(col: Column) -> Column:
    """Nullable integer: what is no number becomes NULL, fractions round down.

    Whole numbers are read directly, so that long keys keep all their digits.
    """
    number = to_float(col)
    rounded = F.when(F.abs(number) < 9.0e18, F.floor(number))
    return F.coalesce(col.cast("string").try_cast("bigint"), rounded)


def to_float(col: Column) -> Column:
    """Nullable float: text that is no number becomes NULL."""
    return finite(col.try_cast("double"))


def clean_name(col: Column) -> Column:
    """Lookup form of a name: trimmed, lower case, inner blanks squeezed to one."""
    return F.regexp_replace(F.lower(F.trim(col)), r"\s+", " ")


def slug(col: Column) -> Column:
    """A name as a plain identifier: lower case, runs of other characters as one underscore."""
    return F.regexp_replace(F.lower(F.trim(col)), "[^a-z0-9]+", "_")


def labelled(col: Column, labels: Mapping) -> Column:
    """Label of a code; a code without label gives NULL."""
    pairs = [F.lit(part) for pair in labels.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), col)


def banded(col: Column, edges: Sequence[float], names: Sequence[str], closed: str = "right") -> Column:
    """Name of the interval a value falls in, NULL outside of all of them.

    ``closed="right"`` gives ``(a, b]`` with the lowest edge included;
    ``closed="left"`` gives ``[a, b)``.
    """
    if len(names) != len(edges) - 1:
        raise ValueError("one name per interval is needed")
    if closed not in ("right", "left"):
        raise ValueError("closed must be 'right' or 'left'")
    band = F.lit(None).cast("string")
    # built from the last interval backwards, so that the first test is the outermost
    for low, high, name in reversed(list(zip(edges[:-1], edges[1:], names))):
        if closed == "left":
            inside = (col >= low) & (col < high)
        elif low == edges[0]:
            inside = (col >= low) & (col <= high)
        else:
            inside = (col > low) & (col <= high)
        band = F.when(inside, F.lit(name)).otherwise(band)
    return band


def row_mean(cols: Sequence[Column]) -> Column:
    """Mean across columns of one row, over the values that are present."""
    total = sum((F.coalesce(c.cast("double"), F.lit(0.0)) for c in cols), F.lit(0.0))
    present = sum((c.isNotNull().cast("int") for c in cols), F.lit(0))
    return total / F.nullif(present, F.lit(0))


def key_hash(key: Column, buckets: int) -> Column:
    """Stable bucket of a key: the same on every engine and partitioning."""
    head = F.substring(F.md5(key.cast("string")), 1, 8)
    return (F.conv(head, 16, 10).cast("bigint") % buckets).cast("int")
