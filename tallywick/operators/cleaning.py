"""Rule-driven cleaning.

Rules are plain dictionaries given by the caller and compile to column
expressions; a whole chain stays one plan without a shuffle, except for the
removal of duplicates.  Three kinds of rule::

    {"name": ..., "column": "q", "min": 1, "max": 45, "action": "drop"}
    {"name": ..., "column": "s", "allowed": ["A", "B"], "action": "null"}
    {"name": ..., "any": [[{"column": "a", "equals": 0}, {"column": "b", "differs": 1}]],
     "action": "drop"}

A missing value breaks no rule; with ``"nulls": "drop"`` it breaks the rule of
its column.  ``any`` is a list of conjunctions.  ``"action": "null"`` clears
the rule's column, or the columns listed under ``clear``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallywick.functions.values import to_float, to_integer

Columns = Mapping[str, Column]


def without_header_rows(df: DataFrame) -> DataFrame:
    """Removes rows that repeat the column names, wherever they are."""
    repeats = [F.col(c).cast("string").eqNullSafe(F.lit(c)) for c in df.columns]
    return df.where(~reduce(lambda a, b: a & b, repeats))


def without_duplicates(df: DataFrame) -> DataFrame:
    """One of every set of equal rows; NULLs count as equal."""
    return df.dropDuplicates()


def typed(df: DataFrame, integers: Sequence[str] = (), floats: Sequence[str] = ()) -> DataFrame:
    """Nullable integers and floats; what cannot be read becomes NULL."""
    changed = {c: to_integer(F.col(c)) for c in integers if c in df.columns}
    changed |= {c: to_float(F.col(c)) for c in floats if c in df.columns}
    return df.withColumns(changed) if changed else df


def rest_as_text(df: DataFrame, leave: Sequence[str] = ()) -> DataFrame:
    """Every column that is neither numeric, text nor listed becomes text."""
    simple = ("string", "tinyint", "smallint", "int", "bigint", "float", "double", "boolean")
    odd = [
        f.name
        for f in df.schema
        if f.name not in leave
        and f.dataType.simpleString() not in simple
        and not f.dataType.simpleString().startswith("decimal")
        and not isinstance(f.dataType, StringType)
    ]
    return df.withColumns({c: F.col(c).cast("string") for c in odd}) if odd else df


def _condition(cond: Mapping, columns: Columns) -> Column:
    if cond["column"] not in columns:
        return F.lit(False)
    col = columns[cond["column"]]
    return col == F.lit(cond["equals"]) if "equals" in cond else col != F.lit(cond["differs"])


def violation(rule: Mapping, columns: Columns) -> Column:
    """True where a row breaks the rule, never NULL."""
    if "any" in rule:
        every = [reduce(lambda a, b: a & b, [_condition(c, columns) for c in conj]) for conj in rule["any"]]
        return F.coalesce(reduce(lambda a, b: a | b, every), F.lit(False))
    if rule["column"] not in columns:
        return F.lit(False)
    col = columns[rule["column"]]
    broken = F.lit(False)
    if rule.get("min") is not None:
        broken = broken | (col < F.lit(rule["min"]))
    if rule.get("max") is not None:
        broken = broken | (col > F.lit(rule["max"]))
    if rule.get("allowed") is not None:
        broken = broken | ~col.isin(*rule["allowed"])
    return F.coalesce(broken, F.lit(rule.get("nulls", "keep") == "drop"))


def _cleared(rule: Mapping) -> Sequence[str]:
    return rule.get("clear") or [rule["column"]]


def _named(df: DataFrame) -> dict[str, Column]:
    return {c: F.col(c) for c in df.columns}


def apply_rules(df: DataFrame, rules: Sequence[Mapping]) -> DataFrame:
    """Rows and values that survive the rules, applied in the order given."""
    for rule in rules:
        broken = violation(rule, _named(df))
        if rule["action"] == "drop":
            df = df.where(~broken)
        elif rule["action"] == "null":
            df = df.withColumns({c: F.when(~broken, F.col(c)) for c in _cleared(rule) if c in df.columns})
        else:
            raise ValueError(f"unknown action {rule['action']!r}")
    return df


def attrition(df: DataFrame, rules: Sequence[Mapping]) -> DataFrame:
    """How many rows every rule hits, from one scan.

    ``alone`` counts on the untouched table; ``in_order`` counts what is left
    for the rule after the rules before it.
    """
    original = _named(df)
    current = dict(original)
    alive = F.lit(True)
    rows = []
    for rule in rules:
        broken = violation(rule, current)
        rows.append(
            F.struct(
                F.lit(rule["name"]).alias("rule"),
                F.lit(rule["action"]).alias("action"),
                F.count_if(violation(rule, original)).alias("alone"),
                F.count_if(alive & broken).alias("in_order"),
            )
        )
        if rule["action"] == "drop":
            alive = alive & ~broken
        else:
            current |= {c: F.when(~broken, current[c]) for c in _cleared(rule) if c in current}
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def without_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which all the given columns are present."""
    return df.na.drop(subset=list(columns))


def cleaned(df: DataFrame, steps: Sequence[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """A chain of steps in the caller's order, as one plan."""
    return reduce(lambda table, step: table.transform(step), steps, df)
