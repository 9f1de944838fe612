"""Joins of several tables on a key.

No join carries a broadcast hint: Spark broadcasts a side when its size is known
to be below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, and
adaptive execution splits the partitions of hot keys in inner and left joins.  It
does not split those of full outer joins; :func:`full_chain` salts them itself.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywick.functions.values import clean_name


def unique_names(parts: Mapping[str, DataFrame], key: str) -> dict[str, DataFrame]:
    """Adds the part's name to every column that occurs in several parts."""
    seen = [c for part in parts.values() for c in part.columns if c != key]
    clash = {c for c in seen if seen.count(c) > 1}
    return {
        name: part.withColumnsRenamed({c: f"{c}_{name}" for c in part.columns if c in clash})
        for name, part in parts.items()
    }


def joined(left: DataFrame, right: DataFrame, key: str, how: str = "inner", null_safe: bool = False) -> DataFrame:
    """Equi-join on one key that both sides carry.

    Missing keys match nothing; with ``null_safe`` they match each other.  In an
    inner or left null-safe join the rows without a key are spread over
    ``NULL_SALTS`` tasks (the right side's copied to each), not gathered in one.
    """
    if not null_safe:
        return left.join(right, key, how)
    other = right.withColumnRenamed(key, "_key")
    if how not in ("inner", "left", "left_outer", "leftouter"):
        both = left.join(other, F.col(key).eqNullSafe(F.col("_key")), how)
        return both.withColumn(key, F.coalesce(key, "_key")).drop("_key")
    # present keys join as usual; the NULL keys, which would all meet in one task,
    # are dealt over NULL_SALTS salts on the left and copied to every salt on the right
    present = left.where(F.col(key).isNotNull()).join(other.where(F.col("_key").isNotNull()), F.col(key) == F.col("_key"), how)
    dealt = left.where(F.col(key).isNull()).withColumn("_salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(NULL_SALTS)))
    copied = other.where(F.col("_key").isNull()).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(NULL_SALTS - 1))))
    missing = dealt.join(copied, "_salt", how).drop("_salt")
    both = present.unionByName(missing)
    return both.withColumn(key, F.coalesce(key, "_key")).drop("_key")


def chained(parts: Mapping[str, DataFrame], key: str, how: str = "inner", null_safe: bool = False) -> DataFrame:
    """All parts on one key, with colliding column names told apart beforehand.

    Without ``null_safe`` rows with a missing key are removed from every part
    first, so that an outer chain has no row without a key.
    """
    named = unique_names(parts, key)
    tables = [part if null_safe else part.na.drop(subset=[key]) for part in named.values()]
    return reduce(lambda a, b: joined(a, b, key, how, null_safe), tables)


#: salts over which the rows without a key are dealt in a null-safe inner or left join
NULL_SALTS = 64
#: rows of one key's most repeated part that one task joins at most (salted beyond)
ROWS_PER_TASK = 100_000


def _tagged(tables: Mapping[str, DataFrame], key: str) -> dict[str, DataFrame]:
    """Each part as ``(key, <part>)``: its other columns packed in one struct named after it."""
    return {name: t.select(key, F.struct(*[c for c in t.columns if c != key]).alias(name)) for name, t in tables.items()}


def salted_parts(tables: Mapping[str, DataFrame], key: str, rows_per_task: int = ROWS_PER_TASK) -> tuple[dict[str, DataFrame], DataFrame]:
    """Rows of keys repeated in some part, with a ``salt``: the most repeated part of a key is dealt over
    ``ceil(most / rows_per_task)`` salts, the other parts' rows of that key are copied to each of them."""
    counts = reduce(
        lambda a, b: a.unionByName(b),
        [t.groupBy(key).agg(F.count(F.lit(1)).alias("m"), F.lit(name).alias("part")) for name, t in tables.items()],
    )
    repeated = (
        counts.groupBy(key)
        .agg(F.max_by("part", F.struct("m", "part")).alias("spread"), F.max("m").alias("most"))
        .where(F.col("most") > 1)
        .select(key, "spread", F.ceil(F.col("most") / rows_per_task).cast("int").alias("salts"))
    )
    out = {}
    for name, t in tables.items():
        keyed = t.join(repeated, key)
        dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("salts")).cast("int")
        out[name] = keyed.select(
            *t.columns, F.when(F.col("spread") == name, F.array(dealt)).otherwise(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salts")
        ).select(*t.columns, F.explode("salts").alias("salt"))
    return out, repeated.select(key)


def full_chain(parts: Mapping[str, DataFrame], key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The full outer join of all parts on one key, with hot keys split over tasks.

    Rows without a key are left out, colliding names told apart (as in
    :func:`chained`).  Keys found at most once in every part, nearly all of
    them, take one shuffle: the parts are stacked and each key's row is picked
    per part.  Keys repeated in some part take the exact way, a full outer join
    on ``(key, salt)``: the most repeated part of the key is dealt over salts of
    at most ``rows_per_task`` rows, and the other parts' rows of the key are
    copied to every salt, so every pair of rows still meets exactly once.
    """
    named = unique_names(parts, key)
    tables = {name: part.na.drop(subset=[key]) for name, part in named.items()}
    salted, repeated = salted_parts(tables, key, rows_per_task)
    tagged = _tagged(tables, key)
    empty = {name: F.lit(None).cast(t.schema[name].dataType) for name, t in tagged.items()}
    stacked = reduce(
        lambda a, b: a.unionByName(b),
        [t.select(key, *[F.col(n) if n == name else empty[n].alias(n) for n in tagged]) for name, t in tagged.items()],
    )
    single = stacked.join(repeated, key, "left_anti").groupBy(key).agg(*[F.first(n, ignorenulls=True).alias(n) for n in tagged])
    columns = [F.col(f"{name}.{c}").alias(c) for name, t in tables.items() for c in t.columns if c != key]
    many = reduce(lambda a, b: a.join(b, [key, "salt"], "full"), [_tagged_salted(t, key, name) for name, t in salted.items()])
    return single.select(key, *columns).unionByName(many.select(key, *columns))


def _tagged_salted(t: DataFrame, key: str, name: str) -> DataFrame:
    return t.select(key, "salt", F.struct(*[c for c in t.columns if c not in (key, "salt")]).alias(name))


def wide_from_parts(parts: Mapping[str, DataFrame], key: str, value: str) -> DataFrame:
    """Full outer join of ``(key, value)`` parts with one row per key, in one shuffle.

    The parts are stacked and pivoted; where a part repeats a key its mean is
    taken, so a hot key is combined before the shuffle.
    """
    tagged = [
        part.na.drop(subset=[key]).select(key, F.lit(name).alias("part"), F.col(value).alias("value"))
        for name, part in parts.items()
    ]
    stack = reduce(lambda a, b: a.unionByName(b), tagged)
    return stack.groupBy(key).pivot("part", list(parts)).agg(F.avg("value"))


def compared(left: DataFrame, right: DataFrame, key: str, suffixes: tuple[str, str]) -> DataFrame:
    """Two tables of one shape side by side, their values suffixed."""
    sides = []
    for table, suffix in zip((left, right), suffixes):
        sides.append(table.withColumnsRenamed({c: c + suffix for c in table.columns if c != key}))
    return sides[0].join(sides[1], key)


def _lookup(lookup: DataFrame, name: str, code: str) -> DataFrame:
    """One code per cleaned name, the smallest where a name has several."""
    cleaned = lookup.select(clean_name(F.col(name)).alias("_name"), F.col(code).alias(code))
    return cleaned.where(F.col("_name").isNotNull()).groupBy("_name").agg(F.min(code).alias(code))


def resolved(df: DataFrame, column: str, lookup: DataFrame, name: str, code: str) -> DataFrame:
    """Adds the code of a name, NULL where the lookup does not know it."""
    keyed = df.withColumn("_name", clean_name(F.col(column)))
    return keyed.join(_lookup(lookup, name, code), "_name", "left").drop("_name")


def unresolved(df: DataFrame, column: str, lookup: DataFrame, name: str, code: str) -> DataFrame:
    """Names the lookup does not know, with their number of rows.

    Names are counted before the join, so that a frequent name is one row.
    """
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    keyed = counts.withColumn("_name", clean_name(F.col(column)))
    return keyed.join(_lookup(lookup, name, code), "_name", "left_anti").drop("_name")


def with_attached(df: DataFrame, computed: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Computed columns brought to their rows by key, never by position."""
    return df.join(computed.select(key, *columns), key, "left")
