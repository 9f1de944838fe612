"""Order-preserving buckets of a number.

``fine_bucket`` never decreases when the value grows, and its width is a
fixed share (about 1e-8) of the value.  ``coarse_bucket`` groups 2**20 fine
buckets.  A column of doubles therefore has at most about 270,000 coarse
buckets, each with at most 2**20 fine ones, whatever its distribution: sorting
bucket totals instead of rows keeps every window small.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_STEPS_PER_DOUBLING = 2.0**26
_FINE_BITS = 20
# larger than |log2| of any double, so that the magnitude is never negative
_SHIFT = 1100 * 2**26


def fine_bucket(value: Column) -> Column:
    steps = F.least(F.log2(F.abs(value)) * F.lit(_STEPS_PER_DOUBLING), F.lit(1.0e17))
    size = F.floor(steps) + F.lit(_SHIFT)
    zero = F.lit(0).cast("bigint")
    # the outer coalesce makes the bucket non-nullable, which keeps null checks on
    # it out of the joins below and lets Spark reuse one shuffle for all of them
    return F.coalesce(F.when(value > 0, size).when(value < 0, -size), zero)


def coarse_bucket(fine: Column) -> Column:
    return F.coalesce(F.shiftright(fine, _FINE_BITS), F.lit(0).cast("bigint"))
