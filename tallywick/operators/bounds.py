"""Broadcasts only where a bound on the side's size is known."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def broadcast_if(df: DataFrame, small: bool) -> DataFrame:
    """Broadcast a side whose bound the caller has proven, else leave the choice to the planner.

    Adaptive execution still turns a join into a broadcast when the measured
    size of a side is below ``spark.sql.adaptive.autoBroadcastJoinThreshold``.
    """
    return F.broadcast(df) if small else df
