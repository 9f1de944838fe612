"""Session settings for running the library."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", memory: str = "12g", partitions: int = 8, name: str = "tallywick") -> SparkSession:
    """A local session for tests and measurements.

    On a cluster use its own session: the library only needs adaptive execution,
    which is on by default, and the UTC time zone.
    """
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
