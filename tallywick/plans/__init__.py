"""Registered queries over the given tables, each with its SQL twin where one exists."""

from tallywick.plans import (  # noqa: F401  (the imports register the queries)
    association,
    charts,
    cleaning,
    features,
    grouping,
    joining,
    models,
    profiling,
    shaping,
    testing,
)
from tallywick.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
