"""Tabular cleaning, profiling, testing and modelling as Spark jobs."""
