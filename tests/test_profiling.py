"""Profiles, charts and crosstabs on edge tables, and under repartitioning."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallywick.operators import charts, grouping, profiling
from tallywick.plans.profiling import NUMBERS
from tallywick.sources.files import table


def by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


@pytest.fixture(scope="module")
def edges(spark):
    data = [
        (1.0, 5.0, None, float("nan")),
        (2.0, 5.0, None, 1.0),
        (2.0, 5.0, None, float("inf")),
        (100.0, 5.0, None, None),
    ]
    return spark.createDataFrame(data, "varied double, same double, none double, odd double")


def test_summary_of_edge_columns(edges):
    found = by(profiling.numeric_summary(edges, edges.columns), "variable")
    varied, same, none, odd = (found[c] for c in edges.columns)
    reference = pd.Series([1.0, 2.0, 2.0, 100.0])
    assert varied["skewness"] == pytest.approx(reference.skew())
    assert (varied["mode"], varied["median"], varied["outliers"], varied["missing"]) == (2.0, 2.0, 1, 0)
    assert varied["variance"] == pytest.approx(reference.var())
    assert (same["iqr"], same["outliers"], same["skewness"], same["std"]) == (0.0, 0, 0.0, 0.0)
    assert (none["n"], none["missing"], none["mean"], none["median"], none["mode"], none["outliers"]) == (4, 4, None, None, None, 0)
    assert (odd["n"], odd["missing"], odd["max"]) == (4, 2, math.inf)


def test_summary_of_empty_and_single_rows(edges):
    empty = by(profiling.numeric_summary(edges.where("false"), ["varied"]), "variable")["varied"]
    assert (empty["n"], empty["missing"], empty["mean"], empty["outliers"]) == (0, 0, None, 0)
    single = by(profiling.numeric_summary(edges.limit(1), ["varied"]), "variable")["varied"]
    assert (single["n"], single["variance"], single["std"], single["skewness"], single["q1"]) == (1, 0.0, 0.0, None, 1.0)


def test_summary_does_not_depend_on_partitioning(spark, folder):
    lines = table(spark, folder, "lineitem")
    results = [by(profiling.numeric_summary(lines.repartition(n), NUMBERS), "variable") for n in (1, 7)]
    for name, row in results[0].items():
        other = results[1][name]
        assert other.pop("variable") == row.pop("variable")
        assert other == pytest.approx(row, rel=1e-9, abs=1e-12), name


def test_frequencies_add_up(spark):
    rows = spark.createDataFrame([("a", 1), ("a", None), (None, 2), ("b", 2)], "x string, y int")
    found = profiling.frequencies(rows, ["x", "y"])
    totals = by(found.groupBy("variable").agg(F.sum("n").alias("n"), F.sum("percent").alias("p")), "variable")
    assert all(t["n"] == 4 and t["p"] == pytest.approx(100) for t in totals.values())
    assert {(r["category"], r["n"]) for r in found.where("variable = 'x'").collect()} == {("a", 2), ("b", 1), (None, 1)}


def test_row_percent_with_missing_and_empty_rows(spark):
    cells = spark.createDataFrame([("a", "x", 1), ("a", "y", 3), (None, "x", 2), ("c", "x", 0)], "a string, b string, n int")
    found = {(r["a"], r["b"]): r["percent"] for r in grouping.row_percent(cells, "a").collect()}
    assert found == {("a", "x"): 25.0, ("a", "y"): 75.0, (None, "x"): 100.0, ("c", "x"): None}


def test_group_summary_of_single_rows(spark):
    rows = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", 4.0), (None, 9.0), ("c", None)], "g string, v double")
    found = by(grouping.group_summary(rows, "g", "v", limits=True, digits=2), "g")
    assert set(found) == {"a", "b"}
    assert found["a"] == {"g": "a", "n": 1, "mean": 1.0, "median": 1.0, "std": 0.0, "min": 1.0, "max": 1.0}
    assert found["b"]["std"] == 1.41 and found["b"]["median"] == 3.0


def test_histogram_equals_numpy(spark):
    values = [float(v) for v in np.random.default_rng(1).normal(size=500)] + [3.5, 3.5]
    rows = spark.createDataFrame([(v, 2.0, None) for v in values], "v double, flat double, none double")
    found = charts.histogram(rows, ["v", "flat", "none"], bins=20)
    counts = [r["n"] for r in found.where("variable = 'v'").orderBy("bin").collect()]
    assert counts == list(np.histogram(values, bins=20)[0])
    flat = [r["n"] for r in found.where("variable = 'flat'").orderBy("bin").collect()]
    assert flat == list(np.histogram([2.0] * len(values), bins=20)[0])
    assert found.where("variable = 'none'").count() == 0


def test_boxes(spark):
    rows = spark.createDataFrame([("a", v) for v in [1.0, 2.0, 3.0, 4.0, 50.0]] + [("b", 1.0)], "g string, value double")
    found = by(charts.box_statistics(rows, ["g"]), "g")
    assert found["a"] == {
        "g": "a", "n": 5, "q1": 2.0, "median": 3.0, "q3": 4.0, "low_whisker": 1.0, "high_whisker": 4.0, "outliers": 1
    }
    assert found["b"]["high_whisker"] == 1.0
    assert [tuple(r) for r in charts.box_outliers(rows, ["g"]).collect()] == [("a", 50.0, 1)]


def test_density_equals_the_direct_sum_and_integrates_to_one(spark):
    values = np.concatenate([np.random.default_rng(2).normal(size=300), [9.0]])
    rows = spark.createDataFrame([(float(v), 1.0) for v in values], "v double, flat double")
    found = charts.density(rows, ["v", "flat"], points=400).orderBy("point").collect()
    assert {r["variable"] for r in found} == {"v"}
    grid, heights = np.array([r["x_value"] for r in found]), np.array([r["density"] for r in found])
    h = values.std(ddof=1) * len(values) ** -0.2
    direct = np.exp(-0.5 * ((grid[:, None] - values) / h) ** 2).sum(axis=1) / (len(values) * h * math.sqrt(2 * math.pi))
    assert heights == pytest.approx(direct, abs=1e-12)
    assert np.trapezoid(heights, grid) == pytest.approx(1, abs=1e-3)


def test_scatter_bins_keep_every_point(spark):
    rows = spark.createDataFrame([(float(i % 10), float(i % 7)) for i in range(100)] + [(None, 1.0)], "a double, b double")
    found = charts.scatter_bins(rows, "a", "b", bins=5)
    assert found.agg(F.sum("n")).first()[0] == 100
    assert found.agg(F.max("x_bin")).first()[0] == 4


def test_stacked_bars_end_at_hundred(spark, folder):
    bars = charts.stacked_bars(table(spark, folder, "lineitem"), "l_returnflag", "l_linenumber")
    tops = bars.groupBy("l_returnflag").agg(F.max(F.col("base") + F.col("height")).alias("top")).collect()
    assert [r["top"] for r in tops] == pytest.approx([100.0] * 3)


def test_density_of_wide_and_tied_values_equals_the_direct_sum(spark):
    """Far outliers, many ties and a small bandwidth: bins and moments still give every kernel."""
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(size=2000) * 0.01, np.full(500, 0.003), [40.0, -25.0], rng.uniform(-3, 3, 300)])
    rows = spark.createDataFrame([(float(v),) for v in values], "v double")
    found = charts.density(rows, ["v"], points=1000).orderBy("point").collect()
    grid, heights = np.array([r["x_value"] for r in found]), np.array([r["density"] for r in found])
    h = values.std(ddof=1) * len(values) ** -0.2
    direct = np.exp(-0.5 * ((grid[:, None] - values) / h) ** 2).sum(axis=1) / (len(values) * h * math.sqrt(2 * math.pi))
    assert heights == pytest.approx(direct, rel=1e-9, abs=1e-9 * direct.max())
