"""Tests and correlations against known values and on degenerate tables."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallywick.operators import association, testing


def counted(spark, cells):
    """One row per observation from a crosstab given as {(a, b): n}."""
    rows = [(a, b) for (a, b), n in cells.items() for _ in range(n)]
    return spark.createDataFrame(rows, "a string, b string")


def test_chi_square_of_a_two_by_two_table(spark):
    rows = counted(spark, {("x", "u"): 10, ("x", "v"): 20, ("y", "u"): 30, ("y", "v"): 40})
    # n (ad - bc)^2 / (product of the margins), with and without Yates
    plain, corrected = 100 * 200**2 / (30 * 70 * 40 * 60), 100 * (200 - 50) ** 2 / (30 * 70 * 40 * 60)
    found = testing.chi_square(rows, [("a", "b")], correction=False).first()
    assert found["statistic"] == pytest.approx(plain)
    assert found["cramers_v"] == pytest.approx(math.sqrt(plain / 100))
    assert (found["dof"], found["n"], found["min_expected"]) == (1, 100, 12.0)
    assert found["p"] == pytest.approx(math.erfc(math.sqrt(plain / 2)))
    found = testing.chi_square(rows, [("a", "b")]).first()
    assert found["statistic"] == pytest.approx(corrected)
    assert found["p"] == pytest.approx(math.erfc(math.sqrt(corrected / 2)))


def test_yates_never_overshoots(spark):
    rows = counted(spark, {("x", "u"): 5, ("x", "v"): 5, ("y", "u"): 5, ("y", "v"): 5})
    assert testing.chi_square(rows, [("a", "b")]).first()["statistic"] == 0.0


@pytest.mark.parametrize("correction", [True, False])
def test_empty_cells_count(spark, correction):
    cells = {("x", "u"): 8, ("y", "v"): 3, ("z", "u"): 2, ("z", "v"): 4, ("z", "w"): 1}
    found = testing.chi_square(counted(spark, cells), [("a", "b")], correction).first()
    table = pd.Series(cells).unstack().fillna(0).to_numpy()
    expected = table.sum(1, keepdims=True) * table.sum(0) / table.sum()
    assert found["statistic"] == pytest.approx(((table - expected) ** 2 / expected).sum())
    assert (found["dof"], found["low_expected"]) == (4, True)
    assert found["min_expected"] == pytest.approx(expected.min())


def test_empty_cell_in_a_two_by_two_table(spark):
    rows = counted(spark, {("x", "u"): 6, ("y", "u"): 2, ("y", "v"): 7})
    found = testing.chi_square(rows, [("a", "b")]).first()
    table = np.array([[6.0, 0.0], [2.0, 7.0]])
    expected = table.sum(1, keepdims=True) * table.sum(0) / table.sum()
    assert found["statistic"] == pytest.approx(((abs(table - expected) - 0.5) ** 2 / expected).sum())


def test_one_column_or_no_rows_is_not_applicable(spark):
    rows = counted(spark, {("x", "u"): 3, ("y", "u"): 3}).withColumn("c", F.lit(None).cast("string"))
    found = {r["y"]: r for r in testing.chi_square(rows, [("a", "b"), ("a", "c")]).collect()}
    assert (found["b"]["n"], found["b"]["statistic"], found["b"]["p"], found["b"]["dof"]) == (6, None, None, None)
    assert (found["c"]["n"], found["c"]["statistic"]) == (0, None)


def means(spark, groups, pairs=("t", "v", "g")):
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    return testing.mean_tests(spark.createDataFrame(rows, "g string, v double"), [pairs]).first()


def test_welch(spark):
    a, b = [20.1, 22.4, 19.8, 24.0, 21.3], [17.2, 18.9, 16.1, 20.0]
    found = means(spark, {"a": a, "b": b})
    va, vb = np.var(a, ddof=1) / 5, np.var(b, ddof=1) / 4
    dof = (va + vb) ** 2 / (va**2 / 4 + vb**2 / 3)
    pooled = math.sqrt((4 * np.var(a, ddof=1) + 3 * np.var(b, ddof=1)) / 7)
    assert found["kind"] == "welch" and found["effect_name"] == "cohen_d"
    assert found["statistic"] == pytest.approx((np.mean(a) - np.mean(b)) / math.sqrt(va + vb))
    assert found["dof"] == pytest.approx(dof)
    assert found["effect"] == pytest.approx((np.mean(a) - np.mean(b)) / pooled)
    law = spark._jvm.org.apache.commons.math3.stat.inference.TTest()
    arrays = []
    for side in (a, b):
        array = spark.sparkContext._gateway.new_array(spark._jvm.double, len(side))
        for i, value in enumerate(side):
            array[i] = value
        arrays.append(array)
    assert found["p"] == pytest.approx(law.tTest(*arrays), rel=1e-9)


def test_anova(spark):
    groups = {
        "a": [6.0, 8.0, 4.0, 5.0, 3.0, 4.0],
        "b": [8.0, 12.0, 9.0, 11.0, 6.0, 8.0],
        "c": [13.0, 9.0, 11.0, 8.0, 7.0, 12.0],
    }
    found = means(spark, groups)
    assert (found["kind"], found["groups"], found["dof"], found["dof2"]) == ("anova", 3, 2.0, 15.0)
    assert found["statistic"] == pytest.approx(42 / (68 / 15))  # between 84 over 2, within 68 over 15
    assert found["effect"] == pytest.approx(84 / (84 + 68))
    assert found["p"] == pytest.approx(0.0024, abs=5e-5)


def test_degenerate_groups(spark):
    assert means(spark, {"a": [1.0, 2.0]})["kind"] == "none"
    single = means(spark, {"a": [1.0, 2.0], "b": [3.0]})
    assert (single["kind"], single["statistic"], single["p"]) == ("none", None, None)
    constant = means(spark, {"a": [1.0, 1.0], "b": [1.0, 1.0]})
    assert (constant["statistic"], constant["effect"]) == (None, 0.0)
    dirty = means(spark, {"a": [1.0, 2.0, math.nan, math.inf, None], "b": [3.0, 4.0, 6.0]})
    assert dirty["n"] == 5
    nothing = means(spark, {"a": [None], "b": [math.nan]})
    assert (nothing["kind"], nothing["n"], nothing["groups"]) == ("none", 0, 0)


def test_decisions_and_report(spark):
    rows = spark.createDataFrame([(0.01,), (0.05,), (0.2,), (None,), (math.nan,)], "p double")
    texts = [r["d"] for r in rows.select(testing.decision(F.col("p"), 0.05, "yes", "no", "n/a").alias("d")).collect()]
    assert texts == ["yes", "no", "no", "n/a", "n/a"]
    data = counted(spark, {("x", "u"): 3, ("y", "v"): 4}).withColumn("v", F.rand(1))
    report = testing.test_report(data, [("a", "b")], [("v by a", "v", "a")])
    assert report.columns == [*testing.RESULT_COLUMNS, "decision"]
    # smallest expected count: 3 * 3 / 7
    assert {r["kind"]: r["notes"] for r in report.collect()} == {"chi_square": ["low expected counts", "smallest expected count: 1.29"], "welch": []}
    alone = testing.test_report(data.where("a = 'x'"), means=[("v by a", "v", "a")]).first()
    assert alone["notes"] == ["fewer than two groups with data"]
    with pytest.raises(ValueError):
        testing.test_report(data)


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(4)
    frame = pd.DataFrame({"a": rng.normal(size=200).round(1)})
    frame["b"] = (frame["a"] + rng.normal(size=200)).round(1)
    frame["c"] = 2 * frame["a"] + 1
    frame["flat"] = 1.0
    frame.loc[frame.index % 11 == 0, "b"] = None
    return frame, spark.createDataFrame([tuple(None if pd.isna(v) else float(v) for v in r) for r in frame.values], "a double, b double, c double, flat double")


def test_correlations_equal_pandas(numbers):
    frame, rows = numbers
    pairs = [("a", "b"), ("a", "c"), ("a", "flat")]
    r = {x["y"]: x for x in association.pearson(rows, pairs).collect()}
    rho = {x["y"]: x for x in association.spearman(rows, pairs).collect()}
    assert r["b"]["r"] == pytest.approx(frame["a"].corr(frame["b"]))
    pair = frame[["a", "b"]].dropna().rank()  # average ranks; their Pearson r is Spearman's rho
    assert rho["b"]["rho"] == pytest.approx(pair["a"].corr(pair["b"]))
    assert r["b"]["n"] == rho["b"]["n"] == frame["b"].notna().sum()
    assert r["c"]["r"] == pytest.approx(1) and rho["c"]["rho"] == pytest.approx(1)
    assert r["c"]["p"] == pytest.approx(0, abs=1e-12)
    assert r["flat"]["r"] is None and rho["flat"]["rho"] is None and rho["flat"]["p"] is None


def test_two_rows_are_not_enough(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (2.0, 5.0), (3.0, None)], "a double, b double")
    assert association.pearson(rows, [("a", "b")]).first()["r"] is None
    assert association.spearman(rows, [("a", "b")]).first()["rho"] is None
    empty = association.spearman(rows.where("false"), [("a", "b")]).first()
    assert (empty["n"], empty["rho"], empty["p"]) == (0, None, None)


def test_matrix_is_symmetric(numbers):
    frame, rows = numbers
    cells = {(c["x"], c["y"]): c for c in association.correlation_matrix(rows, ["a", "b", "flat"]).collect()}
    assert len(cells) == 9 and cells["a", "a"]["r"] == pytest.approx(1)
    assert cells["a", "b"]["r"] == cells["b", "a"]["r"] and cells["flat", "flat"]["r"] is None
    lower = association.lower_triangle(association.correlation_matrix(rows, ["a", "b", "flat"])).collect()
    assert {(c["x"], c["y"]) for c in lower} == {("b", "a"), ("flat", "a"), ("flat", "b")}


def test_line_fit_equals_numpy(numbers):
    frame, rows = numbers
    pair = frame[["a", "b"]].dropna()
    fit = association.line_fits(rows, [("a", "b")]).first()
    slope, intercept = np.polyfit(pair["a"], pair["b"], 1)
    residuals = pair["b"] - (intercept + slope * pair["a"])
    assert (fit["slope"], fit["intercept"]) == pytest.approx((slope, intercept))
    assert fit["residual_std"] == pytest.approx(math.sqrt((residuals**2).sum() / (len(pair) - 2)))
    flat = association.line_fits(rows, [("flat", "b"), ("a", "flat")]).collect()
    assert (flat[0]["slope"], flat[0]["residual_std"], flat[1]["slope"]) == (None, None, 0.0)
    band = association.line_bands(association.line_fits(rows, [("a", "b")]), points=11).orderBy("point").collect()
    assert len(band) == 11 and band[0]["x_value"] == pair["a"].min()
    widths = [b["high"] - b["low"] for b in band]
    assert min(widths) < widths[0] and all(b["low"] < b["fit"] < b["high"] for b in band)
