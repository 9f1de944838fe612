"""Tail probabilities against printed tables and a second implementation."""

import math

import pytest
from pyspark.sql import functions as F

from tallywick.functions.tails import chi2_upper, correlation_p, f_upper, t_two_sided


def one(spark, expression):
    return spark.range(1).select(expression.alias("p")).first()["p"]


@pytest.mark.parametrize(
    "t, dof, p",
    [(12.706, 1, 0.05), (2.228, 10, 0.05), (2.042, 30, 0.05), (1.960, 10_000_000, 0.05), (2.750, 30, 0.01)],
)
def test_t_table(spark, t, dof, p):
    # half a unit of the third decimal of t moves p by at most 1e-4
    assert one(spark, t_two_sided(f"{t}D", f"{dof}D")) == pytest.approx(p, abs=1e-4)


@pytest.mark.parametrize("x, dof, p", [(3.841, 1, 0.05), (5.991, 2, 0.05), (18.307, 10, 0.05), (124.342, 100, 0.05)])
def test_chi_square_table(spark, x, dof, p):
    assert one(spark, chi2_upper(f"{x}D", f"{dof}D")) == pytest.approx(p, abs=2e-5)


@pytest.mark.parametrize("f, d1, d2, p", [(4.10, 2, 10, 0.05), (3.49, 3, 12, 0.05), (5.95, 3, 12, 0.01)])
def test_f_table(spark, f, d1, d2, p):
    assert one(spark, f_upper(f"{f}D", f"{d1}D", f"{d2}D")) == pytest.approx(p, abs=1e-4)


def test_closed_forms(spark):
    # chi-square with 2 dof is exponential, t with 1 dof is Cauchy
    assert one(spark, chi2_upper("7D", "2D")) == pytest.approx(math.exp(-3.5), rel=1e-12)
    assert one(spark, t_two_sided("3D", "1D")) == pytest.approx(1 - 2 * math.atan(3) / math.pi, rel=1e-12)


@pytest.mark.parametrize("dof", [3.0, 57.0, 1_000.0, 19_000.0, 60_000.0, 1e7])
def test_against_the_jvm_library(spark, dof):
    laws = spark._jvm.org.apache.commons.math3.distribution
    for t in (0.3, 1.7, 4.0):
        expected = 2 * laws.TDistribution(dof).cumulativeProbability(-t)
        assert one(spark, t_two_sided(f"{t}D", f"{dof}D")) == pytest.approx(expected, rel=1e-7)


def test_large_tables_reach_the_normal_law(spark):
    expected = math.erfc(2.5 / math.sqrt(2))
    assert one(spark, t_two_sided("2.5D", "1E12D")) == pytest.approx(expected, rel=1e-9)
    assert one(spark, correlation_p("2.5D / 1E6D", "1E12D")) == pytest.approx(expected, rel=1e-9)


def test_undefined_stays_undefined(spark):
    assert one(spark, t_two_sided("cast(NULL as double)", "4D")) is None
    assert one(spark, chi2_upper("1D", "0D")) is None
    assert one(spark, correlation_p("0.5D", "2D")) is None
    assert one(spark, correlation_p("1D", "5D")) == 0.0
    assert one(spark, t_two_sided("0D", "4D")) == 1.0


def test_runs_on_columns(spark):
    rows = spark.createDataFrame([(2.0, 10.0), (0.5, 4.0)], "t double, dof double")
    p = [r["p"] for r in rows.select(t_two_sided("t", "dof").alias("p")).orderBy(F.col("p")).collect()]
    assert p == pytest.approx([0.07338803, 0.64333], abs=1e-4)


@pytest.mark.parametrize("dof", [1e6, 4e9, 4e10, 1e12])
def test_chi_square_at_large_dof(spark, dof):
    # at its mean the law is skewed by this much
    expected = 0.5 - (2 / 3) / math.sqrt(4 * math.pi * dof)
    assert one(spark, chi2_upper(f"{dof!r}D", f"{dof!r}D")) == pytest.approx(expected, abs=1e-8)


@pytest.mark.parametrize("z", [-3.0, -1.0, 0.0, 1.0, 3.0, 6.0])
def test_chi_square_on_both_sides_of_the_expansion(spark, z):
    below, above = (one(spark, chi2_upper(f"{d + z * math.sqrt(2 * d)!r}D", f"{d!r}D")) for d in (199_998.0, 200_002.0))
    assert below == pytest.approx(above, abs=2e-8)


@pytest.mark.parametrize("d1, d2", [(1e7, 1e11), (1e6, 1e12), (1e9, 1e9)])
def test_f_one_deviation_above_the_mean_at_huge_dof(spark, d1, d2):
    """F nears the normal law; at one deviation its first correction (skewness) vanishes."""
    import math

    mean = d2 / (d2 - 2)
    sd = math.sqrt(2 * d2 * d2 * (d1 + d2 - 2) / (d1 * (d2 - 2) ** 2 * (d2 - 4)))
    row = spark.range(1).select(f_upper(f"{mean + sd!r}D", f"{d1!r}D", f"{d2!r}D").alias("p")).first()
    assert row["p"] == pytest.approx(0.5 * math.erfc(1 / math.sqrt(2)), abs=2e-6)



@pytest.mark.parametrize("d1, d2, f", [(2e5, 3e5, 1.003), (120.0, 130.0, 1.1), (100.0, 4000.0, 0.8), (3000.0, 200.0, 1.3)])
def test_both_front_factors_agree_where_both_hold(spark, monkeypatch, d1, d2, f):
    """Up to a few 1e5 degrees of freedom the log-gamma form is accurate too; both must agree."""
    from tallywick.functions import tails

    def p():
        return spark.range(1).select(tails.f_upper(f"{f!r}D", f"{d1!r}D", f"{d2!r}D").alias("p")).first()["p"]

    stable = p()
    monkeypatch.setattr(tails, "_STIRLING_FROM", "1E300D")
    assert stable == pytest.approx(p(), rel=1e-9, abs=1e-15)
