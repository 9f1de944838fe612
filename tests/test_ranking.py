"""Quantiles, modes and ranks against numpy and pandas."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallywick.functions.ordering import coarse_bucket, fine_bucket
from tallywick.operators import ranking
from tallywick.operators import charts, grouping, profiling

SHARES = {"low": 0.0, "q1": 0.25, "median": 0.5, "p90": 0.9, "high": 1.0}


def samples():
    rng = random.Random(3)
    yield "few", [3.0, 1.0, 2.0, 2.0]
    yield "one", [7.0]
    yield "constant", [5.0] * 40
    yield "signs", [-3.5, -0.0, 0.0, 2.25, -1e-300, 1e-300, 4.9e-324, -1e300, 1e300]
    yield "skewed", [1.0] * 400 + [rng.gauss(0, 1) for _ in range(600)]
    yield "scales", [rng.choice([-1, 1]) * 10 ** rng.uniform(-12, 12) for _ in range(500)]
    yield "close", [1.0 + i * 2**-52 for i in range(300)]


@pytest.mark.parametrize("name, values", list(samples()), ids=[n for n, _ in samples()])
def test_quantiles_equal_numpy(spark, name, values):
    rows = spark.createDataFrame([("a", v) for v in values], "g string, value double").repartition(5)
    found = ranking.quantiles(rows, ["g"], SHARES).first()
    for key, share in SHARES.items():
        assert found[key] == pytest.approx(np.quantile(values, share), rel=1e-13, abs=1e-320), key


def test_quantiles_by_group_with_gaps_and_infinities(spark):
    data = [(i % 3, float(i * i % 17)) for i in range(60)]
    data += [(0, None), (None, 1.0), (1, float("nan")), (2, math.inf), (2, -math.inf)]
    rows = spark.createDataFrame(data, "g int, value double")
    found = {r["g"]: r for r in ranking.quantiles(rows, ["g"], SHARES).collect()}
    assert set(found) == {0, 1, 2}
    frame = pd.DataFrame(data, columns=["g", "value"]).dropna()
    assert (found[2]["low"], found[2]["high"]) == (-math.inf, math.inf)  # numpy has NaN next to infinity
    for g, part in frame.groupby("g"):
        for key in ("q1", "median", "p90") if g == 2 else SHARES:
            assert found[g][key] == pytest.approx(part["value"].quantile(SHARES[key])), (g, key)


def test_weights_stand_for_repeats(spark):
    rows = spark.createDataFrame([("a", 1.0, 3), ("a", 4.0, 1), ("a", 2.0, 2)], "g string, value double, n int")
    found = ranking.quantiles(rows, ["g"], SHARES, weight="n").first()
    assert found["median"] == np.quantile([1, 1, 1, 2, 2, 4], 0.5)
    assert found["q1"] == np.quantile([1, 1, 1, 2, 2, 4], 0.25)


def test_many_groups(spark):
    rows = spark.range(4000).select((F.col("id") % 1000).alias("g"), F.col("id").cast("double").alias("value"))
    found = ranking.quantiles(rows, ["g"], {"median": 0.5}).orderBy("g").collect()
    assert len(found) == 1000 and found[5]["median"] == np.median([5, 1005, 2005, 3005])


def test_no_job_runs_while_plans_are_built(spark):
    """Quantile plans are lazy: building them starts no Spark job."""
    rows = spark.range(5000).select((F.col("id") % 7).alias("g"), (F.col("id") * 0.5).alias("value"), (F.col("id") % 11).alias("other"))
    context = spark.sparkContext
    context.setJobGroup("planning-only", "building plans")
    try:
        built = [
            ranking.quantiles(rows, ["g"], SHARES),
            profiling.numeric_summary(rows, ["value", "other"]),
            grouping.group_summary(rows, "g", "value", limits=True),
            grouping.group_summaries(rows, [("value", "g"), ("other", "g")]),
            charts.box_statistics(rows, ["g"]),
            charts.box_outliers(rows, ["g"]),
        ]
        assert context.statusTracker().getJobIdsForGroup("planning-only") == []
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    median = built[0].where("g = 3").first()["median"]
    assert median == pytest.approx(np.median([i * 0.5 for i in range(5000) if i % 7 == 3]))


def test_empty_input_gives_no_rows(spark):
    rows = spark.createDataFrame([], "g string, value double")
    assert ranking.quantiles(rows, ["g"], SHARES).collect() == []


def test_bucket_order_and_size(spark):
    rng = random.Random(5)
    values = sorted([rng.gauss(0, 1) * 10 ** rng.uniform(-300, 300) for _ in range(3000)] + [0.0, 1.0, 2.0, 4.0])
    rows = spark.createDataFrame([(v,) for v in values], "v double").select(
        "v", fine_bucket(F.col("v")).alias("fine")
    )
    found = rows.withColumn("coarse", coarse_bucket(F.col("fine"))).orderBy("v").collect()
    for a, b in zip(found, found[1:]):
        assert a["fine"] <= b["fine"] and a["coarse"] <= b["coarse"]


def test_mode_takes_the_smallest_on_ties(spark):
    rows = spark.createDataFrame([("a", v) for v in [3.0, 1.0, 3.0, 1.0, 2.0, None]], "g string, value double")
    counts = ranking.value_counts(rows, ["g"])
    assert ranking.smallest_mode(counts, ["g"]).first()["mode"] == 1.0


def test_average_ranks_equal_pandas(spark):
    rng = random.Random(9)
    values = [round(rng.gauss(0, 2), 1) for _ in range(400)] + [0.0] * 200
    rows = spark.createDataFrame([("a", v) for v in values], "g string, value double")
    ranks = ranking.average_ranks(ranking.value_counts(rows, ["g"]), ["g"]).collect()
    expected = dict(zip(values, pd.Series(values).rank()))
    assert {r["value"]: r["rank"] for r in ranks} == expected
    assert {r["total"] for r in ranks} == {len(values)}


def test_quick_quantiles_are_close(spark):
    rows = spark.range(10_001).select(F.lit("a").alias("g"), F.col("id").cast("double").alias("value"))
    found = ranking.quick_quantiles(rows, ["g"], SHARES).first()
    for key, share in SHARES.items():
        assert found[key] == pytest.approx(share * 10_000, abs=3)


def test_range_ranks_equal_pandas_across_ranges(spark):
    rng = random.Random(8)
    data = [(rng.choice("pq"), rng.choice([1.0] * 50 + [None] + [float(i) for i in range(200)])) for _ in range(3000)]
    rows = spark.createDataFrame(data, "g string, value double")
    counts = rows.groupBy("g", "value").agg(F.count(F.lit(1)).alias("n"))
    got = {(r["g"], r["value"]): (r["twice_rank"] / 2, r["total"]) for r in ranking.range_ranks(counts, ["g"], ["value"], parts=7).collect()}
    frame = pd.DataFrame(data, columns=["g", "value"])
    frame["key"] = frame["value"].fillna(-math.inf)
    frame["rank"] = frame.groupby("g")["key"].rank(method="average")
    expected = {(g, None if math.isinf(k) else k): (r, (frame["g"] == g).sum()) for g, k, r in frame[["g", "key", "rank"]].drop_duplicates().itertuples(index=False)}
    assert got == expected


def test_spearman_plan_shuffles_at_most_ten_times(spark):
    from tallywick.operators import association

    rows = spark.range(2000).select((F.col("id") % 37).alias("a"), (F.col("id") % 101).cast("double").alias("b"), (F.col("id") * 7 % 13).alias("c"))
    found = association.spearman(rows, [("a", "b"), ("b", "c")])
    found.collect()
    final = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    shuffles = [line for line in final.split("\n") if "Exchange " in line and "Broadcast" not in line and "Reused" not in line]
    assert 0 < len(shuffles) <= 10


def test_spearman_shuffles_numbers_only(spark):
    from tallywick.operators import association

    rows = spark.range(500).select((F.col("id") % 37).alias("a"), (F.col("id") % 101).cast("double").alias("b"))
    plan = association.spearman(rows, [("a", "b"), ("b", "a")])._jdf.queryExecution().executedPlan().toString()
    keys = [line.split("partitioning(")[1] for line in plan.split("\n") if "partitioning(" in line]
    assert keys and not any(name in key for key in keys for name in ("x#", "y#"))


def test_boxes_of_listed_columns_shuffle_no_row(spark):
    rows = spark.range(500).select((F.col("id") % 37).alias("a"), (F.col("id") % 101).cast("double").alias("b"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables of unknown size
    try:
        plan = charts.column_boxes(rows, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
        many = charts.box_statistics(rows, ["a"], "b")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    # groups whose number is not known keep the planner's choice
    assert "BroadcastHashJoin" not in many


def test_sums_before_equal_a_running_total_across_ranges(spark):
    rng = random.Random(4)
    data = [(rng.choice(["a", "b"]), i, float(rng.randint(0, 9))) for i in range(2000)] + [("c", 1, 2.5)]
    rows = spark.createDataFrame(data, "g string, o int, v double")
    got = {(r["g"], r["o"]): r["before"] for r in ranking.sums_before(rows, ["g"], ["o"], "v", parts=9).collect()}
    running = {}
    for g, o, v in sorted(data):
        assert got[(g, o)] == pytest.approx(running.get(g, 0.0))
        running[g] = running.get(g, 0.0) + v
