"""Joins, reshaping, files and run facts."""

import gzip
import json
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tallywick.operators import joining, shaping
from tallywick.operators.runs import as_json, from_json_rows, run_facts
from tallywick.operators.testing import mean_tests
from tallywick.sources import files

SCHEMA = StructType([StructField("id", LongType()), StructField("name", StringType()), StructField("score", DoubleType())])


@pytest.fixture
def scratch():
    return Path(tempfile.mkdtemp(prefix="run-", dir="/tmp"))


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_missing_keys_match_only_when_asked(spark):
    a = spark.createDataFrame([(1, "a"), (None, "n")], "k int, x string")
    b = spark.createDataFrame([(1, "b"), (None, "m"), (2, "c")], "k int, y string")
    assert rows(joining.chained({"a": a, "b": b}, "k")) == [(1, "a", "b")]
    safe = joining.chained({"a": a, "b": b}, "k", null_safe=True).select("k", "x", "y")
    assert rows(safe) == [(1, "a", "b"), (None, "n", "m")]
    full = joining.chained({"a": a, "b": b}, "k", how="full")
    assert rows(full) == [(1, "a", "b"), (2, None, "c")]


def test_names_are_told_apart_before_the_join(spark):
    parts = {name: spark.createDataFrame([(1, i)], "k int, v int") for i, name in enumerate(["p", "q", "r"])}
    joined = joining.chained(parts, "k")
    assert joined.columns == ["k", "v_p", "v_q", "v_r"] and rows(joined) == [(1, 0, 1, 2)]


def test_outer_chain_and_pivot_agree(spark):
    parts = {
        "p": spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, value double"),
        "q": spark.createDataFrame([(2, 5.0), (3, 6.0)], "k int, value double"),
        "r": spark.createDataFrame([(3, 7.0), (None, 8.0)], "k int, value double"),
    }
    wide = joining.wide_from_parts(parts, "k", "value")
    chain = joining.chained({n: p.withColumnRenamed("value", n) for n, p in parts.items()}, "k", how="full")
    assert rows(wide) == rows(chain) == [(1, 1.0, None, None), (2, 2.0, 5.0, None), (3, None, 6.0, 7.0)]


def test_name_lookup(spark):
    lookup = spark.createDataFrame([("Peru", "PER"), ("New  Zealand", "NZL"), ("peru ", "XXX")], "name string, code string")
    names = spark.createDataFrame([(1, " PERU"), (2, "new zealand"), (3, "Nowhere"), (4, "Nowhere"), (5, None)], "i int, label string")
    found = joining.resolved(names, "label", lookup, "name", "code").select("i", "code")
    assert rows(found) == [(1, "PER"), (2, "NZL"), (3, None), (4, None), (5, None)]
    left = joining.unresolved(names, "label", lookup, "name", "code")
    assert rows(left) == [("Nowhere", 2), (None, 1)]


def test_values_follow_their_key(spark):
    data = spark.createDataFrame([(i, float(i)) for i in range(50)], "k int, v double")
    computed = data.repartition(7).withColumn("twice", F.col("v") * 2)
    back = joining.with_attached(data.repartition(3), computed, "k", ["twice"])
    assert back.where("twice = 2 * v").count() == 50


def test_pivot_leaves_out_keys_without_values(spark):
    long = spark.createDataFrame([(1, "a", 1.0), (1, "a", 3.0), (1, "b", None), (2, "a", None)], "k int, c string, v double")
    assert rows(shaping.wide_means(long, "k", "c", "v", ["a", "b"])) == [(1, 2.0, None)]


def test_standardised_reaches_the_scan(spark, folder):
    orders = files.table(spark, folder, "orders")
    found = shaping.standardised(orders, {"o_orderkey": "id"}, {"o_orderstatus": "F"}, ["id"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderstatus,F)" in plan and "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan
    assert found.columns == ["id"]


def test_year_filter_reaches_the_scan_as_a_range(spark, folder):
    from tallywick.plans import QUERIES

    found = QUERIES["standardised_source"](spark, folder)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01" in pushed and "LessThan(o_orderdate,1998-01-01" in pushed
    orders = files.table(spark, folder, "orders")
    expected = orders.where(F.year("o_orderdate") == 1997).count()
    assert shaping.standardised(orders, {"o_orderkey": "id"}, years={"o_orderdate": 1997}).count() == expected > 0
    stamps = orders.select(F.col("o_orderdate").cast("timestamp").alias("t"))
    assert stamps.where(shaping.in_year(stamps, "t", 1997)).count() == expected


def test_codes_from_list_and_table(spark):
    data = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    codes = spark.createDataFrame([("a",), ("a",), ("z",)], "code string")
    assert rows(shaping.only_codes(data, "c", ["a", "z"])) == rows(shaping.only_codes(data, "c", codes)) == [("a",)]


def test_delimited_text_without_header_and_with_null_tokens(spark, scratch):
    (scratch / "raw.csv").write_text("1,ann,2.5\n2,?,NA\n3,bob,NaN\n?,NA,1\n")
    read = files.read_delimited(spark, str(scratch / "raw.csv"), SCHEMA, header=False, null_tokens=["?", "NA", "NaN"])
    assert rows(read) == [(1, "ann", 2.5), (2, None, None), (3, "bob", None), (None, None, 1.0)]


def test_gzip_with_header(spark, scratch):
    with gzip.open(scratch / "raw.csv.gz", "wt") as out:
        out.write("id,name,score\n1,ann,2.5\n2,bob,x\n")
    read = files.read_delimited(spark, str(scratch / "raw.csv.gz"), SCHEMA, spread=4)
    assert rows(read) == [(1, "ann", 2.5), (2, "bob", None)]
    assert read.rdd.getNumPartitions() == 4


def test_written_text_comes_back(spark, scratch):
    data = spark.createDataFrame([(1, "ann", 2.5), (2, None, None)], SCHEMA)
    files.write_delimited(data, str(scratch / "out"))
    text = "".join(p.read_text() for p in (scratch / "out").glob("part-*"))
    assert "2,NA,NA" in text
    assert rows(files.read_delimited(spark, str(scratch / "out"), SCHEMA, null_tokens=["NA"])) == rows(data)


def test_landing_runs_once_unless_forced(spark, scratch):
    path = str(scratch / "landed")

    def produced(n):
        return lambda: spark.range(n)

    assert files.landed(spark, path, produced(3)).count() == 3
    assert files.landed(spark, path, produced(5)).count() == 3
    assert files.landed(spark, path, produced(5), refresh=True).count() == 5

    def gone():
        raise AssertionError("the source was read")

    assert files.landed(spark, path, gone).count() == 5
    empty = str(scratch / "landed_empty")
    assert files.landed(spark, empty, produced(0)).count() == 0
    assert files.landed(spark, empty, produced(2)).count() == 2


def test_tables_and_tagged_parts(spark, scratch):
    for name in ("x", "y"):
        files.write_table(spark.createDataFrame([(1, name)], "i int, s string"), str(scratch / name))
    both = files.read_parts(spark, {n: str(scratch / n) for n in ("x", "y")}, "part")
    assert rows(both) == [(1, "x", "x"), (1, "y", "y")]
    files.write_table(both, str(scratch / "split"), partitions=["part"])
    assert rows(spark.read.parquet(str(scratch / "split")).where("part = 'y'")) == [(1, "y", "y")]
    files.write_table(both, str(scratch / "text"), form="csv")
    assert spark.read.csv(str(scratch / "text"), header=True).count() == 2


def test_run_facts_and_results_as_json(spark, scratch):
    before = spark.createDataFrame([(1, "a"), (2, None), (3, None)], "i int, s string")
    facts = run_facts(before, before.where("i > 1"), ["summary.csv"], 0.05)
    files.write_json(facts, str(scratch / "facts"))
    stored = json.loads("".join(p.read_text() for p in (scratch / "facts").glob("part-*")))
    assert stored["before"] == {"rows": 3, "columns": 2}
    assert stored["after"] == {"rows": 2, "columns": 2, "missing": {"i": 0, "s": 2}}
    assert stored["outputs"] == ["summary.csv"] and stored["alpha"] == 0.05 and len(stored["run_at"]) == 19

    data = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 5.0), ("b", 7.0)], "g string, v double")
    results = mean_tests(data, [("v by g", "v", "g"), ("v by v", "v", "v")])
    files.write_json(results, str(scratch / "tests"))
    assert rows(spark.read.schema(results.schema).json(str(scratch / "tests"))) == rows(results)
    lines = as_json(results)
    assert all("dof2" in json.loads(r["json"]) for r in lines.collect())
    assert rows(from_json_rows(lines, "json", results.schema)) == rows(results)


def test_full_chain_equals_outer_joins_and_splits_a_hot_key(spark):
    from collections import Counter

    hot = [(0, float(i), "x") for i in range(5000)]
    a = spark.createDataFrame(hot + [(k, k * 1.0, "a") for k in range(1, 300)] + [(None, 1.0, "n")], "k int, v double, tag string")
    b = spark.createDataFrame([(0, "b0"), (0, "b1"), (0, "b2")] + [(k, f"b{k}") for k in range(200, 400)] + [(250, "again")], "k int, w string")
    c = spark.createDataFrame([(k, k, "c") for k in range(0, 500, 7)], "k int, v int, tag string")
    parts = {"a": a, "b": b, "c": c}
    got = Counter(tuple(r) for r in joining.full_chain(parts, "k", rows_per_task=700).collect())
    want = Counter(tuple(r) for r in joining.chained(parts, "k", how="full").collect())
    assert got == want and sum(got.values()) > 5000 * 3
    named = joining.unique_names(parts, "k")
    salted, _ = joining.salted_parts({n: p.na.drop(subset=["k"]) for n, p in named.items()}, "k", rows_per_task=700)
    per_salt = Counter((r["k"], r["salt"]) for r in salted["a"].collect())
    assert max(per_salt.values()) <= 900 and len([s for k, s in per_salt if k == 0]) == 8


def test_unlisted_categories_are_refused_not_dropped(spark):
    from pyspark.errors import PySparkException
    from py4j.protocol import Py4JJavaError

    from tallywick.operators import grouping

    long = spark.createDataFrame([(1, "a", 1.0), (1, "z", 5.0), (2, None, 3.0)], "k int, c string, v double")
    for built in (shaping.wide_means(long, "k", "c", "v", ["a", "b"]), grouping.full_crosstab(long, "k", "c", ["a", "b"])):
        with pytest.raises((PySparkException, Py4JJavaError), match="not listed: z"):
            built.collect()
    listed = long.where("c is null or c <> 'z'")
    assert sorted(tuple(r) for r in grouping.full_crosstab(listed, "k", "c", ["a", "b"]).collect()) == [(1, "a", 1), (1, "b", 0)]


def test_null_safe_join_spreads_missing_keys(spark):
    from collections import Counter

    left = spark.createDataFrame([(None, i) for i in range(300)] + [(1, 7), (2, 8)], "k int, x int")
    right = spark.createDataFrame([(None, "a"), (None, "b"), (1, "c"), (3, "d")], "k int, y string")
    for how in ("inner", "left"):
        got = Counter(tuple(r) for r in joining.joined(left, right, "k", how, null_safe=True).select("k", "x", "y").collect())
        plain = left.join(right.withColumnRenamed("k", "k2"), left.k.eqNullSafe(F.col("k2")), how)
        want = Counter(tuple(r) for r in plain.select(F.coalesce("k", "k2").alias("k"), "x", "y").collect())
        assert got == want
    assert sum(got.values()) == 300 * 2 + 2
