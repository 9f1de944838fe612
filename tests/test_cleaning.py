"""Rules, casts and bands on small tables with the awkward cases."""

import pytest
from pyspark.sql import functions as F

from tallywick.functions.values import banded, key_hash, labelled, row_mean, slug, to_float, to_integer
from tallywick.operators import cleaning
from tallywick.operators.contract import ContractError, numeric_columns, present_columns, require_columns
from tallywick.operators.features import with_z_scores
from tallywick.operators.shaping import copied


def values(df, column):
    return [r[column] for r in df.collect()]


def test_missing_values_break_no_range(spark):
    rows = spark.createDataFrame([(1.0,), (None,), (500.0,)], "v double")
    rule = {"name": "v", "column": "v", "max": 100, "action": "drop"}
    assert sorted(values(cleaning.apply_rules(rows, [rule]), "v"), key=str) == [1.0, None]
    assert values(cleaning.apply_rules(rows, [rule | {"nulls": "drop"}]), "v") == [1.0]
    cleared = values(cleaning.apply_rules(rows, [rule | {"action": "null"}]), "v")
    assert cleared == [1.0, None, None]


def test_rules_on_absent_columns_do_nothing(spark):
    rows = spark.createDataFrame([(1, 2)], "a int, b int")
    rules = [
        {"name": "gone", "column": "c", "min": 5, "action": "drop"},
        {"name": "gone too", "any": [[{"column": "a", "equals": 1}, {"column": "c", "equals": 1}]], "action": "drop"},
    ]
    assert cleaning.apply_rules(rows, rules).count() == 1


def test_unknown_action_is_refused(spark):
    with pytest.raises(ValueError):
        cleaning.apply_rules(spark.range(1), [{"name": "x", "column": "id", "min": 0, "action": "hide"}])


def test_kept_and_dropped_add_up(spark):
    rows = spark.range(1000).select((F.col("id") % 10).alias("a"), (F.col("id") % 7).alias("b"))
    rules = [
        {"name": "a", "column": "a", "min": 2, "action": "drop"},
        {"name": "b", "column": "b", "allowed": [0, 1, 2], "action": "null"},
        {"name": "ab", "any": [[{"column": "a", "equals": 5}, {"column": "b", "equals": 1}]], "action": "drop"},
    ]
    counts = {r["rule"]: r for r in cleaning.attrition(rows, rules).collect()}
    kept = cleaning.apply_rules(rows, rules).count()
    assert kept + counts["a"]["in_order"] + counts["ab"]["in_order"] == 1000
    assert counts["b"]["alone"] > counts["b"]["in_order"]


def test_header_and_duplicates(spark):
    rows = spark.createDataFrame([("a", "b"), ("1", "b"), ("1", "b"), (None, None), (None, None)], "a string, b string")
    clean = cleaning.without_duplicates(cleaning.without_header_rows(rows))
    assert sorted(map(tuple, clean.collect()), key=str) == [("1", "b"), (None, None)]
    empty = rows.where("false")
    assert cleaning.without_header_rows(empty).count() == 0


def test_casts(spark):
    texts = ["1", " 2 ", "1.5", "-1.5", "?", "", None, "9007199254740993", "1e30", "NaN", "Infinity"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    integers = values(rows.select(to_integer(F.col("t")).alias("x")), "x")
    assert integers == [1, 2, 1, -2, None, None, None, 9007199254740993, None, None, None]
    floats = values(rows.select(to_float(F.col("t")).alias("x")), "x")
    assert floats[:5] == [1.0, 2.0, 1.5, -1.5, None] and floats[8:] == [1e30, None, None]


def test_bands(spark):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate([39.0, 40.0, 50.0, 50.1, 70.0, 71.0, None])], "i int, v double")
    right = rows.select("i", banded(F.col("v"), [40, 50, 70], ["x", "y"]).alias("band")).orderBy("i")
    assert values(right, "band") == [None, "x", "x", "y", "y", None, None]
    left = rows.select("i", banded(F.col("v"), [40, 50, 70], ["x", "y"], "left").alias("band")).orderBy("i")
    assert values(left, "band") == [None, "x", "y", "y", None, None, None]
    with pytest.raises(ValueError):
        banded(F.col("v"), [1, 2], ["a", "b"])


def test_labels_rowmean_and_slug(spark):
    row = spark.range(1).select(
        labelled(F.lit(1), {1: "one"}).alias("known"),
        labelled(F.lit(2), {1: "one"}).alias("unknown"),
        row_mean([F.lit(1.0), F.lit(None), F.lit(4.0)]).alias("mean"),
        row_mean([F.lit(None), F.lit(None)]).alias("none"),
        slug(F.lit("  Age (years) - Max ")).alias("slug"),
    ).first()
    assert tuple(row) == ("one", None, 2.5, None, "age_years_max")


def test_z_scores_of_a_constant_are_missing(spark):
    rows = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    scored = with_z_scores(rows, ["a", "b"]).orderBy("a").collect()
    assert [r["a_zscore"] for r in scored] == pytest.approx([-(0.5**0.5), 0.5**0.5])
    assert [r["b_zscore"] for r in scored] == [None, None]


def test_key_hash_is_stable_under_partitioning(spark):
    rows = spark.range(500)
    one = {r["id"]: r["h"] for r in rows.repartition(1).select("id", key_hash(F.col("id"), 5).alias("h")).collect()}
    many = {r["id"]: r["h"] for r in rows.repartition(7).select("id", key_hash(F.col("id"), 5).alias("h")).collect()}
    assert one == many and set(one.values()) == {0, 1, 2, 3, 4}


def test_contract(spark):
    rows = spark.createDataFrame([(1, "x", 2.0)], "a int, b string, c double")
    assert require_columns(rows, ["a"]) is rows
    with pytest.raises(ContractError, match="d"):
        require_columns(rows, ["a", "d"])
    assert numeric_columns(rows) == ["a", "c"]
    assert present_columns(rows, ["d", "c"]) == ["c"]
    with pytest.raises(ContractError):
        present_columns(rows, ["d", "c"], strict=True)
    assert copied(rows, "d", "e").columns == rows.columns


def test_rest_as_text(spark):
    rows = spark.sql("SELECT 1 AS a, DATE'2020-01-02' AS d, true AS f, 1.5BD AS m")
    texts = cleaning.rest_as_text(rows)
    assert [f.dataType.simpleString() for f in texts.schema] == ["int", "string", "boolean", "decimal(2,1)"]
    assert texts.first()["d"] == "2020-01-02"
