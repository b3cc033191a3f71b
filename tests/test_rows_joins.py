import random

from pyspark.sql import functions as F

from paddock.operators import joins, rows, skew
from paddock.operators.hot import small_rows

import pytest


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_first_per_key_does_not_depend_on_row_order(spark):
    data = [("a", 2021, 0, "x"), ("a", 2022, 1, "y"), ("a", 2022, 0, "z"), (None, 2020, 0, "n"), (None, 2019, 0, "o")]
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "id string, season int, pos int, v string").repartition(3)
        best = rows.first_per_key(df, ["id"], [F.col("season").desc(), "pos"])
        assert sorted_rows(best.select("id", "v")) == [("a", "z"), (None, "n")]


def test_first_per_key_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = rows.first_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_unique_or_complete(spark):
    handles = spark.createDataFrame([(1, "a"), (1, None), (2, None), (3, "x"), (3, "y")], "id int, twitter string")
    assert sorted_rows(rows.unique_or_complete(handles, ["id"])) == [(1, "a"), (2, None), (3, "x"), (3, "y")]


def test_mark_duplicates_with_missing_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 3), (None, 4), (None, 5)], "k int, v int")
    assert {(r.v, r.duplicated) for r in rows.mark_duplicates(df, ["k"]).collect()} == {
        (1, True), (2, True), (3, False), (4, True), (5, True)}


def test_left_lookup_fan_out_null_keys_and_suffixes(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "k int, v string")
    assert sorted_rows(joins.left_lookup(left, right, ["k"])) == [(1, "a", "x"), (1, "a", "y"), (2, "b", None), (None, "c", None)]
    assert sorted_rows(joins.left_lookup(left, right, ["k"], null_safe=True)) == [
        (1, "a", "x"), (1, "a", "y"), (2, "b", None), (None, "c", "z")]
    assert sorted_rows(joins.left_lookup(left, right, ["k"], one_row=["v"])) == [
        (1, "a", "x"), (2, "b", None), (None, "c", None)]


def test_last_override_wins_across_both_kinds(spark):
    df = spark.createDataFrame([("n", "xf", 1), ("n", "cw", 1), ("m", "xf", 5)], "name string, series string, year int")
    overrides = spark.createDataFrame(
        [(1, "n", None, 10), (2, "n", "xf", 20), (3, "m", "xf", 30), (4, "m", None, 40), (5, "q", None, 9)],
        "seq int, name string, series string, value int")
    assert sorted_rows(joins.apply_overrides(df, overrides, "name", "year", "series")) == [
        ("m", "xf", 40), ("n", "cw", 10), ("n", "xf", 20)]


def test_override_with_a_missing_value_is_ignored(spark):
    df = spark.createDataFrame([("n", 1)], "name string, year int")
    none = spark.createDataFrame([], "seq int, name string, value int")
    assert sorted_rows(joins.apply_overrides(df, none, "name", "year")) == [("n", 1)]


def test_salted_agg_equals_plain_agg(spark):
    df = spark.range(0, 5000, numPartitions=16).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), "id")
    salted = skew.salted_agg(df, ["k"], {"n": F.count(F.lit(1)), "t": F.sum("id")}, {"n": F.sum("n"), "t": F.sum("t")})
    assert sorted_rows(salted) == sorted_rows(df.groupBy("k").agg(F.count(F.lit(1)), F.sum("id")))


def test_small_rows_refuses_instead_of_cutting(spark):
    assert len(small_rows(spark.range(5), 5)) == 5
    with pytest.raises(ValueError):
        small_rows(spark.range(6), 5)
