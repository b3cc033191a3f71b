"""The run-wise scan must equal the plain window, whatever the skew."""

import random

import pytest
from pyspark.sql import functions as F

from paddock.operators.hot import hot_keys
from paddock.operators.scan import dense_ids, in_order, latest, ranked, running, running_count, running_sum


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        key = 1 if i % 3 == 0 else (None if i % 11 == 0 else rng.randint(2, 40))
        rows.append((key, rng.randint(0, 60), i, None if rng.random() < 0.4 else float(i)))
    return spark.createDataFrame(rows, "k int, t int, id int, v double").cache()


def as_set(df):
    columns = sorted(df.columns)
    return sorted(map(str, (tuple(round(x, 9) if isinstance(x, float) else x for x in r)
                            for r in df.select(*columns).collect())))


def test_hot_keys_are_found_exactly(skewed):
    hot = hot_keys(skewed, ["k"], group_rows=200)
    assert [r.k for r in hot.collect()] == [1] or {r.k for r in hot.collect()} == {1, None}
    assert hot_keys(skewed, ["k"], group_rows=2000) is None
    assert hot_keys(skewed, ["k"], group_rows=5000) is None


def test_running_on_hot_keys_equals_plain(skewed):
    measures = {
        "n": running_count(), "n_before": running_count(before=True),
        "total": running_sum("t"), "total_before": running_sum("t", before=True),
        "seen": latest("v"), "previous": latest("v", before=True),
    }
    plain = running(skewed, ["k"], ["t", "id"], measures)
    split = running(skewed, ["k"], ["t", "id"], measures, group_rows=100)
    assert as_set(plain) == as_set(split)


def test_running_without_keys_equals_plain(skewed):
    measures = {"n": running_count(), "seen": latest("v", before=True)}
    plain = running(skewed, [], [F.col("t").desc(), "id"], measures)
    split = running(skewed, [], [F.col("t").desc(), "id"], measures, group_rows=10)
    assert as_set(plain) == as_set(split)


def test_ranks_on_hot_keys_equal_plain(skewed):
    plain = ranked(skewed, ["k"], "t", "id", tiles=7)
    split = ranked(skewed, ["k"], "t", "id", tiles=7, group_rows=60)
    assert as_set(plain) == as_set(split)


def test_dense_ids_are_complete_and_ordered(skewed):
    ids = dense_ids(skewed.select("id"), ["id"], "n", rows_limit=10).orderBy("id").collect()
    assert [r.n for r in ids] == list(range(1, 3001))


def test_many_keys_just_above_the_limit_are_all_found(spark):
    rows = spark.range(0, 300 * 21).select((F.col("id") % 300).alias("k")).unionByName(spark.range(300, 2000).select(F.col("id").alias("k")))
    rows = rows.unionByName(spark.range(25).select(F.lit(None).cast("long").alias("k")))
    hot = hot_keys(rows, ["k"], group_rows=20)
    assert {r["k"]: r["_rows"] for r in hot.collect()} == {**{k: 21 for k in range(300)}, None: 25}


def test_counting_hot_keys_never_meets_in_one_task(spark):
    rows = spark.range(0, 10_000).select((F.col("id") % 7).alias("k"))
    counted = rows.groupBy(F.xxhash64("k")).count()
    assert "SinglePartition" not in counted._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("group_rows", [2, 1000])
def test_moving_mean_counts_rows_not_values(spark, group_rows):
    from paddock.queries.relational import moving_mean
    rows = [(1, 1, 1, 10.0), (1, 2, 2, None), (1, 3, 3, 30.0), (1, 4, 4, 40.0), (1, 5, 5, None), (2, 6, 1, None)]
    got = moving_mean(spark.createDataFrame(rows, "o_custkey long, o_orderkey long, o_orderdate long, o_totalprice double"), group_rows)
    assert {r["o_orderkey"]: r["moving_mean"] for r in got.collect()} == {1: 10.0, 2: 10.0, 3: 20.0, 4: 35.0, 5: 35.0, 6: None}


def test_frequent_values_are_sorted_in_many_partitions(spark):
    df = spark.range(300_000).select(F.when(F.col("id") % 10 == 0, F.lit(None)).when(F.col("id") % 7 == 0, F.col("id") % 5).otherwise(3).alias("v"))
    parts = in_order(df, ["v"], run_rows=10_000).rdd.map(lambda r: r.v).glom().collect()
    found = [v for p in parts for v in p]
    assert found == sorted((r.v for r in df.collect()), key=lambda v: (v is not None, v or 0))
    assert len(parts) == 30 and max(map(len, parts)) < 30_000


def test_sorted_runs_number_their_rows_themselves(skewed):
    ids = dense_ids(skewed.select("id"), ["id"], "n", rows_limit=10, bound=skewed.count())
    assert [r["n"] for r in ids.orderBy("id").collect()] == list(range(1, skewed.count() + 1))
    # Only the few sums of the runs are scanned by a window.
    plan = ids._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1
