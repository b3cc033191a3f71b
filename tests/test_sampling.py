"""Samples of an exact size and sketches that are merged."""

import pytest
from pyspark.sql import functions as F

from paddock.operators import sampling, sketches


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(3000).select("id", F.when(F.col("id") < 2900, "large").when(F.col("id") < 2990, "small").alias("s"),
                                    (F.col("id") % 10).cast("double").alias("w"), F.lit(1).alias("place"))


def test_sizes_are_exact_and_the_same_however_rows_lie(rows):
    taken = sampling.exact_sample(rows, ["s"], 50, ["id"])
    assert taken.columns == rows.columns
    one = sorted((r.s or "", r.id) for r in taken.collect())
    assert {s: sum(x == s for x, _ in one) for s in ("large", "small", "")} == {"large": 50, "small": 50, "": 10}
    assert one == sorted((r.s or "", r.id) for r in sampling.exact_sample(rows.repartition(7, "w"), ["s"], 50, ["id"]).collect())
    assert one != sorted((r.s or "", r.id) for r in sampling.exact_sample(rows, ["s"], 50, ["id"], seed=15).collect())
    # Every part of the ids is drawn from.
    assert len({i // 290 for s, i in one if s == "large"}) >= 8


def test_weights_draw_in_proportion(rows):
    taken = [r.w for r in sampling.exact_sample(rows, ["s"], 400, ["id"], weight="w").where("s = 'large'").collect()]
    assert len(taken) == 400 and 0.0 not in taken
    assert taken.count(9.0) > 2 * taken.count(2.0) > 0


def test_only_a_few_rows_of_a_stratum_are_shuffled(rows):
    plan = sampling.exact_sample(rows, ["s"], 50, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_merged_sketches_say_what_direct_ones_do(spark):
    df = spark.range(20_000).select((F.col("id") % 9).alias("day"), (F.col("id") % 2).alias("kind"), (F.col("id") * 7919 % 3000).alias("user"),
                                    F.when(F.col("id") % 9 != 4, F.col("id").cast("double")).alias("value"))
    found = sketches.merged(sketches.merged(sketches.sketched(df, ["kind", "day"], "user", "value"), ["kind", "day"]), ["kind"])
    for r in found.select("kind", "n", "n_values", sketches.n_distinct().alias("u"), sketches.n_distinct_theta().alias("t"),
                          sketches.quantile(0.5).alias("m")).collect():
        exact = df.where(F.col("kind") == r.kind).agg(F.count("value"), F.count_distinct("user"), F.avg((F.col("value") <= r.m).cast("int"))).first()
        assert r.n == 10_000 and r.n_values == exact[0]
        assert abs(r.u - exact[1]) <= 0.08 * exact[1] and r.t == exact[1] and abs(exact[2] - 0.5) < 0.03
