"""Mergeable sketches: stored once per small group, merged into larger ones without a second look at the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Logarithm of the buckets of a distinct sketch (relative error about 1.04 / sqrt(buckets)), of the entries of a theta
# sketch (exact up to that many values), and the width of a quantile sketch (rank error about 1.3 % at 200).
BUCKETS, ENTRIES, WIDTH = 12, 12, 400


def sketched(df: DataFrame, by: list[Column | str], distinct: str, value: str) -> DataFrame:
    """Per group its rows and values in ``n`` and ``n_values``, a distinct and a theta sketch of one column, and a quantile sketch of the other.

    Missing values are in no sketch. A group without any has sketches of nothing,
    and no quantile sketch.
    """
    number = F.col(value).cast("double")
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.count(number).alias("n_values"), F.hll_sketch_agg(distinct, BUCKETS).alias("distinct_sketch"),
        F.theta_sketch_agg(distinct, ENTRIES).alias("theta_sketch"), F.kll_sketch_agg_double(number, WIDTH).alias("quantile_sketch"))


def merged(stored: DataFrame, by: list[Column | str]) -> DataFrame:
    """Stored sketches put together per larger group; the result can be merged again."""
    return stored.groupBy(*by).agg(
        F.sum("n").alias("n"), F.sum("n_values").alias("n_values"), F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.theta_union_agg("theta_sketch", ENTRIES).alias("theta_sketch"),
        F.kll_merge_agg_double(F.when(F.col("n_values") > 0, F.col("quantile_sketch"))).alias("quantile_sketch"))


def n_distinct() -> Column:
    return F.hll_sketch_estimate("distinct_sketch")


def n_distinct_theta() -> Column:
    return F.round(F.theta_sketch_estimate("theta_sketch")).cast("long")


def quantile(rank: float) -> Column:
    return F.when(F.col("n_values") > 0, F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(rank)))
