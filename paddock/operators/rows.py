"""Duplicates, unions and rows chosen per key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paddock.operators.hot import null_safe_join


def first_per_key(df: DataFrame, keys: list[str], order: list, n: int = 1) -> DataFrame:
    """The first ``n`` rows per key in ``order``, which must be a total order.

    Spark limits each group before the shuffle as well as after it, so a hot key
    ships at most ``n`` rows per map task.
    """
    position = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_n", position).where(F.col("_n") <= n).drop("_n")


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Union by column name; a column absent from one frame is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def with_key_stats(df: DataFrame, keys: list[str], **aggregates: Column) -> DataFrame:
    """Aggregates of the row's key on every row.

    The aggregate is combined on the map side, and the join that brings it back
    may broadcast it or split hot keys; a window could do neither.
    """
    stats = df.groupBy(*keys).agg(*[a.alias(n) for n, a in aggregates.items()])
    return null_safe_join(df, stats, keys)


def mark_duplicates(df: DataFrame, keys: list[str], name: str = "duplicated") -> DataFrame:
    """True on all members of a group with more than one row."""
    counted = with_key_stats(df, keys, _n=F.count(F.lit(1)))
    return counted.withColumn(name, F.col("_n") > 1).drop("_n")


def unique_or_complete(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keep a row if its key is unique or none of its columns is missing."""
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in df.columns])
    marked = mark_duplicates(df, keys, "_dup")
    return marked.where(~F.col("_dup") | complete).drop("_dup")
