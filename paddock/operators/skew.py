"""Two-phase aggregation with a salt between key and rows.

Only for aggregates that Spark cannot add up in the map tasks; sums, counts and
distinct counts need no salt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def salted_agg(df: DataFrame, keys: list[str], partial: dict[str, Column], final: dict[str, Column],
               salts: int = 64) -> DataFrame:
    """Aggregate per (key, salt) and then per key.

    ``partial`` aggregates rows, ``final`` aggregates the partial columns. The
    salt is the map partition, so every group arrives in up to ``salts`` pieces.
    """
    salt = (F.spark_partition_id() % salts).alias("_salt")
    pieces = df.select("*", salt).groupBy(*keys, "_salt").agg(*[a.alias(n) for n, a in partial.items()])
    return pieces.groupBy(*keys).agg(*[a.alias(n) for n, a in final.items()])


def distinct_counts(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Distinct values per key: values are made distinct before keys meet."""
    return df.select(*keys, value).distinct().groupBy(*keys).agg(F.count(value).alias(name))
