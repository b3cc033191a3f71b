"""Relational store: append in foreign-key order and read in parallel ranges.

Address, driver class and credentials are always arguments, never literals. No
query is registered for these calls: they need a database server.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paddock.contracts import LOAD_ORDER

def append_tables(tables: dict[str, DataFrame], url: str, properties: dict[str, str],
                  prefix: str = "") -> list[str]:
    """Append the tables, parents before children; returns the order used."""
    done = [name for name in LOAD_ORDER if name in tables]
    for name in done:
        tables[name].write.jdbc(url, prefix + name, mode="append", properties=properties)
    return done


def read_table(spark: SparkSession, url: str, table: str, properties: dict[str, str], split: str | None = None,
               bounds: tuple[int, int] | None = None, parts: int = 1) -> DataFrame:
    """A table; with ``split`` and ``bounds`` read in ``parts`` parallel ranges."""
    if split is None:
        return spark.read.jdbc(url, table, properties=properties)
    return spark.read.jdbc(url, table, column=split, lowerBound=bounds[0], upperBound=bounds[1],
                           numPartitions=parts, properties=properties)
