"""The eight tables of the normalised store and the checks on them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Table and column names, types, keys and the expected row counts.
DDL = {
    "personal_info": "id long, driver_id string, first_name string, last_name string, full_name string, "
                     "gender string, height double, weight double, birthday timestamp, birth_place string, "
                     "country string",
    "race_info": "id long, series string, season int",
    "social_media": "social_media_id long, driver_id long, twitter string",
    "seasonal_achievement": "seasonal_achievement_id long, race_id long, driver_id long, rank int, starts int, "
                            "points int, wins int, stage_wins int, poles int, top_5 int, top_10 int, "
                            "top_15 int, top_20 int",
    "detailed_performance": "detailed_performance_id long, race_id long, driver_id long, chase_bonus double, "
                            "chase_wins double, chase_stage_wins double, laps_led int, laps_completed int, "
                            "avg_start_position double, avg_finish_position double, avg_laps_completed double, "
                            "laps_led_pct double, dnf int, in_chase boolean, behind double",
    "earnings": "earnings_id long, driver_id long, race_id long, money double",
    "debut_info": "debut_info_id long, driver_id long, series string, rookie_year int",
    "status_info": "status_info_id long, driver_id long, status string",
}
PRIMARY_KEYS = {
    "personal_info": "id", "race_info": "id", "social_media": "social_media_id",
    "seasonal_achievement": "seasonal_achievement_id", "detailed_performance": "detailed_performance_id",
    "earnings": "earnings_id", "debut_info": "debut_info_id", "status_info": "status_info_id",
}
FOREIGN_KEYS = [
    ("social_media", "driver_id", "personal_info"),
    ("seasonal_achievement", "race_id", "race_info"),
    ("seasonal_achievement", "driver_id", "personal_info"),
    ("detailed_performance", "race_id", "race_info"),
    ("detailed_performance", "driver_id", "personal_info"),
    ("earnings", "driver_id", "personal_info"),
    ("earnings", "race_id", "race_info"),
    ("debut_info", "driver_id", "personal_info"),
    ("status_info", "driver_id", "personal_info"),
]
LOAD_ORDER = list(DDL)
EXPECTED_ROWS = {
    "personal_info": 481, "social_media": 483, "race_info": 24, "seasonal_achievement": 2161,
    "detailed_performance": 2161, "earnings": 2161, "debut_info": 779, "status_info": 477,
}


def schema_of(table: str) -> T.StructType:
    return T.StructType.fromDDL(DDL[table])


def contract_rows(spark: SparkSession) -> DataFrame:
    """The contract as rows (table_name, position, column_name, data_type)."""
    rows = [(t, i, f.name, f.dataType.simpleString()) for t in DDL for i, f in enumerate(schema_of(t))]
    return spark.createDataFrame(rows, "table_name string, position int, column_name string, data_type string")


def schema_violations(df: DataFrame, table: str) -> list[tuple[str, str, str | None, str | None]]:
    """(table, column, wanted type, found type) for every difference."""
    wanted = {f.name: f.dataType.simpleString() for f in schema_of(table)}
    found = {f.name: f.dataType.simpleString() for f in df.schema}
    names = list(wanted) + [n for n in found if n not in wanted]
    return [(table, n, wanted.get(n), found.get(n)) for n in names if wanted.get(n) != found.get(n)]


def conform(df: DataFrame, table: str) -> DataFrame:
    """The contract's columns in order and type; text that does not parse is NULL."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema_of(table)])


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose foreign key is missing or points nowhere."""
    keys = parent.select(F.col(parent_key).alias(column))
    return child.join(keys, column, "left_anti")


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys found on more than one row, and keys that are missing."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return counted.where((F.col("n_rows") > 1) | missing)


def row_count_check(df: DataFrame, expected: int) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(expected).cast("long").alias("expected"), (F.col("n_rows") == expected).alias("ok"))


def violations(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per primary and foreign key with the number of offending rows."""
    checks = []
    for name, key in PRIMARY_KEYS.items():
        if name in tables:
            bad = repeated_keys(tables[name], [key])
            checks.append(_count_row(bad, "primary_key", name, key))
    for child, column, parent in FOREIGN_KEYS:
        if child in tables and parent in tables:
            bad = orphans(tables[child], column, tables[parent], PRIMARY_KEYS[parent])
            checks.append(_count_row(bad, "foreign_key", child, column))
    return reduce(DataFrame.unionByName, checks)


def _count_row(bad: DataFrame, kind: str, table: str, column: str) -> DataFrame:
    return bad.agg(F.count(F.lit(1)).alias("n_bad")).select(
        F.lit(kind).alias("kind"), F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "n_bad")


def create_tables(spark: SparkSession, tables: dict[str, DataFrame]) -> list[str]:
    """Drop and create a view per table, parents first."""
    names = [n for n in LOAD_ORDER if n in tables]
    for name in names:
        spark.catalog.dropTempView(name)
        conform(tables[name], name).createOrReplaceTempView(name)
    return names
