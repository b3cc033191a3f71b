"""Lookups, enrichment tiers and ordered overrides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.operators.hot import null_safe_join
from paddock.operators.rows import first_per_key


def left_lookup(left: DataFrame, right: DataFrame, keys: list[str], null_safe: bool = False,
                suffixes: tuple[str, str] = ("_x", "_y"), one_row: list | None = None) -> DataFrame:
    """Left equi join; columns both sides carry get the suffixes.

    Repeated right keys multiply the left rows unless ``one_row`` gives the order
    by which one right row per key is chosen first.
    """
    if one_row is not None:
        right = first_per_key(right, keys, one_row)
    shared = [c for c in left.columns if c in right.columns and c not in keys]
    left = left.withColumnsRenamed({c: c + suffixes[0] for c in shared})
    right = right.withColumnsRenamed({c: c + suffixes[1] for c in shared})
    return null_safe_join(left, right, keys) if null_safe else left.join(right, keys, "left")


def surrogate(fact: DataFrame, dimension: DataFrame, keys: list[str], id_column: str,
              as_name: str) -> DataFrame:
    """Replace the natural key by the id of its dimension row."""
    ids = dimension.select(*keys, F.col(id_column).alias(as_name))
    return null_safe_join(fact, ids, keys).drop(*keys)


def unresolved(df: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key has no match."""
    return df.join(known.select(*keys), keys, "left_anti")


def first_known(tiers: dict[str, Column]) -> tuple[Column, Column]:
    """The first non-null tier and the name of the tier it came from."""
    value = F.coalesce(*tiers.values())
    source = F.coalesce(*[F.when(c.isNotNull(), F.lit(n)) for n, c in tiers.items()])
    return value, source


def apply_overrides(df: DataFrame, overrides: DataFrame, name_key: str, column: str,
                    second_key: str | None = None) -> DataFrame:
    """Overwrite ``column`` from rows (seq, name_key[, second_key], value).

    An override without second key applies to every row of the name. Of all
    overrides that apply to a row the one with the largest ``seq`` wins, as if
    they were written one after the other.
    """
    packed = F.struct("seq", "value")
    if second_key is None:
        by_name, by_pair = overrides, None
    else:
        by_name = overrides.where(F.col(second_key).isNull())
        by_pair = overrides.where(F.col(second_key).isNotNull())
    names = by_name.groupBy(name_key).agg(F.max_by(packed, F.col("seq")).alias("_by_name"))
    out = df.join(names, name_key, "left")
    picked = F.col("_by_name")
    if by_pair is not None:
        pairs = by_pair.groupBy(name_key, second_key).agg(F.max_by(packed, F.col("seq")).alias("_by_pair"))
        out = out.join(pairs, [name_key, second_key], "left")
        # greatest() skips NULL, and structs compare by their first field.
        picked = F.greatest(F.col("_by_name"), F.col("_by_pair"))
    kind = df.schema[column].dataType
    value = F.when(picked.isNotNull(), picked["value"].cast(kind)).otherwise(F.col(column))
    return out.withColumn(column, value).select(*df.columns)
