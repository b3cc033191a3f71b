"""Data profiles, each computed in one aggregate pass over the frame."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _is_float(field: T.StructField) -> bool:
    return isinstance(field.dataType, (T.DoubleType, T.FloatType))


def _as_rows(one_row: DataFrame, values: dict[str, list[str]], names: list[str]) -> DataFrame:
    """Turn one wide row into one row per key of ``values``."""
    entries = F.array(*[
        F.struct(F.lit(key).alias(names[0]), *[F.col(c).alias(n) for c, n in zip(cells, names[1:])])
        for key, cells in values.items()])
    return one_row.select(F.explode(entries).alias("r")).select("r.*")


def missing_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows (column, n_null, n_nan, n_rows, share) for every column."""
    fields = [df.schema[c] for c in (columns or df.columns)]
    measures, cells = [F.count(F.lit(1)).alias("n")], {}
    for i, field in enumerate(fields):
        c = F.col(field.name)
        nan = F.count_if(F.isnan(c)) if _is_float(field) else F.lit(0).cast("long")
        measures += [F.count_if(c.isNull()).alias(f"null_{i}"), nan.alias(f"nan_{i}")]
        cells[field.name] = [f"null_{i}", f"nan_{i}", "n"]
    rows = _as_rows(df.agg(*measures), cells, ["column", "n_null", "n_nan", "n_rows"])
    missing = F.col("n_null") + F.col("n_nan")
    return rows.withColumn("share", F.coalesce(F.try_divide(missing, F.col("n_rows")), F.lit(0.0)))


def columns_with_missing(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return missing_profile(df, columns).where(F.col("n_null") + F.col("n_nan") > 0)


def drop_sparse(df: DataFrame, limit: float = 0.5) -> DataFrame:
    """Drop the columns whose missing share is above ``limit``."""
    sparse = missing_profile(df).where(F.col("share") > limit).select("column")
    return df.drop(*[r["column"] for r in sparse.collect()])


def zero_filled_mean(column: Column) -> Column:
    """Sum over all rows, missing as 0, divided by the number of all rows."""
    return F.sum(F.coalesce(F.nanvl(column, F.lit(0.0)), F.lit(0.0))) / F.count(F.lit(1))


def impute_zero_filled(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fill NULL and NaN with the zero-filled mean; one pass for all columns."""
    means = df.agg(*[zero_filled_mean(F.col(c).cast("double")).alias(c) for c in columns]).first()
    return df.na.fill({c: means[c] for c in columns if means[c] is not None})


def summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (column, n, mean, stddev, min, max)."""
    measures, cells = [], {}
    for i, name in enumerate(columns):
        c = F.col(name).cast("double")
        measures += [F.count(c).alias(f"n_{i}"), F.avg(c).alias(f"mean_{i}"), F.stddev_samp(c).alias(f"sd_{i}"),
                     F.min(c).alias(f"min_{i}"), F.max(c).alias(f"max_{i}")]
        cells[name] = [f"n_{i}", f"mean_{i}", f"sd_{i}", f"min_{i}", f"max_{i}"]
    return _as_rows(df.agg(*measures), cells, ["column", "n", "mean", "stddev", "min", "max"])


def correlated_pairs(df: DataFrame, columns: list[str], threshold: float = 0.7) -> DataFrame:
    """Ordered pairs (x, y, corr) with corr >= threshold, sign kept.

    All pairs come from one aggregate. A constant column has no correlation and
    is left out.
    """
    pairs = list(combinations(columns, 2))
    measures = []
    for i, (x, y) in enumerate(pairs):
        a, b = F.col(x).cast("double"), F.col(y).cast("double")
        both = a.isNotNull() & b.isNotNull()
        a, b = F.when(both, a), F.when(both, b)
        # corr = covariance / (deviation * deviation), undefined when either is 0.
        spread = F.stddev_pop(a) * F.stddev_pop(b)
        measures.append(F.try_divide(F.covar_pop(a, b), spread).alias(f"c_{i}"))
    entries = F.array(*[
        F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"c_{i}").alias("corr"))
        for i, (x, y) in enumerate(pairs) for a, b in ((x, y), (y, x))])
    found = df.agg(*measures).select(F.explode(entries).alias("r")).select("r.*")
    return found.where(F.col("corr") >= threshold)


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def schema_rows(df: DataFrame) -> list[tuple[int, str, str, bool]]:
    return [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema)]
