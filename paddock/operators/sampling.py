"""Samples of an exact size per stratum."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def exact_sample(df: DataFrame, strata: list[str], rows: int, key: list[str], weight: str | None = None, seed: int = 14) -> DataFrame:
    """``rows`` rows of every stratum, or all where there are fewer, drawn without replacement.

    Every row has a random number made of its key and the seed, and the rows with
    the smallest ones are taken, so the sample is the same however the rows are
    partitioned. With ``weight`` the number is exponential at that rate, which
    draws one row after the other in proportion to the weights left; rows without
    a positive weight are never drawn. A window with a limit takes the smallest in
    every map task first, so a task ships at most ``rows`` rows of a stratum, and
    a stratum of any size costs no more.
    """
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *key), 11) + 0.5) / float(1 << 53)
    drawn = df
    if weight is not None:
        rate = F.col(weight).cast("double")
        drawn = df.where((rate > 0) & (rate < float("inf")))
        uniform = -F.log(uniform) / rate
    place = F.row_number().over(W.partitionBy(*strata).orderBy(uniform, *key))
    return drawn.withColumn("__place", place).where(F.col("__place") <= rows).drop("__place")
