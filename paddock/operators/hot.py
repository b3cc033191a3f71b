"""Detection of hot keys and sorted runs, the two tools against skewed groups.

A window partitioned by a key puts the whole group into one task. That is the
best plan as long as no group is large. ``hot_keys`` finds the groups that are
too large with one distributed count, and ``sorted_runs`` lays such rows out in
range-partitioned runs, so one group spreads over as many tasks as it needs.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.session import checkpoint

# Rows one task may sort for one group before the group counts as hot.
GROUP_ROWS = 2_000_000
# Rows one task may sort when there is no key at all.
KEYLESS_ROWS = 1_000_000
# Smallest run worth a task of its own.
MIN_RUN_ROWS = 100_000

RUN = "_run"
ROW = "_row"
SIZE = "_rows"


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left",
                   small: bool = False) -> DataFrame:
    """Equi join on equally named keys where missing matches missing.

    ``small`` is for a right side whose size is bounded by construction.
    """
    right = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    if small:
        right = F.broadcast(right)
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    joined = left.join(right, on, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"__{k}" for k in keys])


def small_rows(df: DataFrame, limit: int) -> list:
    """All rows of a frame that must be small; an error, not a cut, if it is not."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows where few were expected")
    return rows


def hot_keys(df: DataFrame, keys: list[str], group_rows: int = GROUP_ROWS,
             bound: DataFrame | None = None) -> DataFrame | None:
    """Keys with more than ``group_rows`` rows, or None when there are none.

    ``bound`` is a frame that is cheaper to count and has at least as many rows;
    with few of them nothing else is read. The rows are counted per key hash,
    summed up in the map tasks before they are shuffled, and only hashes of
    crowded groups are counted once more by their keys. No key is overlooked
    whatever its share. The result, the keys and their number of rows in
    ``_rows``, has at most ``rows / group_rows`` rows and can be broadcast.
    """
    if bound is not None and bound.count() <= group_rows:
        return None
    digest = F.xxhash64(*keys)
    crowded = checkpoint(df.groupBy(digest.alias("_hash")).agg(F.count(F.lit(1)).alias(SIZE))
                         .where(F.col(SIZE) > group_rows).select("_hash"))
    if crowded.isEmpty():
        return None
    # As few rows as there are crowded groups, so they are sent to the rows.
    candidates = df.withColumn("_hash", digest).join(F.broadcast(crowded), "_hash", "left_semi")
    hot = checkpoint(candidates.groupBy(*keys).agg(F.count(F.lit(1)).alias(SIZE)).where(F.col(SIZE) > group_rows))
    return None if hot.isEmpty() else hot


def split_hot(df: DataFrame, keys: list[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the ordinary keys and rows of the hot keys."""
    return (null_safe_join(df, hot, keys, "left_anti", small=True),
            null_safe_join(df, hot, keys, "left_semi", small=True))


def sorted_runs(df: DataFrame, order: list, rows: int, run_rows: int) -> DataFrame:
    """``df`` in total order as range partitions, with ``_run`` and ``_row``.

    ``_row`` ascends over the whole result and ``_run`` numbers the partitions,
    of which there are enough to give each about ``run_rows`` of the ``rows``.
    The runs are written to the shared folder, because the numbers must not
    change when a lost partition is computed again.
    """
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = max(usual, ceil(rows / max(run_rows, MIN_RUN_ROWS)))
    laid_out = df.repartitionByRange(runs, *order).sortWithinPartitions(*order)
    numbered = laid_out.withColumn(ROW, F.monotonically_increasing_id())
    return checkpoint(numbered.withColumn(RUN, F.shiftright(ROW, 33)))
