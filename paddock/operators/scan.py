"""Ordered scans per key: running totals, previous values, ids and ranks.

Ordinary groups use a plain window. Hot groups are laid out in sorted runs,
scanned run by run, and each run gets what the runs before it carry over.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paddock.operators.hot import (
    GROUP_ROWS, KEYLESS_ROWS, ROW, RUN, SIZE, hot_keys, null_safe_join, sorted_runs, split_hot,
)


@dataclass(frozen=True)
class Measure:
    """One scanned value: ``kind`` of a column, with or without the current row."""

    kind: str
    column: str | None = None
    before: bool = False

    def over(self, window) -> Column:
        frame = window.rowsBetween(W.unboundedPreceding, -1 if self.before else 0)
        if self.kind == "count":
            return F.count(F.lit(1) if self.column is None else F.col(self.column)).over(frame)
        if self.kind == "sum":
            return F.coalesce(F.sum(self.column).over(frame), self._zero())
        return F.last(self.column, ignorenulls=True).over(frame)

    def of_run(self) -> Column:
        if self.kind == "count":
            return F.count(F.lit(1) if self.column is None else F.col(self.column))
        if self.kind == "sum":
            return F.sum(self.column)
        present = F.when(F.col(self.column).isNotNull(), F.col(ROW))
        return F.max_by(F.col(self.column), present)

    def carried(self, name: str, window) -> Column:
        frame = window.rowsBetween(W.unboundedPreceding, -1)
        if self.kind == "last":
            return F.last(name, ignorenulls=True).over(frame)
        return F.sum(name).over(frame)

    def combine(self, local: Column, carry: Column) -> Column:
        if self.kind == "last":
            return F.coalesce(local, carry)
        return local + F.coalesce(carry, self._zero())

    @staticmethod
    def _zero() -> Column:
        return F.lit(0)


def running_count(column: str | None = None, before: bool = False) -> Measure:
    return Measure("count", column, before)


def running_sum(column: str, before: bool = False) -> Measure:
    return Measure("sum", column, before)


def latest(column: str, before: bool = False) -> Measure:
    """The last non-null value so far."""
    return Measure("last", column, before)


def running(df: DataFrame, keys: list[str], order: list, measures: dict[str, Measure],
            group_rows: int | None = None, bound: DataFrame | None = None,
            hot: DataFrame | str | None = "detect") -> DataFrame:
    """``df`` plus one scanned column per measure, per key and in ``order``.

    ``order`` should end in a unique column. ``hot`` takes the result of an
    earlier ``hot_keys`` call, so a chain of scans looks for hot keys once. Without keys the scan runs over the
    whole frame, which is one group and treated as hot beyond its limit.
    """
    limit = group_rows or (GROUP_ROWS if keys else KEYLESS_ROWS)
    if not keys:
        rows = (df if bound is None else bound).count()
        return _plain(df, keys, order, measures) if rows <= limit else _by_runs(df, keys, order, measures, rows, limit)
    if isinstance(hot, str):
        hot = hot_keys(df, keys, limit, bound)
    if hot is None:
        return _plain(df, keys, order, measures)
    rest, crowded = split_hot(df, keys, hot)
    return _plain(rest, keys, order, measures).unionByName(
        _by_runs(crowded, keys, order, measures, _hot_rows(hot), limit))


def _plain(df, keys, order, measures):
    window = W.partitionBy(*keys).orderBy(*order)
    return df.select("*", *[m.over(window).alias(n) for n, m in measures.items()])


def _hot_rows(hot):
    return hot.agg(F.sum(SIZE)).first()[0]


def _by_runs(df, keys, order, measures, rows, run_rows):
    runs = sorted_runs(df, [*keys, *order], rows, run_rows)
    inside = W.partitionBy(*keys, RUN).orderBy(ROW)
    scanned = runs.select("*", *[m.over(inside).alias(n) for n, m in measures.items()])
    totals = runs.groupBy(*keys, RUN).agg(*[m.of_run().alias(f"_c_{n}") for n, m in measures.items()])
    # One row per key and run: at most the number of runs plus the number of hot keys.
    across = W.partitionBy(*keys).orderBy(RUN)
    carry = totals.select(
        *keys, RUN, *[m.carried(f"_c_{n}", across).alias(f"_c_{n}") for n, m in measures.items()])
    joined = null_safe_join(scanned, carry, [*keys, RUN], small=True)
    return joined.select(
        *df.columns, *[m.combine(F.col(n), F.col(f"_c_{n}")).alias(n) for n, m in measures.items()])


def in_order(df: DataFrame, order: list, run_rows: int = KEYLESS_ROWS) -> DataFrame:
    """``df`` sorted as a whole, in range partitions of about ``run_rows`` rows each.

    Rows with equal values are told apart by a random number, so a frequent value
    spreads over as many partitions as it needs. The number of partitions follows
    the counted rows and not their bytes, which are few for values that repeat.
    """
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    drawn = df.withColumn("_draw", F.rand(14))
    runs = max(usual, ceil(df.count() / run_rows))
    return drawn.repartitionByRange(runs, *order, "_draw").sortWithinPartitions(*order).drop("_draw")


def dense_ids(df: DataFrame, order: list, name: str = "id", rows_limit: int = KEYLESS_ROWS,
              bound: DataFrame | int | None = None) -> DataFrame:
    """Ids 1..n in the order of a unique key, without one task sorting it all.

    ``bound`` is a number of rows that is not exceeded, or a frame that is cheaper
    to count and has at least as many rows. A sorted run numbers its rows by
    itself, so they are neither dealt nor sorted a second time.
    """
    rows = bound if isinstance(bound, int) else (df if bound is None else bound).count()
    if rows <= rows_limit:
        return _plain(df, [], order, {name: running_count()})
    runs = sorted_runs(df, order, rows, rows_limit)
    # One row per run.
    sizes = runs.groupBy(RUN).agg(F.count(F.lit(1)).alias(SIZE))
    carry = sizes.select(RUN, F.sum(SIZE).over(W.orderBy(RUN).rowsBetween(W.unboundedPreceding, -1)).alias("_before"))
    place = F.col(ROW).bitwiseAND(F.lit((1 << 33) - 1)) + 1 + F.coalesce("_before", F.lit(0))
    return null_safe_join(runs, carry, [RUN], small=True).select(*df.columns, place.alias(name))


def ranked(df: DataFrame, keys: list[str], order: str, tie: str, tiles: int = 4,
           group_rows: int = GROUP_ROWS, bound: DataFrame | None = None) -> DataFrame:
    """All ranking columns per key by ascending ``order``; ``tie`` is unique."""
    hot = hot_keys(df, keys, group_rows, bound)
    if hot is None:
        return _ranked_plain(df, keys, order, tie, tiles)
    rest, crowded = split_hot(df, keys, hot)
    return _ranked_plain(rest, keys, order, tie, tiles).unionByName(
        _ranked_by_runs(crowded, keys, order, tie, tiles, _hot_rows(hot), group_rows))


def _ranked_plain(df, keys, order, tie, tiles):
    by_value = W.partitionBy(*keys).orderBy(order)
    by_row = W.partitionBy(*keys).orderBy(order, tie)
    return df.select(
        "*",
        F.row_number().over(by_row).cast("long").alias("row_number"),
        F.rank().over(by_value).cast("long").alias("rank"),
        F.dense_rank().over(by_value).cast("long").alias("dense_rank"),
        F.percent_rank().over(by_value).alias("percent_rank"),
        F.cume_dist().over(by_value).alias("cume_dist"),
        F.ntile(tiles).over(by_row).cast("long").alias("tile"),
    )


def _ranked_by_runs(df, keys, order, tie, tiles, rows, run_rows):
    # Ranks depend on the distinct values only, so they are scanned on counts.
    values = df.groupBy(*keys, order).agg(F.count(F.lit(1)).alias("_n"))
    scanned = _by_runs(values, keys, [order], {
        "_below": running_sum("_n", before=True),
        "dense_rank": running_count(),
    }, rows, run_rows)
    sizes = values.groupBy(*keys).agg(F.sum("_n").alias("_size"))
    scanned = null_safe_join(scanned, sizes, keys, "inner", small=True)
    numbered = _by_runs(df, keys, [order, tie], {"row_number": running_count()}, rows, run_rows)
    joined = null_safe_join(numbered, scanned, [*keys, order], "inner")
    size, below, number = F.col("_size"), F.col("_below"), F.col("row_number")
    short, extra = F.floor(size / tiles), size % tiles
    wide = extra * (short + 1)
    tile = F.when(number <= wide, F.ceil(number / (short + 1))).otherwise(
        extra + F.ceil((number - wide) / F.greatest(short, F.lit(1))))
    return joined.select(
        *df.columns,
        number, (below + 1).cast("long").alias("rank"), F.col("dense_rank"),
        F.when(size > 1, below / (size - 1)).otherwise(F.lit(0.0)).alias("percent_rank"),
        ((below + F.col("_n")) / size).alias("cume_dist"),
        tile.cast("long").alias("tile"),
    )
