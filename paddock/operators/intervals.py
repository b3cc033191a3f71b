"""As-of joins, interval counts and session grouping on ordered events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.operators.hot import GROUP_ROWS, hot_keys
from paddock.operators.scan import latest, running, running_count, running_sum


def as_of_join(left: DataFrame, right: DataFrame, keys: list[str], time: str, values: list[str],
               group_rows: int = GROUP_ROWS) -> DataFrame:
    """Left rows with the values of the latest right row at or before their time.

    Both sides go through one ordered scan per key, so no pair of rows is formed.
    Of right rows at the same time the one with the greatest values is taken; right
    rows without a time are never the latest, and left rows without one get nothing.
    """
    packed = F.struct(*values)
    right_rows = right.where(F.col(time).isNotNull()).select(
        *keys, F.col(time), packed.alias("_right"), F.lit(0).alias("_side"),
        F.lit(None).cast(left.select(F.struct("*")).schema[0].dataType).alias("_left"), F.lit(0).cast("long").alias("_nth"))
    # A number of its own lets left rows with one key and time go to different runs.
    left_rows = left.select(*keys, F.col(time), F.lit(None).cast(right.select(packed).schema[0].dataType).alias("_right"),
                            F.lit(1).alias("_side"), F.struct("*").alias("_left"), F.monotonically_increasing_id().alias("_nth"))
    both = right_rows.unionByName(left_rows)
    scanned = running(both, keys, [time, "_side", "_right", "_nth"], {"_seen": latest("_right")}, group_rows)
    return scanned.where(F.col("_side") == 1).select("_left.*", *[F.col("_seen")[v].alias(v) for v in values])


def count_within(points: DataFrame, marks: DataFrame, keys: list[str], time: str, tie: str, before: str,
                 after: str, name: str, group_rows: int = GROUP_ROWS) -> DataFrame:
    """For every point the number of marks of its key in [time-before, time+after].

    The count is the difference of two running counts: marks up to the upper end
    minus marks before the lower end. Nothing is joined pairwise. Equal points are
    counted once and come back as often as they were; marks without a time are in
    no interval, and a point without a time has none. Columns may have any names.
    """
    own = [f"_key{i}" for i in range(len(keys))]
    lower = F.col(time) - F.expr(f"INTERVAL {before}")
    upper = F.col(time) + F.expr(f"INTERVAL {after}")
    ends = F.array(F.struct(lower.alias("at"), F.lit(0).alias("side")), F.struct(upper.alias("at"), F.lit(2).alias("side")))
    at_keys = [F.col(k).alias(o) for k, o in zip(keys, own)]
    probes = points.select(*at_keys, F.struct("*").alias("_point"), F.explode(ends).alias("_end")).select(
        *own, "_point", F.col("_end.at").alias("_at"), F.col("_end.side").alias("_side"))
    hits = marks.where(F.col(time).isNotNull()).select(
        *at_keys, F.col(tie).alias("_tie"), F.col(time).alias("_at"), F.lit(1).alias("_side"), F.lit(1).alias("_mark"))
    both = probes.unionByName(hits, allowMissingColumns=True)
    scanned = running(both, own, ["_at", "_side", "_tie"], {"_n": running_count("_mark")}, group_rows)
    signed = F.when(F.col("_side") == 2, F.col("_n")).otherwise(-F.col("_n"))
    # The keys are among the grouping columns, so the scan's partitioning is used again.
    counted = scanned.where(F.col("_side") != 1).groupBy(*own, "_point").agg(
        F.sum(signed).alias("_sum"), F.expr("count(1) div 2").alias("_rows"))
    return counted.select("_point", F.expr("_sum div _rows").alias("_n"), F.explode(F.expr("array_repeat(0, cast(_rows AS INT))"))).select(
        "_point.*", F.col("_n").alias(name))


def count_below(points: DataFrame, marks: DataFrame, point: Column, mark: Column, key: str, name: str,
                rows_limit: int | None = None) -> DataFrame:
    """For every point the number of marks with a smaller value.

    This is the inequality join followed by a count, done as one ordered scan. A
    missing mark is below nothing and nothing is below a missing point; NaN is
    above every number and not below itself.
    """
    probes = points.select(F.col(key).alias("_key"), point.alias("_v"), F.lit(0).alias("_side"))
    hits = marks.select(F.lit(None).cast(points.schema[key].dataType).alias("_key"), mark.alias("_v"),
                        F.lit(1).alias("_side")).where("_v IS NOT NULL")
    both = probes.unionByName(hits)
    scanned = running(both, [], ["_v", "_side", "_key"], {"_n": _sides()}, rows_limit)
    return scanned.where(F.col("_side") == 0).select(F.col("_key").alias(key), F.col("_n").alias(name))


def _sides():
    return running_sum("_side", before=True)


def sessions(df: DataFrame, key: str, time: str, gap: str) -> DataFrame:
    """Gap sessions per key: start, end (last event plus gap) and number of events."""
    return df.groupBy(key, F.session_window(time, gap).alias("s")).agg(F.count(F.lit(1)).alias("n_events")).select(
        key, F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n_events")


def closed_sessions(df: DataFrame, key: str, time: str, tie: str, closes: Column, gap_seconds: int,
                    group_rows: int = GROUP_ROWS) -> DataFrame:
    """Sessions per key that end with a closing event or after a gap.

    Returns (key, session, start, end, n_events, duration_ms). A session ended by
    a closing event ends there, any other one a gap after its last event.
    """
    marked = df.select(key, time, tie, closes.cast("int").alias("_close"))
    # Both facts about the row before travel in one value.
    marked = marked.withColumn("_here", F.struct(F.col(time).alias("t"), F.col("_close").alias("c")))
    hot = hot_keys(df.select(key), [key], group_rows)
    seen = running(marked, [key], [time, tie], {"_prev": latest("_here", before=True)}, hot=hot)
    pause = F.unix_micros(F.col(time)) - F.unix_micros(F.col("_prev")["t"])
    starts = F.col("_prev").isNull() | (F.col("_prev")["c"] == 1) | (pause >= gap_seconds * 1_000_000)
    seen = seen.select(key, time, tie, "_close", F.coalesce(starts, F.lit(True)).cast("int").alias("_start"))
    numbered = running(seen, [key], [time, tie], {"session": running_sum("_start")}, hot=hot)
    grouped = numbered.groupBy(key, "session").agg(
        F.min(time).alias("start"), F.max(time).alias("_last"), F.max("_close").alias("_closed"),
        F.count(F.lit(1)).alias("n_events"))
    end = F.when(F.col("_closed") == 1, F.col("_last")).otherwise(
        F.timestamp_micros(F.unix_micros("_last") + gap_seconds * 1_000_000))
    out = grouped.withColumn("end", end)
    duration = (F.unix_micros("end") - F.unix_micros("start")) / 1000
    return out.select(key, F.col("session").cast("long").alias("session"), "start", "end", "n_events",
                      F.floor(duration).cast("long").alias("duration_ms"))
