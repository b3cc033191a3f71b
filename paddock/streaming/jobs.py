"""Streams over landed files: sources, sinks and the stateful session job.

Results go to files in the shared folder, one folder per micro-batch where a
batch function writes them, so a batch that is run again replaces its own output.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from paddock.session import workspace


def file_stream(spark: SparkSession, path: str, schema=None, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files at ``path``, a folder or a single file, as a stream."""
    schema = schema if schema is not None else spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # The file source takes a single file only when it is named by a pattern.
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def drain_append(stream: DataFrame, out: str | None = None, state: str | None = None) -> DataFrame:
    """Run to the end of the input in append mode; the result is the file sink's table."""
    spark = stream.sparkSession
    out, state = out or workspace(spark, "sink"), state or workspace(spark, "state")
    run = (stream.writeStream.outputMode("append").format("parquet").option("path", out)
           .option("checkpointLocation", state).trigger(availableNow=True).start())
    run.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def drain_batches(stream: DataFrame, each: Callable[[DataFrame], DataFrame], mode: str = "append",
                  out: str | None = None, state: str | None = None) -> tuple[str, list[int]]:
    """Run to the end and write ``each(batch)`` below ``out`` in one folder per batch id."""
    spark = stream.sparkSession
    out, state = out or workspace(spark, "batches"), state or workspace(spark, "state")
    seen: list[int] = []

    def write(batch: DataFrame, number: int) -> None:
        each(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")
        seen.append(number)

    run = (stream.writeStream.outputMode(mode).option("checkpointLocation", state)
           .foreachBatch(write).trigger(availableNow=True).start())
    run.awaitTermination()
    return out, seen


def drain_complete(stream: DataFrame, each: Callable[[DataFrame], DataFrame] = lambda batch: batch,
                   out: str | None = None, state: str | None = None) -> DataFrame:
    """Run to the end in complete mode; the result is what the last batch wrote.

    A restart that finds no new input runs no batch, and the last one is that of
    an earlier run. Without any input at all the result is that of no rows.
    """
    spark = stream.sparkSession
    out, seen = drain_batches(stream, each, "complete", out, state)
    if seen:
        return spark.read.parquet(f"{out}/batch={max(seen)}")
    try:
        written = spark.read.parquet(out)
    except AnalysisException:
        return each(spark.createDataFrame([], stream.schema))
    newest = written.agg(F.max("batch")).first()[0]
    return written.where(F.col("batch") == newest).drop("batch")


def drain_all(stream: DataFrame, each: Callable[[DataFrame], DataFrame], **kwargs) -> DataFrame:
    """Run to the end in append mode; the result has the rows of all batches."""
    out, _ = drain_batches(stream, each, "append", **kwargs)
    return stream.sparkSession.read.parquet(out)


def word_counts(texts: DataFrame, column: str = "text") -> DataFrame:
    words = texts.select(F.explode(F.split(column, " ")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def windowed_counts(events: DataFrame, key: str, size: str, slide: str | None = None,
                    late: str | None = None) -> DataFrame:
    """Counts per key and window; with ``late`` older rows are dropped and windows close."""
    if late is not None:
        events = events.withWatermark("ts", late)
    window = F.window("ts", size, slide or size).alias("w")
    counted = events.groupBy(window, key).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "n")


SESSION_OUT = "user_id long, session_start long, n_events long, duration_ms long"


class Sessions(StatefulProcessor):
    """Sessions that end with a closing event or after ``gap`` microseconds, per key.

    Events behind the watermark can get no earlier neighbours any more, so they are
    kept as one prefix (start, last, count) in a value; events ahead of the watermark
    are a list, which input only appends to. So the state of a key holds what may
    still come in another order, and no more. One event-time timer per key wakes it
    when the watermark has passed its first open event or the end of its prefix; a
    key without events has no state left.
    """

    def __init__(self, gap: int):
        self.gap = gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.prefix = handle.getValueState("prefix", "start long, last long, n long")
        self.ahead = handle.getListState("ahead", "at long, closes boolean")
        self.timer = handle.getValueState("timer", "at long")

    def _wake(self, at: int | None) -> None:
        """The one timer of this key: at ``at`` milliseconds, or none."""
        old = self.timer.get()[0] if self.timer.exists() else None
        if old == at:
            return
        if old is not None:
            self.handle.deleteTimer(old)
        if at is None:
            self.timer.clear()
        else:
            self.handle.registerTimer(at)
            self.timer.update((at,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        events = [(r["at"], r["closes"]) for r in rows]
        self.ahead.appendList(events)
        # Not before the watermark has passed the first of them.
        first = min(events)[0] // 1000 + 1
        if not self.timer.exists() or first < self.timer.get()[0]:
            self._wake(first)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # The expired timer is gone; the state must not point to it.
        self.timer.clear()
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        start, last, n = self.prefix.get() if self.prefix.exists() else (None, None, 0)
        events = sorted(tuple(e) for e in self.ahead.get()) if self.ahead.exists() else []
        settled = 0
        for at, closes in events:
            if n and at >= last + self.gap:
                if last + self.gap >= watermark:
                    break
                yield self._session(key, start, n, last + self.gap)
                n = 0
            if at >= watermark:
                break
            start, last, n = (at if n == 0 else start), at, n + 1
            settled += 1
            if closes:
                yield self._session(key, start, n, at)
                n = 0
        if n and settled == len(events) and last + self.gap < watermark:
            yield self._session(key, start, n, last + self.gap)
            n = 0
        if settled:
            self.ahead.put(events[settled:]) if events[settled:] else self.ahead.clear()
        self.prefix.update((start, last, n)) if n else self.prefix.clear()
        due = [last + self.gap] * bool(n) + [e[0] for e in events[settled:settled + 1]]
        self._wake(max(min(due), watermark) // 1000 + 1 if due else None)

    @staticmethod
    def _session(key, start: int, n: int, end: int) -> Row:
        return Row(user_id=key[0], session_start=start, n_events=n, duration_ms=(end - start) // 1000)


def session_stream(events: DataFrame, closing: str, gap_seconds: int, late: str) -> DataFrame:
    """Sessions per user from a stream of (user_id, ts, event_type), in append mode."""
    marked = events.withWatermark("ts", late).select(
        "user_id", "ts", F.unix_micros("ts").alias("at"), (F.col("event_type") == closing).alias("closes"))
    return marked.groupBy("user_id").transformWithState(Sessions(gap_seconds * 1_000_000), SESSION_OUT, "Append", "EventTime")


class Totals(StatefulProcessor):
    """Running totals per word; the state starts with given totals."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "n long")

    def _add(self, n: int) -> int:
        n += self.total.get()[0] if self.total.exists() else 0
        self.total.update((n,))
        return n

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._add(initialState["n"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        yield Row(word=key[0], n=self._add(sum(r["n"] for r in rows)))


# Different words a task counts before it passes them on, and words of a batch it passes on.
HELD_WORDS, OUT_WORDS = 500_000, 10_000


def _added_up(held: pa.Table | None, fresh: list[pa.Table]) -> pa.Table:
    """One row (word, n) per word."""
    both = pa.concat_tables(fresh if held is None else [held, *fresh])
    return both.group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) of the words of all batches of a task."""
    held, fresh, rows = None, [], 0
    for batch in batches:
        found = pc.value_counts(batch.column(0))
        fresh.append(pa.table([found.field("values"), found.field("counts")], names=["word", "n"]))
        rows += len(found)
        if rows >= HELD_WORDS:
            held = _added_up(held, fresh)
            fresh, rows = [], 0
            if held.num_rows >= HELD_WORDS:
                yield from held.to_batches(OUT_WORDS)
                held = None
    if held is not None or fresh:
        yield from _added_up(held, fresh).to_batches(OUT_WORDS)


def running_totals(texts: DataFrame, initial: DataFrame, column: str = "text") -> DataFrame:
    """(word, n) of every word a batch has changed, from a stream of texts and a frame of (word, n) to start with.

    Words are counted per task before they are dealt, and a task passes its counts
    on at the end, or when it holds ``HELD_WORDS`` of them: a word reaches its
    state as about one count per task, however many texts there are.
    """
    words = texts.select(F.explode(F.split(column, " ")).alias("word")).mapInArrow(_counted, "word string, n long")
    start = initial.groupBy("word").agg(F.sum("n").alias("n"))
    return words.groupBy("word").transformWithState(Totals(), "word string, n long", "Update", "None", start.groupBy("word"))


def stored_state(spark: SparkSession, state: str, variable: str) -> DataFrame:
    """(key columns, value columns) of a state variable, as the last batch left it, read from the stream's state folder."""
    stored = spark.read.format("statestore").option("stateVarName", variable).load(state)
    return stored.select("key.*", "value.*")


def once_within(events: DataFrame, keys: list[str], late: str) -> DataFrame:
    """Events without repeats that come within ``late`` of the first; what the watermark has passed leaves the state."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)
