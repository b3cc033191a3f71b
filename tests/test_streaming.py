"""Streams over several files: same result as the batch, also after a restart."""

import datetime as dt
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from paddock.session import workspace
from paddock.streaming import jobs

START = dt.datetime(2024, 1, 1)


def land(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


TEXT = "text string"
TEXTS = [[("a b a",), ("the c",)], [("a  c",)], [("the the b",)]]


def folder_of_texts(spark, parts):
    path = workspace(spark, "texts")
    for part in parts:
        land(spark, path, part, TEXT)
    return path


def counts(df):
    return {r.word: r.n for r in df.collect()}


def test_complete_word_count_over_several_batches(spark):
    path = folder_of_texts(spark, TEXTS)
    stream = jobs.file_stream(spark, path, files_per_batch=1)
    assert counts(jobs.drain_complete(jobs.word_counts(stream))) == counts(jobs.word_counts(spark.read.parquet(path)))


def test_restart_goes_on_where_it_stopped(spark):
    path, out, state = folder_of_texts(spark, TEXTS[:2]), workspace(spark, "out"), workspace(spark, "state")

    def run():
        return jobs.drain_batches(jobs.word_counts(jobs.file_stream(spark, path)), lambda b: b, "complete", out, state)[1]

    first = run()
    land(spark, path, TEXTS[2], TEXT)
    second = run()
    assert second and min(second) > max(first)
    result = spark.read.parquet(f"{out}/batch={max(second)}")
    assert counts(result) == counts(jobs.word_counts(spark.read.parquet(path)))
    assert run() == [] or counts(spark.read.parquet(f"{out}/batch={max(second)}")) == counts(result)


def test_batches_are_replaced_not_doubled(spark):
    path, out = folder_of_texts(spark, TEXTS), workspace(spark, "out")
    for _ in range(2):  # a new state folder reads all input again under the same batch ids
        jobs.drain_all(jobs.file_stream(spark, path, files_per_batch=1), lambda b: b, out=out)
    assert spark.read.parquet(out).count() == 4


# The worked example of sessions, events in and sessions out.
EVENTS = "user_id long, ts timestamp, event_type string"


def event(user, second, kind="NEW"):
    return (user, START + dt.timedelta(seconds=second), kind)


def session_result(spark, parts):
    path = workspace(spark, "events")
    for part in parts:
        land(spark, path, part, EVENTS)
    stream = jobs.file_stream(spark, path, files_per_batch=1)
    found = jobs.drain_append(jobs.session_stream(stream, "CLOSE", 5, "10 seconds"))
    return sorted((r.user_id, r.duration_ms, r.n_events) for r in found.collect())


GOLDEN = [event(1, 13), event(1, 10), event(1, 15, "CLOSE"), event(1, 17), event(1, 19), event(1, 29), event(2, 45), event(1, 65)]
GOLDEN_OUT = [(1, 5000, 1), (1, 5000, 3), (1, 7000, 2), (2, 5000, 1)]


@pytest.mark.parametrize("cut", [[8], [3, 5], [1, 1, 1, 1, 1, 1, 1, 1]])
def test_session_golden_in_any_batches(spark, cut):
    parts, rest = [], list(GOLDEN)
    for n in cut:
        parts.append(rest[:n])
        rest = rest[n:]
    assert session_result(spark, parts) == GOLDEN_OUT


def test_late_rows_inside_the_watermark_split_a_session(spark):
    # The closing event at 12 arrives after the events around it.
    parts = [[event(1, 10), event(1, 14)], [event(1, 12, "CLOSE")], [event(1, 100)]]
    assert session_result(spark, parts) == [(1, 2000, 2), (1, 5000, 1)]


def test_watermark_drops_rows_that_are_too_late(spark):
    path = workspace(spark, "late")
    # Rows are late by the watermark of the batch before, so one batch lies between.
    for part in ([event(1, 0)], [event(1, 7200)], [event(1, 7205)], [event(1, 1)], [event(1, 14400)]):
        land(spark, path, part, EVENTS)
    stream = jobs.file_stream(spark, path, files_per_batch=1)
    closed = jobs.drain_append(jobs.windowed_counts(stream, "event_type", "1 hour", late="10 minutes"))
    assert sorted((r.start.hour, r.n) for r in closed.collect()) == [(0, 1), (2, 2)]


def test_streaming_sessions_equal_batch(spark):
    path = workspace(spark, "sessions")
    for part in ([event(1, 0), event(2, 3)], [event(1, 8)], [event(1, 30), event(2, 4)]):
        land(spark, path, part, EVENTS)

    def grouped(df):
        window = F.session_window("ts", "10 seconds").alias("w")
        return df.groupBy(window, "user_id").agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("w.start").alias("start"), "n")

    streamed = jobs.drain_complete(grouped(jobs.file_stream(spark, path, files_per_batch=1)))
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, grouped(spark.read.parquet(path)).collect()))


def test_restart_without_new_input_gives_the_last_result(spark):
    path, out, state = (workspace(spark, n) for n in ("words", "out", "state"))

    def run():
        counts = jobs.word_counts(jobs.file_stream(spark, path, "text string", files_per_batch=1))
        return {r["word"]: r["n"] for r in jobs.drain_complete(counts, out=out, state=state).collect()}

    land(spark, path, [("a b a",)], "text string")
    land(spark, path, [("b",)], "text string")
    assert run() == {"a": 2, "b": 2}
    assert run() == {"a": 2, "b": 2}
    land(spark, path, [("c",)], "text string")
    assert run() == {"a": 2, "b": 2, "c": 1}


def test_sessions_go_on_after_a_restart(spark):
    path, out, state = (workspace(spark, n) for n in ("events", "out", "state"))

    def run():
        stream = jobs.file_stream(spark, path, EVENTS, files_per_batch=1)
        found = jobs.drain_append(jobs.session_stream(stream, "CLOSE", 5, "10 seconds"), out, state)
        return sorted((r.user_id, r.duration_ms, r.n_events) for r in found.collect())

    land(spark, path, GOLDEN[:4], EVENTS)
    assert run() == []
    land(spark, path, GOLDEN[4:7], EVENTS)
    assert run() == [(1, 5000, 1), (1, 5000, 3), (1, 7000, 2)]
    land(spark, path, GOLDEN[7:], EVENTS)
    assert run() == GOLDEN_OUT


def test_the_state_of_sessions_holds_open_ones_only(spark):
    path, state = workspace(spark, "events"), workspace(spark, "state")
    # Users come and go; one user's events of a minute are all settled by the next.
    for minute in range(6):
        land(spark, path, [event(user, minute * 60 + k) for user in range(minute * 3, minute * 3 + 3) for k in range(20)], EVENTS)
    jobs.drain_append(jobs.session_stream(jobs.file_stream(spark, path, files_per_batch=1), "CLOSE", 5, "10 seconds"), state=state)
    ahead = spark.read.format("statestore").option("stateVarName", "ahead").option("flattenCollectionTypes", True).load(state)
    # The last minute is ahead of the watermark but for its first seconds; nothing is left of the others.
    assert {r.key.user_id for r in ahead.select("key").collect()} == {15, 16, 17}
    assert {r.user_id: r.n for r in jobs.stored_state(spark, state, "prefix").collect()} == {15: 9, 16: 9, 17: 9}


def test_totals_start_with_the_given_ones_once(spark):
    path, state = workspace(spark, "texts"), workspace(spark, "state")
    initial = spark.createDataFrame([("a", 10), ("z", 5), ("z", 1), (None, 2)], "word string, n long")

    def run():
        totals = jobs.running_totals(jobs.file_stream(spark, path, TEXT, files_per_batch=1), initial)
        jobs.drain_batches(totals, lambda b: b, "update", state=state)
        return {r.word: r.n for r in jobs.stored_state(spark, state, "total").collect()}

    land(spark, path, [("a b a",), (None,)], TEXT)
    land(spark, path, [("a",)], TEXT)
    assert run() == {"a": 13, "b": 1, "z": 6, None: 2}
    land(spark, path, [("z z",)], TEXT)
    assert run() == {"a": 13, "b": 1, "z": 8, None: 2}


def test_repeats_within_the_watermark_go_and_leave_the_state(spark):
    path, state = workspace(spark, "events"), workspace(spark, "state")
    parts = [[event(1, 0), event(1, 0), event(2, 5)], [event(1, 0), event(3, 60)], [event(4, 600)], [event(1, 0), event(4, 600)], [event(5, 700)]]
    for part in parts:
        land(spark, path, part, EVENTS)
    stream = jobs.file_stream(spark, path, EVENTS, files_per_batch=1)
    found = jobs.drain_append(jobs.once_within(stream, ["user_id"], "30 seconds"), state=state)
    # The late repeat of user 1 is dropped as late, though its entry has left the state.
    assert sorted(r.user_id for r in found.collect()) == [1, 2, 3, 4, 5]
    left = spark.read.format("statestore").load(state)
    assert {r.key.user_id for r in left.select("key").collect()} == {5}


def test_words_are_counted_over_all_batches_of_a_task(monkeypatch):
    batches = [pa.RecordBatch.from_pydict({"word": pa.array(w, pa.string())}) for w in (["a", "b", "a"], [], ["a", None], ["c", None, "a"])]

    def counted():
        return [(r["word"], r["n"]) for b in jobs._counted(iter(batches)) for r in b.to_pylist()]

    assert sorted(counted(), key=str) == [("a", 4), ("b", 1), ("c", 1), (None, 2)]
    assert list(jobs._counted(iter(()))) == []
    # What is held is passed on when it is much, and nothing is lost by it.
    monkeypatch.setattr(jobs, "HELD_WORDS", 2)
    total = Counter()
    for word, n in counted():
        total[word] += n
    assert total == {"a": 4, "b": 1, "c": 1, None: 2}
