import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from paddock.operators import intervals

START = dt.datetime(2024, 1, 1)


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(5)
    rows = [(1 if i % 3 == 0 else rng.randint(2, 9), at(rng.randint(0, 4000)), i, rng.choice("abc")) for i in range(600)]
    return spark.createDataFrame(rows, "user_id long, ts timestamp, event_id long, event_type string").cache()


@pytest.mark.parametrize("group_rows", [10_000, 40])
def test_count_within_equals_brute_force(events, group_rows):
    points, marks = events.where("event_type <> 'a'"), events.where("event_type = 'a'")
    got = {r.event_id: r.n for r in intervals.count_within(
        points, marks, ["user_id"], "ts", "event_id", "60 SECONDS", "30 SECONDS", "n", group_rows).collect()}
    all_rows = events.collect()
    for p in all_rows:
        if p.event_type != "a":
            want = sum(m.event_type == "a" and m.user_id == p.user_id and
                       p.ts - dt.timedelta(seconds=60) <= m.ts <= p.ts + dt.timedelta(seconds=30) for m in all_rows)
            assert got[p.event_id] == want


@pytest.mark.parametrize("group_rows", [10_000, 40])
def test_as_of_join_equals_brute_force(events, group_rows):
    left = events.where("event_type = 'b'").select("event_id", "user_id", "ts")
    right = events.where("event_type = 'a'").select("user_id", "ts", F.col("event_id").alias("mark"))
    got = {r.event_id: r.mark for r in intervals.as_of_join(left, right, ["user_id"], "ts", ["mark"], group_rows).collect()}
    marks = right.collect()
    for row in left.collect():
        before = [(m.ts, m.mark) for m in marks if m.user_id == row.user_id and m.ts <= row.ts]
        assert got[row.event_id] == (max(before)[1] if before else None)


def test_count_below_equals_brute_force(spark):
    a = spark.createDataFrame([(i, float(i % 7)) for i in range(40)], "k long, v double")
    b = spark.createDataFrame([(float(i % 5),) for i in range(30)], "w double")
    for limit in (10, 10_000):
        got = {r.k: r.n for r in intervals.count_below(a, b, F.col("v"), F.col("w"), "k", "n", limit).collect()}
        assert got == {i: sum(1 for j in range(30) if j % 5 < i % 7) for i in range(40)}


GOLDEN = [("user1", 13, "NEW"), ("user1", 10, "NEW"), ("user1", 15, "CLOSE"), ("user1", 17, "NEW"), ("user1", 19, "NEW"),
          ("user1", 29, "NEW"), ("user2", 45, "NEW"), ("user1", 65, "NEW")]


@pytest.mark.parametrize("group_rows", [10_000, 2])
def test_closed_sessions_golden(spark, group_rows):
    rows = [(u, at(s), i, k) for i, (u, s, k) in enumerate(GOLDEN)]
    df = spark.createDataFrame(rows, "user string, ts timestamp, id int, kind string")
    found = intervals.closed_sessions(df, "user", "ts", "id", F.col("kind") == "CLOSE", 5, group_rows)
    assert sorted((r.user, r.duration_ms, r.n_events) for r in found.collect()) == [
        ("user1", 5000, 1), ("user1", 5000, 1), ("user1", 5000, 3), ("user1", 7000, 2), ("user2", 5000, 1)]


def test_gap_sessions(spark):
    df = spark.createDataFrame([("a", at(0)), ("a", at(5)), ("a", at(20)), ("b", at(3))], "k string, ts timestamp")
    found = intervals.sessions(df, "k", "ts", "10 seconds")
    assert sorted((r.k, r.n_events, (r.end - r.start).seconds) for r in found.collect()) == [("a", 1, 10), ("a", 2, 15), ("b", 1, 10)]


@pytest.mark.parametrize("group_rows", [10_000, 3])
def test_equal_points_missing_times_and_any_names(spark, group_rows):
    schema = "user_id long, ts timestamp, e int, _n int, _point string, _at int"
    points = [(1, at(10), 1, 1, "x", 1), (1, at(10), 1, 1, "x", 1), (1, at(10), 2, 1, "x", 1), (1, None, 1, 1, "x", 1), (2, at(10), 1, 1, None, 1)]
    marks = [(1, at(s) if s is not None else None, s, 0, "m", 0) for s in (5, 10, 10, 20, None, None)]
    found = intervals.count_within(spark.createDataFrame(points, schema), spark.createDataFrame(marks, schema), ["user_id"], "ts", "e",
                                   "5 SECONDS", "5 SECONDS", "found", group_rows)
    assert found.columns == ["user_id", "ts", "e", "_n", "_point", "_at", "found"]
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, found.collect()), key=key) == sorted(
        [(*p, 3 if p[0] == 1 and p[1] else 0) for p in points], key=key)


@pytest.mark.parametrize("limit", [2, 10_000])
def test_missing_marks_are_below_nothing(spark, limit):
    nan = float("nan")
    points = spark.createDataFrame([(1, 5.0), (1, 5.0), (2, None), (3, nan), (4, 0.0), (None, 10.0)], "_v long, v double")
    marks = spark.createDataFrame([(1.0,), (None,), (9.0,), (nan,), (5.0,), (None,)], "w double")
    got = intervals.count_below(points, marks, F.col("v"), F.col("w"), "_v", "_side", limit)
    assert got.columns == ["_v", "_side"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(["(1, 1)", "(1, 1)", "(2, 0)", "(3, 3)", "(4, 0)", "(None, 3)"])


@pytest.mark.parametrize("group_rows", [10_000, 3])
def test_as_of_with_ties_repeats_and_missing_times(spark, group_rows):
    left = spark.createDataFrame([(1, at(5), "a")] * 7 + [(1, None, "b"), (1, at(4), "c"), (None, at(9), "d")], "k long, ts timestamp, _nth string")
    right = spark.createDataFrame([(1, at(5), 1), (1, at(5), 3), (1, at(5), 2), (1, None, 9), (None, at(1), 7)], "k long, ts timestamp, v int")
    got = intervals.as_of_join(left, right, ["k"], "ts", ["v"], group_rows).collect()
    assert sorted((r._nth, r.v) for r in got if r.v is not None) == [("a", 3)] * 7 + [("d", 7)]
    assert sorted(r._nth for r in got if r.v is None) == ["b", "c"]
