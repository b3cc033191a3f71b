"""Time windows, sessions, as-of joins and skewed groups."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from paddock.functions.columns import age_in_days
from paddock.operators import intervals
from paddock.queries.registry import query


@query("b26_tumbling_window", """
    SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2""")
def _(t):
    return t.events.groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total")).select(
        F.col("w.start").alias("start"), "event_type", "n", "total")


_SLIDING = """
    SELECT time_bucket(INTERVAL 6 HOURS, ts, TIMESTAMP '1970-01-01') - i * INTERVAL 6 HOURS AS start, event_type, count(*) AS n
    FROM events, range(0, 4) r(i) GROUP BY 1, 2"""


@query("e17_sliding_window", _SLIDING)
def _(t):
    return sliding_counts(t.events, "1 day", "6 hours")


def sliding_counts(events, size: str, slide: str | None = None):
    """Events per type in windows that may overlap; the slide defaults to the size."""
    window = F.window("ts", size, slide or size)
    return events.groupBy(window.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("w.start").alias("start"), "event_type", "n")


_SESSIONS = """
    WITH s AS (SELECT *, CASE WHEN ts >= lag(ts) OVER w + INTERVAL 2 HOURS OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS new
               FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    n AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM s)
    SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 2 HOURS AS "end", count(*) AS n_events,
      round((epoch_us(max(ts) + INTERVAL 2 HOURS) - epoch_us(min(ts))) / 1000000.0, 3) AS duration_s FROM n GROUP BY user_id, k"""


@query("e18_session_windows", _SESSIONS)
def _(t):
    events = t.events.select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    found = intervals.sessions(events, "user_id", "ts", "2 hours")
    duration = (F.unix_micros("end") - F.unix_micros("start")) / F.lit(1000000.0)
    return found.select("user_id", F.col("start").cast("timestamp_ntz").alias("start"),
                        F.col("end").cast("timestamp_ntz").alias("end"), "n_events", F.round(duration, 3).alias("duration_s"))


_CLOSED = """
    WITH p AS (SELECT *, lag(ts) OVER w AS pt, lag(event_type) OVER w AS pe FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    s AS (SELECT *, CASE WHEN pt IS NULL OR pe = 'signup' OR ts >= pt + INTERVAL 6 HOURS THEN 1 ELSE 0 END AS new FROM p),
    n AS (SELECT *, CAST(sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS session FROM s),
    g AS (SELECT user_id, session, min(ts) AS start, max(ts) AS last, max(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS closed,
          count(*) AS n_events FROM n GROUP BY 1, 2)
    SELECT user_id, session, n_events, (epoch_us(CASE WHEN closed = 1 THEN last ELSE last + INTERVAL 6 HOURS END) - epoch_us(start)) // 1000 AS duration_ms FROM g"""


def _closed(t, group_rows):
    events = t.events.select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_id", "event_type")
    found = intervals.closed_sessions(events, "user_id", "ts", "event_id", F.col("event_type") == "signup", 6 * 3600, group_rows)
    return found.select("user_id", "session", "n_events", "duration_ms")


@query("e19_closed_sessions", _CLOSED)
def _(t):
    """Sessions ended by a signup or six idle hours."""
    return _closed(t, intervals.GROUP_ROWS)


@query("e19_closed_sessions_hot_keys", _CLOSED)
def _(t):
    """The same with users of more than 70 events treated as hot keys."""
    return _closed(t, 70)


_AS_OF = """
    WITH l AS (SELECT * FROM events WHERE event_type = 'click'), r AS (SELECT * FROM events WHERE event_type = 'purchase')
    SELECT l.event_id, l.user_id, r.value AS last_value, r.event_id AS purchase_id
    FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts >= r.ts"""


def _as_of(t, group_rows):
    events = t.events
    clicks = events.where("event_type = 'click'").select("event_id", "user_id", "ts")
    buys = events.where("event_type = 'purchase'").select(
        "user_id", "ts", F.col("value").alias("last_value"), F.col("event_id").alias("purchase_id"))
    found = intervals.as_of_join(clicks, buys, ["user_id"], "ts", ["last_value", "purchase_id"], group_rows)
    return found.drop("ts")


@query("e33_as_of_join", _AS_OF)
def _(t):
    """Each click with the latest purchase of its user."""
    return _as_of(t, intervals.GROUP_ROWS)


@query("e33_as_of_join_hot_keys", _AS_OF)
def _(t):
    """The same with users of more than 30 rows treated as hot keys."""
    return _as_of(t, 30)


@query("e15_skewed_group", """
    WITH s AS (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_orderkey END AS k, * FROM lineitem)
    SELECT k, count(*) AS n, round(sum(l_quantity), 2) AS qty, min(l_extendedprice) AS low, max(l_extendedprice) AS high,
      count(DISTINCT l_partkey) AS n_parts FROM s GROUP BY 1""")
def _(t):
    """A third of the lines share one key.

    Sums are added up in the map tasks and the distinct parts are made distinct
    before a key's rows meet, so the hot key ships few rows and needs no salt.
    """
    skewed = t.lineitem.withColumn("k", F.when(F.col("l_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_orderkey")))
    return skewed.groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"), F.min("l_extendedprice").alias("low"),
        F.max("l_extendedprice").alias("high"), F.countDistinct("l_partkey").alias("n_parts"))


@query("e43_age_in_days", """
    SELECT o_orderkey, datediff('day', CAST(o_orderdate AS DATE), DATE '2022-12-31') AS age_days FROM orders""")
def _(t):
    return t.orders.select("o_orderkey", age_in_days(F.col("o_orderdate"), date(2022, 12, 31)).cast("long").alias("age_days"))
