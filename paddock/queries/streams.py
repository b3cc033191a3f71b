"""Streams over the given tables, run to their end and compared with the batch result."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from paddock.queries.registry import query
from paddock.session import workspace
from paddock.streaming import jobs

# A small lexicon of scored words, and the words a count leaves out.
LEXICON = (("the", 1), ("that", -1), ("was", -2), ("with", 3), ("from", 2), ("not", -3), ("und", 1), ("que", 2))
EXCLUDED = ("the", "of", "and", "to")


def _stream(t, name):
    return jobs.file_stream(t.spark, t.path(name))


def _events(t):
    return _stream(t, "events").withColumn("ts", F.col("ts").cast("timestamp"))


_WORDS = "SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM {}) GROUP BY 1"


@query("e16_streaming_word_count", _WORDS.format("documents"))
def _(t):
    return jobs.drain_complete(jobs.word_counts(_stream(t, "documents")))


@query("e17_streaming_windows", """
    SELECT time_bucket(INTERVAL 6 HOURS, ts, TIMESTAMP '1970-01-01') - i * INTERVAL 6 HOURS AS start, event_type, count(*) AS n
    FROM events, range(0, 4) r(i) GROUP BY 1, 2""")
def _(t):
    counts = jobs.drain_complete(jobs.windowed_counts(_events(t), "event_type", "1 day", "6 hours"))
    return counts.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("e18_streaming_sessions", """
    WITH s AS (SELECT *, CASE WHEN ts >= lag(ts) OVER w + INTERVAL 2 HOURS OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS new
               FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    n AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM s)
    SELECT user_id, min(ts) AS start, count(*) AS n_events FROM n GROUP BY user_id, k""")
def _(t):
    window = F.session_window("ts", "2 hours").alias("w")
    found = _events(t).groupBy(window, "user_id").agg(F.count(F.lit(1)).alias("n_events"))
    out = jobs.drain_complete(found.select("user_id", F.col("w.start").alias("start"), "n_events"))
    return out.withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("e19_streaming_closed_sessions", """
    WITH p AS (SELECT *, lag(ts) OVER w AS pt, lag(event_type) OVER w AS pe FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    s AS (SELECT *, CASE WHEN pt IS NULL OR pe = 'signup' OR ts >= pt + INTERVAL 6 HOURS THEN 1 ELSE 0 END AS new FROM p),
    n AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM s),
    g AS (SELECT user_id, session, min(ts) AS start, max(ts) AS last, max(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS closed,
          count(*) AS n_events FROM n GROUP BY 1, 2),
    e AS (SELECT *, CASE WHEN closed = 1 THEN last ELSE last + INTERVAL 6 HOURS END AS "end" FROM g)
    SELECT user_id, epoch_us(start) AS session_start, n_events, (epoch_us("end") - epoch_us(start)) // 1000 AS duration_ms
    FROM e WHERE "end" < (SELECT make_timestamp_ms(epoch_ms(max(ts))) - INTERVAL 10 SECONDS FROM events)""")
def _(t):
    """Sessions whose end the watermark has passed; later ones stay in the state."""
    return jobs.drain_append(jobs.session_stream(_events(t), "signup", 6 * 3600, "10 seconds"))


@query("e20_watermark", """
    WITH w AS (SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2)
    SELECT * FROM w WHERE start + INTERVAL 1 HOUR <= (SELECT make_timestamp_ms(epoch_ms(max(ts))) - INTERVAL 10 MINUTES FROM events)""")
def _(t):
    """Hourly counts of the windows the watermark has closed."""
    closed = jobs.drain_append(jobs.windowed_counts(_events(t), "event_type", "1 hour", late="10 minutes"))
    return closed.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("e21_stream_static_join", """
    WITH w AS (SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM conversations) GROUP BY 1),
    l(word, weight) AS (VALUES ('the', 1), ('that', -1), ('was', -2), ('with', 3), ('from', 2), ('not', -3), ('und', 1), ('que', 2))
    SELECT word, weight * n AS score FROM w JOIN l USING (word) ORDER BY score DESC, word LIMIT 5""")
def _(t):
    """Word counts of the stream scored with a fixed lexicon, the five highest."""
    lexicon = t.spark.createDataFrame(list(LEXICON), "word string, weight int")

    def score(batch):
        scored = batch.join(F.broadcast(lexicon), "word").select("word", (F.col("weight") * F.col("n")).alias("score"))
        return scored.orderBy(F.col("score").desc(), "word").limit(5)

    return jobs.drain_complete(jobs.word_counts(_stream(t, "conversations")), score)


@query("e22_running_totals", """
    SELECT word, sum(n)::BIGINT AS n FROM (SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM conversations) GROUP BY 1
      UNION ALL SELECT p_type, count(*) FROM part GROUP BY 1) GROUP BY 1""")
def _(t):
    """Running totals whose state starts with given counts; the result is the state the stream has left in its store."""
    initial = t.part.groupBy(F.col("p_type").alias("word")).agg(F.count(F.lit(1)).alias("n"))
    totals = jobs.running_totals(_stream(t, "conversations"), initial)
    state = workspace(t.spark, "state")
    jobs.drain_batches(totals, lambda batch: batch, "update", state=state)
    return jobs.stored_state(t.spark, state, "total")


@query("e23_recoverable_count", """
    WITH w AS (SELECT unnest(string_split(text, ' ')) AS word FROM conversations)
    SELECT word, count(*) AS n, (SELECT count(*) FROM w WHERE word IN ('the', 'of', 'and', 'to')) AS n_dropped
    FROM w WHERE word NOT IN ('the', 'of', 'and', 'to') GROUP BY 1""")
def _(t):
    """Counts without the excluded words, next to the number of words left out."""
    def mark(batch):
        return batch.withColumn("listed", F.col("word").isin(*EXCLUDED))

    counted = jobs.drain_complete(jobs.word_counts(_stream(t, "conversations")), mark)
    dropped = counted.agg(F.sum(F.when(F.col("listed"), F.col("n")))).first()[0]
    return counted.where(~F.col("listed")).select("word", "n", F.lit(dropped or 0).cast("long").alias("n_dropped"))


@query("e24_sql_per_batch", """
    SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1""")
def _(t):
    def summarise(batch):
        batch.createOrReplaceTempView("micro_batch")
        return batch.sparkSession.sql("SELECT event_type, count(*) AS n, sum(value) AS total FROM micro_batch GROUP BY event_type")

    parts = jobs.drain_all(_stream(t, "events"), summarise)
    return parts.groupBy("event_type").agg(F.sum("n").alias("n"), F.round(F.sum("total"), 2).alias("total"))


@query("e25_directory_word_count", _WORDS.format("conversations"))
def _(t):
    return jobs.drain_complete(jobs.word_counts(_stream(t, "conversations")))


@query("e26_modulo_count", "SELECT l_partkey % 10 AS rest, count(*) AS n FROM lineitem GROUP BY 1")
def _(t):
    def count(batch):
        return batch.groupBy((F.col("l_partkey") % 10).alias("rest")).agg(F.count(F.lit(1)).alias("n"))

    return jobs.drain_all(_stream(t, "lineitem"), count).groupBy("rest").agg(F.sum("n").alias("n"))


@query("e27_filter_count", r"""
    SELECT count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) WHERE contains(line, 'the')""")
def _(t):
    def count(batch):
        lines = batch.select(F.explode(F.split("text", "\n")).alias("line"))
        return lines.where(F.col("line").contains("the")).agg(F.count(F.lit(1)).alias("n"))

    return jobs.drain_all(_stream(t, "documents"), count).agg(F.sum("n").alias("n"))


_SLICES = 4


@query("b29_streaming_dedup", "SELECT event_id, user_id, event_type, ts FROM events")
def _(t):
    """Events delivered more than once, some of them a slice later, each kept once.

    The events are landed in slices of time; every third one comes again in the
    next slice and every fifth one twice in its own. A repeat the watermark has
    passed is late and dropped; an earlier one is found in the state.
    """
    events = t.events.select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    landed = workspace(t.spark, "slices")
    width = (high - low) / _SLICES if low else timedelta(seconds=1)
    place = F.least(F.floor((F.unix_micros("ts") - F.unix_micros(F.lit(low))) / max(width // timedelta(microseconds=1), 1)), F.lit(_SLICES - 1))
    for k in range(_SLICES):
        own = events.where(F.coalesce(place, F.lit(0)) == k)
        again = events.where((place == k - 1) & (F.col("event_id") % 3 == 0))
        own.unionByName(own.where("event_id % 5 = 0")).unionByName(again).coalesce(1).write.mode("append").parquet(landed)
    stream = jobs.file_stream(t.spark, landed, events.schema, files_per_batch=1)
    return jobs.drain_append(jobs.once_within(stream, ["event_id"], f"{int(width.total_seconds()) + 1} seconds")).select(
        "event_id", "user_id", "event_type", F.col("ts").cast("timestamp_ntz").alias("ts"))


@query("b29_distinct_pairs", "SELECT DISTINCT user_id, event_type FROM events")
def _(t):
    """Distinct pairs over the whole stream: the state has one entry per pair for good."""
    return jobs.drain_append(_stream(t, "events").select("user_id", "event_type").dropDuplicates(["user_id", "event_type"]))


@query("b29_update_mode", """
    SELECT user_id, count(*) AS n, max(value) AS top FROM events GROUP BY 1""")
def _(t):
    """Update mode hands over changed rows only; the newest row per key is the state."""
    stats = _stream(t, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("top"))
    out, _ = jobs.drain_batches(stats, lambda batch: batch, "update")
    changes = t.spark.read.parquet(out)
    # Counts only grow, so the row with the largest count is the last one written.
    return changes.groupBy("user_id").agg(F.max("n").alias("n"), F.max_by("top", "n").alias("top"))


@query("b29_append_filter", "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'")
def _(t):
    return jobs.drain_append(_stream(t, "events").where("event_type = 'purchase'").select("event_id", "user_id", "value"))
