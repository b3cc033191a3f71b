"""User functions on the given tables, each next to its built-in twin in SQL."""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock.functions import udfs as U
from paddock.operators.hot import small_rows
from paddock.operators.rows import with_key_stats
from paddock.queries.registry import query

_LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"
_LINE_COLS = _LINE.split(", ")


@query("e28_arrow_exchange", """
    WITH m AS (SELECT c_mktsegment, avg(c_acctbal) AS mean FROM customer GROUP BY 1)
    SELECT c_custkey, round(c_acctbal - mean, 6) AS over_mean FROM customer JOIN m USING (c_mktsegment)""")
def _(t):
    """A small summary goes to pandas and comes back as a frame; the rows stay in Spark."""
    means = t.customer.groupBy("c_mktsegment").agg(F.avg("c_acctbal").alias("mean"))
    summary = pd.DataFrame(small_rows(means, 1000), columns=means.columns)
    back = t.spark.createDataFrame(summary, "c_mktsegment string, mean double")
    return t.customer.join(back, "c_mktsegment").select("c_custkey", F.round(F.col("c_acctbal") - F.col("mean"), 6).alias("over_mean"))


@query("e29_series_to_frame", """
    SELECT c_custkey, string_split(c_name, '#')[1] AS first, string_split(c_name, '#')[2] AS rest FROM customer""")
def _(t):
    return t.customer.select("c_custkey", U.split_name("c_name").alias("n")).select("c_custkey", "n.*")


@query("e29_series_to_series", f"SELECT {_LINE}, round(l_extendedprice * (1 - l_discount), 4) AS net FROM lineitem")
def _(t):
    return t.lineitem.select(*_LINE_COLS, F.round(U.discounted("l_extendedprice", "l_discount"), 4).alias("net"))


@query("e29_iterator", """
    SELECT event_id, CAST(nullif(regexp_extract(props, '-?[0-9]+([.][0-9]+)?'), '') AS DOUBLE) AS number FROM events""")
def _(t):
    return t.events.select("event_id", U.first_number("props").alias("number"))


@query("e29_multi_iterator", f"""
    SELECT {_LINE}, CAST(CASE WHEN net < 1000 THEN 0 WHEN net < 10000 THEN 1 WHEN net < 30000 THEN 2 WHEN net < 60000 THEN 3 ELSE 4 END AS BIGINT) AS band
    FROM (SELECT *, round(l_extendedprice * (1 - l_discount), 2) AS net FROM lineitem)""")
def _(t):
    return t.lineitem.select(*_LINE_COLS, U.net_band("l_extendedprice", "l_discount").alias("band"))


@query("e30_vectorised_aggregate", """
    SELECT l_returnflag, round(sqrt(avg(l_quantity * l_quantity)), 6) AS rms FROM lineitem GROUP BY 1""")
def _(t):
    found = U.rms_in_pieces(t.lineitem, ["l_returnflag"], "l_quantity")
    return found.select("l_returnflag", F.round("rms", 6).alias("rms"))


def _yearly(t):
    """Totals per nation and year: a nation has as many rows as there are years."""
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy(F.col("c_nationkey").alias("nation"), F.year("o_orderdate").alias("year")).agg(
        F.sum("o_totalprice").alias("total"))


_YEARLY = """
    WITH y AS (SELECT c_nationkey AS nation, CAST(year(o_orderdate) AS INTEGER) AS year, sum(o_totalprice) AS total
               FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""


@query("e30_aggregate_over_window", _YEARLY + """
    SELECT nation, year, round(sqrt(avg(total * total) OVER (PARTITION BY nation)), 2) AS rms FROM y""")
def _(t):
    rms = U.root_mean_square("total").over(W.partitionBy("nation"))
    return _yearly(t).select("nation", "year", F.round(rms, 2).alias("rms"))


@query("e31_grouped_map", _YEARLY + """
    SELECT nation, year, round(sum(total) OVER (PARTITION BY nation ORDER BY year) / sum(total) OVER (PARTITION BY nation), 8) AS share FROM y""")
def _(t):
    """The share of a nation's total reached by each year."""
    shares = _yearly(t).groupBy("nation").applyInPandas(U.running_share("year", "total"), "nation int, year int, total double")
    return shares.select("nation", "year", F.round("total", 8).alias("share"))


@query("e31_native_form", """
    SELECT event_id, round(value - avg(value) OVER (PARTITION BY event_type), 4) + 0.0 AS value FROM events""")
def _(t):
    """The same on raw rows, where a group may be any size: mean per group, joined back."""
    centred = with_key_stats(t.events, ["event_type"], mean=F.avg("value"))
    return centred.select("event_id", (F.round(F.col("value") - F.col("mean"), 4) + F.lit(0.0)).alias("value"))


@query("e32_map_in_pandas", """
    SELECT event_id, part, round(value / 3, 6) AS value FROM events, (VALUES (1), (2), (3)) p(part) WHERE event_type = 'purchase'""")
def _(t):
    """Every purchase in three instalments."""
    rows = t.events.where("event_type = 'purchase'").select("event_id", "value")
    return rows.mapInPandas(U.instalments("value", 3), "event_id long, value double, part int").select(
        "event_id", "part", F.round("value", 6).alias("value"))


@query("e34_custom_average", "SELECT l_suppkey, round(avg(l_extendedprice), 4) AS average FROM lineitem GROUP BY 1")
def _(t):
    return U.custom_average(t.lineitem, "l_suppkey", "l_extendedprice").select("l_suppkey", F.round("average", 4).alias("average"))


@query("e35_scalar_udf", """
    SELECT p_partkey, length(p_name)::INTEGER AS n FROM part WHERE length(p_type) > 5""")
def _(t):
    """A user function in the select list and, registered by name, in a WHERE clause."""
    t.spark.udf.register("text_length", U.text_length)
    t.part.createOrReplaceTempView("part")
    return t.spark.sql("SELECT p_partkey, text_length(p_name) AS n FROM part WHERE text_length(p_type) > 5")


@query("e35_random_udf")
def _(t):
    """Declared non-deterministic, so it is called exactly once per row."""
    draw = F.udf(lambda: random.random(), T.DoubleType()).asNondeterministic()
    return t.part.select("p_partkey", draw().alias("draw")).where(F.col("draw") < 0.5)


@query("e36_views", """
    SELECT c_mktsegment, count(*) AS n, round(avg(c_acctbal), 4) AS mean FROM customer WHERE c_acctbal >= 0 GROUP BY 1""")
def _(t):
    """A view of the session and one that all sessions of the application see."""
    t.customer.createOrReplaceTempView("accounts")
    t.spark.sql("SELECT c_mktsegment, c_acctbal FROM accounts WHERE c_acctbal >= 0").createOrReplaceGlobalTempView("solvent_accounts")
    return t.spark.sql("SELECT c_mktsegment, count(*) AS n, round(avg(c_acctbal), 4) AS mean FROM global_temp.solvent_accounts GROUP BY 1")


@query("e37_declared_schema", """
    SELECT n_nationkey, n_name, n_regionkey * 1.5 AS weight FROM nation""")
def _(t):
    """Text rows get their column names and types from a schema built in code."""
    names = ("n_nationkey", "n_name", "weight")
    kinds = (T.IntegerType(), T.StringType(), T.DoubleType())
    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)])
    line = F.concat_ws(",", "n_nationkey", "n_name", F.col("n_regionkey") * 1.5)
    return t.nation.select(F.from_csv(line, schema.simpleString()[7:-1].replace(":", " ")).alias("r")).select("r.*")


@query("b30_table_function", """
    WITH w AS (SELECT conv_id, turn, string_split(text, ' ') AS ws FROM conversations)
    SELECT conv_id, turn, CAST(i - 1 AS INTEGER) AS place, ws[i] AS word FROM w, LATERAL (SELECT unnest(range(1, len(ws) + 1)) AS i)""")
def _(t):
    t.spark.udtf.register("words_of", U.Words)
    t.conversations.createOrReplaceTempView("talk")
    return t.spark.sql("SELECT conv_id, turn, w.place, w.word FROM talk, LATERAL words_of(text) w")


@query("b30_row_udf", "SELECT o_orderkey, o_totalprice = floor(o_totalprice) AS is_round FROM orders")
def _(t):
    return t.orders.select("o_orderkey", U.is_round("o_totalprice").alias("is_round"))


@query("b30_cogrouped_map", """
    WITH o AS (SELECT c_nationkey AS nation, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders
               JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
         s AS (SELECT s_nationkey AS nation, CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS n FROM lineitem
               JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)
    SELECT nation, year, CAST(sum(coalesce(o.n, 0) - coalesce(s.n, 0)) OVER (PARTITION BY nation ORDER BY year) AS BIGINT) AS open
    FROM o FULL JOIN s USING (nation, year)""")
def _(t):
    """Orders placed less lines shipped, summed up over the years per nation; a group has one row per year."""
    placed = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(
        F.col("c_nationkey").alias("nation"), F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("placed"))
    shipped = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).groupBy(
        F.col("s_nationkey").alias("nation"), F.year("l_shipdate").alias("year")).agg(F.count(F.lit(1)).alias("shipped"))
    return placed.groupBy("nation").cogroup(shipped.groupBy("nation")).applyInPandas(
        U.backlog("nation", "year", "placed", "shipped"), "nation int, year int, open long")
