"""Joins, duplicates, ids and positions on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from paddock.functions import columns as C
from paddock.functions import text as X
from paddock.operators import joins, rows, scan
from paddock.queries.registry import query


# Joins

@query("j01_left_two_keys", """
    WITH r AS (SELECT o_custkey AS k, o_orderstatus AS s, max(o_totalprice) AS price, min(o_orderpriority) AS name
               FROM orders GROUP BY 1, 2),
         l AS (SELECT c_custkey AS k, CASE WHEN c_acctbal < 5000 THEN 'F' ELSE 'P' END AS s, c_name AS name FROM customer)
    SELECT l.k, l.s, l.name AS name_x, r.price, r.name AS name_y FROM l LEFT JOIN r ON l.k = r.k AND l.s = r.s""")
def _(t):
    left = t.customer.select(F.col("c_custkey").alias("k"),
                             F.when(F.col("c_acctbal") < 5000, "F").otherwise("P").alias("s"), F.col("c_name").alias("name"))
    right = t.orders.groupBy(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("s")).agg(
        F.max("o_totalprice").alias("price"), F.min("o_orderpriority").alias("name"))
    return joins.left_lookup(left, right, ["k", "s"])


@query("j02_left_fan_out", """
    SELECT c_custkey, c_name, o_orderkey FROM customer LEFT JOIN
      (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT') ON c_custkey = o_custkey""")
def _(t):
    urgent = t.orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return joins.left_lookup(t.customer.select("c_custkey", "c_name"), urgent, ["c_custkey"])


@query("j02_left_one_row", """
    SELECT c_custkey, c_name, o_orderkey FROM customer LEFT JOIN
      (SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
      ON c_custkey = o_custkey""")
def _(t):
    urgent = t.orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return joins.left_lookup(t.customer.select("c_custkey", "c_name"), urgent, ["c_custkey"], one_row=["o_orderkey"])


@query("j03_surrogate_lookup", """
    WITH d AS (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) AS id FROM part)
    SELECT l_orderkey, l_linenumber, l_extendedprice, d.id AS part_id FROM lineitem LEFT JOIN d ON l_partkey = p_partkey""")
def _(t):
    dimension = scan.dense_ids(t.part.select(F.col("p_partkey").alias("l_partkey")), ["l_partkey"])
    fact = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey")
    return joins.surrogate(fact, dimension, ["l_partkey"], "id", "part_id")


@query("j04_five_key_join", """
    WITH o AS (SELECT o_custkey AS id, o_orderstatus AS series, count(*) AS starts, sum(o_orderkey) AS points
               FROM orders GROUP BY 1, 2),
         n AS (SELECT c_custkey AS id, c_name AS full_name, substr(c_name, 1, 8) AS first_name,
                      substr(c_name, 10) AS last_name FROM customer),
         s AS (SELECT n.*, series, starts, points FROM o JOIN n USING (id)),
         i AS (SELECT n.*, 'F' AS series, c_acctbal FROM n JOIN customer ON id = c_custkey WHERE c_acctbal > 0)
    SELECT s.id, s.full_name, s.first_name, s.last_name, s.series, s.starts, CAST(s.points AS BIGINT) AS points, i.c_acctbal
    FROM s LEFT JOIN i ON s.id = i.id AND s.full_name = i.full_name AND s.first_name = i.first_name
      AND s.last_name = i.last_name AND s.series = i.series""")
def _(t):
    names = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("full_name"),
                              F.substring("c_name", 1, 8).alias("first_name"),
                              F.substring("c_name", 10, 20).alias("last_name"), "c_acctbal")
    standings = t.orders.groupBy(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("series")).agg(
        F.count(F.lit(1)).alias("starts"), F.sum("o_orderkey").alias("points")).join(names.drop("c_acctbal"), "id")
    stats = names.where("c_acctbal > 0").withColumn("series", F.lit("F"))
    return joins.left_lookup(standings, stats, ["id", "full_name", "first_name", "last_name", "series"])


@query("j05_enrichment_cascade", """
    WITH base AS (SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 5 = 0 THEN c_mktsegment END AS v FROM customer),
    t1 AS (SELECT o_custkey, min(o_orderpriority) AS v FROM orders WHERE o_totalprice > 450000 GROUP BY 1),
    t2 AS (SELECT s_nationkey, min(s_name) AS v FROM supplier WHERE s_acctbal > 5000 GROUP BY 1),
    x AS (SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS v FROM orders WHERE o_totalprice < 2000 GROUP BY 1)
    SELECT c_custkey, coalesce(x.v, base.v, t1.v, t2.v) AS value,
      CASE WHEN base.v IS NOT NULL THEN 'base' WHEN t1.v IS NOT NULL THEN 'exact' WHEN t2.v IS NOT NULL THEN 'loose' END AS source
    FROM base LEFT JOIN t1 ON c_custkey = t1.o_custkey LEFT JOIN t2 ON c_nationkey = s_nationkey
    LEFT JOIN x ON c_custkey = x.o_custkey""")
def _(t):
    """Own value, then a lookup by exact key, then by a looser key; overrides last."""
    base = t.customer.select("c_custkey", "c_nationkey", F.when(F.col("c_custkey") % 5 == 0, F.col("c_mktsegment")).alias("base"))
    exact = t.orders.where("o_totalprice > 450000").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min("o_orderpriority").alias("exact"))
    loose = t.supplier.where("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("c_nationkey")).agg(
        F.min("s_name").alias("loose"))
    joined = joins.left_lookup(joins.left_lookup(base, exact, ["c_custkey"]), loose, ["c_nationkey"])
    value, source = joins.first_known({c: F.col(c) for c in ("base", "exact", "loose")})
    resolved = joined.select("c_custkey", value.alias("value"), source.alias("source"))
    overrides = t.orders.where("o_totalprice < 2000").select(
        F.col("o_orderkey").alias("seq"), F.col("o_custkey").alias("c_custkey"), F.col("o_orderstatus").alias("value"))
    return joins.apply_overrides(resolved, overrides, "c_custkey", "value")


@query("j06_unresolved_keys", """
    SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""")
def _(t):
    known = t.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return joins.unresolved(t.customer.select("c_custkey"), known, ["c_custkey"])


@query("j07_null_safe_keys", """
    WITH l AS (SELECT c_custkey, CASE WHEN c_nationkey % 4 <> 0 THEN c_nationkey END AS k FROM customer),
         r AS (SELECT CASE WHEN s_nationkey % 4 <> 0 THEN s_nationkey END AS k, count(*) AS n_suppliers FROM supplier GROUP BY 1)
    SELECT c_custkey, l.k, n_suppliers FROM l LEFT JOIN r ON l.k IS NOT DISTINCT FROM r.k""")
def _(t):
    left = t.customer.select("c_custkey", F.when(F.col("c_nationkey") % 4 != 0, F.col("c_nationkey")).alias("k"))
    key = F.when(F.col("s_nationkey") % 4 != 0, F.col("s_nationkey")).alias("k")
    right = t.supplier.groupBy(key).agg(F.count(F.lit(1)).alias("n_suppliers"))
    return joins.left_lookup(left, right, ["k"], null_safe=True)


@query("j08_star_join", """
    SELECT l_orderkey, l_linenumber, l_extendedprice, o_orderdate, c_name, n_name, r_name
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def _(t):
    """Dimensions first, so the fact meets one prepared customer side."""
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    customers = t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    orders = t.orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return t.lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "o_orderdate", "c_name", "n_name", "r_name")


# Unions and duplicates

@query("u01_union_absent_columns", """
    SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""")
def _(t):
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    b = t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return rows.union_by_name([a, b])


@query("u02_union_groups", """
    SELECT o_orderkey, lower(o_orderstatus) AS series FROM orders""")
def _(t):
    """Named groups and the remainder, missing status included, so that every row is in one frame."""
    status = F.col("o_orderstatus")
    frames = [t.orders.where(status == s).select("o_orderkey", F.lit(s.lower()).alias("series")) for s in ("F", "O")]
    rest = t.orders.where(~F.coalesce(status.isin("F", "O"), F.lit(False))).select("o_orderkey", F.lower(status).alias("series"))
    return rows.union_by_name([*frames, rest])


@query("u03_union_partial", """
    SELECT c_custkey, 'known' AS state FROM customer WHERE c_acctbal >= 0
    UNION ALL SELECT c_custkey, 'open' FROM customer WHERE c_acctbal < 0""")
def _(t):
    known = t.customer.where("c_acctbal >= 0").select("c_custkey", F.lit("known").alias("state"))
    rest = t.customer.where("c_acctbal < 0").select("c_custkey", F.lit("open").alias("state"))
    return rows.union_by_name([known, rest])


@query("u04_first_per_key", """
    SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1""")
def _(t):
    newest = rows.first_per_key(t.orders, ["o_custkey"], [F.col("o_orderdate").desc(), "o_orderkey"])
    return newest.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")


@query("u05_distinct_rows", """
    SELECT DISTINCT CASE WHEN l_suppkey % 3 <> 0 THEN l_suppkey END AS supplier, l_returnflag, l_linestatus FROM lineitem""")
def _(t):
    supplier = F.when(F.col("l_suppkey") % 3 != 0, F.col("l_suppkey"))
    return t.lineitem.select(supplier.alias("supplier"), "l_returnflag", "l_linestatus").distinct()


@query("u06_mark_duplicates", """
    SELECT l_orderkey, l_linenumber, l_extendedprice, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS duplicated
    FROM lineitem""")
def _(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    return rows.mark_duplicates(lines, ["l_orderkey", "l_linenumber"])


# Order, ids, positions

@query("o01_sort", """
    SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS season, o_orderstatus AS series FROM orders ORDER BY season, series""")
def _(t):
    return t.orders.select(F.year("o_orderdate").alias("season"), F.col("o_orderstatus").alias("series")).distinct().orderBy(
        "season", "series")


@query("o02_dense_ids", """
    SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id FROM orders""")
def _(t):
    return scan.dense_ids(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("o02_dense_ids_by_runs", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate,
           row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS id
    FROM lineitem""")
def _(t):
    """The form used beyond the one-task limit: range runs and carried offsets."""
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    return scan.dense_ids(t.lineitem.select(*order), order, rows_limit=1)


@query("o03_head", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def _(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(5)


@query("o04_latest_record", """
    SELECT event_id, ts, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 1""")
def _(t):
    latest = F.max_by(F.struct("event_id", "ts", "event_type"), F.struct("ts", "event_id"))
    return t.events.agg(latest.alias("r")).select("r.*")


@query("o05_positions", """
    WITH w AS (SELECT doc_id, string_split(text, ' ') AS ws FROM documents)
    SELECT doc_id, unnest(list_filter(list_transform(ws, lambda x, i: CASE WHEN x = 'the' THEN i - 1 END),
                                      lambda x: x IS NOT NULL)) AS pos FROM w""")
def _(t):
    positions = X.positions_of(F.split("text", " "), F.lit("the"))
    return t.documents.select("doc_id", F.explode(positions).alias("pos")).select(
        "doc_id", F.col("pos").cast("long").alias("pos"))


@query("o06_gap_alignment", """
    WITH w AS (SELECT conv_id, turn, string_split(text, ' ') AS names FROM conversations),
         y AS (SELECT conv_id, turn, names, len(names) // 2 AS gap, list_transform(names, lambda x: CAST(length(x) AS VARCHAR)) AS years FROM w),
         g AS (SELECT conv_id, turn, names, list_concat(list_concat(years[1:gap], [NULL]), years[gap + 2:len(names)]) AS years FROM y)
    SELECT conv_id, turn, i - 1 AS pos, names[i] AS name, years[i] AS year
    FROM (SELECT *, unnest(range(1, len(names) + 1)) AS i FROM g)""")
def _(t):
    """Two lists cut from one whole text, the second one lacking the entry in its middle."""
    cut = t.conversations.select("conv_id", "turn", F.split("text", " ").alias("names")).withColumn(
        "gap", F.floor(F.size("names") / 2).cast("int"))
    years = F.transform("names", lambda x: F.length(x).cast("string"))
    short = cut.withColumn("years", F.concat(F.slice(years, F.lit(1), F.col("gap")), F.slice(years, F.col("gap") + 2, F.size("names"))))
    aligned = F.arrays_zip(F.col("names"), X.insert_gap(F.col("years"), F.col("gap")).alias("filled"))
    return short.select("conv_id", "turn", F.posexplode(aligned).alias("pos", "e")).select(
        "conv_id", "turn", F.col("pos").cast("long").alias("pos"), F.col("e.names").alias("name"), F.col("e.filled").alias("year"))


FLAGSHIP_SQL = """
    WITH newest AS (SELECT * FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1),
    e AS (SELECT c_custkey, n_name, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END, c_mktsegment) AS label,
        coalesce(o_totalprice / 10000 / NULLIF(CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END, 0), 0.0) AS score
        FROM newest JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey)
    SELECT n_name, CASE WHEN score BETWEEN 0 AND 10 THEN 1 WHEN score BETWEEN 11 AND 30 THEN 2
        WHEN score BETWEEN 31 AND 50 THEN 3 ELSE 4 END AS band, count(*) AS n, count(DISTINCT label) AS n_labels,
        round(sum(score), 4) AS total FROM e GROUP BY 1, 2"""


@query("flagship_newest_enriched_band", FLAGSHIP_SQL)
def flagship(t):
    """Newest order per customer, enriched, scored and counted per nation and band."""
    newest = rows.first_per_key(t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice"),
                                ["o_custkey"], [F.col("o_orderdate").desc(), "o_orderkey"])
    joined = newest.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    positive = F.when(F.col("c_acctbal") > 0, 1).otherwise(0)
    label = F.coalesce(F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")), F.col("c_mktsegment"))
    scored = joined.select("n_name", label.alias("label"),
                           C.ratio_or_zero(F.col("o_totalprice") / 10000, positive).alias("score"))
    return scored.groupBy("n_name", C.rank_band(F.col("score")).alias("band")).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("label").alias("n_labels"), F.round(F.sum("score"), 4).alias("total"))
