"""One query per relational category."""

from __future__ import annotations

from pyspark.sql import functions as F

from paddock.operators import intervals, rows, sampling, scan, sketches
from paddock.operators.hot import hot_keys, null_safe_join
from paddock.queries.registry import query
from paddock.session import workspace

def _join_sql(kind):
    return f"""
    WITH o AS (SELECT * FROM orders WHERE o_totalprice > 350000),
         c AS (SELECT * FROM customer WHERE c_acctbal > 0)
    SELECT o_orderkey, o_totalprice, c_custkey, c_name FROM o {kind} JOIN c ON o_custkey = c_custkey"""


def _join(t, kind):
    orders = t.orders.where("o_totalprice > 350000")
    customers = t.customer.where("c_acctbal > 0")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), kind)
    return joined.select("o_orderkey", "o_totalprice", "c_custkey", "c_name")


@query("b01_inner_join", _join_sql("INNER"))
def _(t):
    return _join(t, "inner")


@query("b01_left_join", _join_sql("LEFT"))
def _(t):
    return _join(t, "left")


@query("b01_right_join", _join_sql("RIGHT"))
def _(t):
    return _join(t, "right")


@query("b01_full_join", _join_sql("FULL"))
def _(t):
    return _join(t, "full")


@query("b02_semi_join", """
    SELECT c_custkey, c_name FROM customer WHERE EXISTS
      (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""")
def _(t):
    urgent = t.orders.where("o_orderpriority = '1-URGENT'")
    return t.customer.join(urgent, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("c_custkey", "c_name")


@query("b02_anti_join", """
    SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS
      (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""")
def _(t):
    urgent = t.orders.where("o_orderpriority = '1-URGENT'")
    return t.customer.join(urgent, F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey", "c_name")


@query("b03_complete_grid", """
    SELECT r_name, segment, count(c_custkey) AS n FROM region
    CROSS JOIN (SELECT DISTINCT c_mktsegment AS segment FROM customer)
    LEFT JOIN (SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 9800)
      ON n_regionkey = r_regionkey AND c_mktsegment = segment GROUP BY 1, 2""")
def _(t):
    """Every region with every segment, empty cells included.

    The distinct segments are one value, a set of names, exploded onto each region.
    """
    segments = t.customer.agg(F.collect_set("c_mktsegment")).scalar()
    grid = t.region.withColumn("segments", segments).select("r_regionkey", "r_name", F.explode("segments").alias("segment"))
    counted = t.customer.where("c_acctbal > 9800").join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(
        F.col("n_regionkey").alias("r_regionkey"), F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("n"))
    return grid.join(counted, ["r_regionkey", "segment"], "left").select(
        "r_name", "segment", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


@query("b03_inequality_count", """
    SELECT c_custkey, count(o_orderkey) AS n_orders_below FROM customer LEFT JOIN orders ON o_totalprice < c_acctbal
    GROUP BY 1""")
def _(t):
    """The inequality join customer x orders, counted per customer by one ordered scan."""
    return intervals.count_below(t.customer, t.orders, F.col("c_acctbal"), F.col("o_totalprice"), "c_custkey",
                                 "n_orders_below").select("c_custkey", F.col("n_orders_below").cast("long"))


@query("b03_inequality_count_by_runs", """
    SELECT o_orderkey, count(s_suppkey) AS n_suppliers_below FROM orders LEFT JOIN supplier
      ON s_acctbal < o_totalprice / 50 GROUP BY 1""")
def _(t):
    """The same in the form used beyond the one-task limit."""
    return intervals.count_below(t.orders, t.supplier, F.col("o_totalprice") / 50, F.col("s_acctbal"), "o_orderkey",
                                 "n_suppliers_below", rows_limit=1).select("o_orderkey", F.col("n_suppliers_below").cast("long"))


@query("b04_interval_join", """
    SELECT e.event_id, e.event_type, count(p.event_id) AS n_purchases FROM events e LEFT JOIN
      (SELECT * FROM events WHERE event_type = 'purchase') p ON p.user_id = e.user_id
        AND p.ts BETWEEN e.ts - INTERVAL 1 HOUR AND e.ts + INTERVAL 1 HOUR
    WHERE e.event_type <> 'purchase' GROUP BY 1, 2""")
def _(t):
    """For every event the purchases of its user within an hour before or after."""
    events = t.events.select("user_id", "ts", "event_id", "event_type")
    points, marks = events.where("event_type <> 'purchase'"), events.where("event_type = 'purchase'")
    near = intervals.count_within(points, marks, ["user_id"], "ts", "event_id", "1 HOUR", "1 HOUR", "n_purchases")
    return near.select("event_id", "event_type", "n_purchases")


@query("b05_broadcast_lookup", """
    SELECT c_custkey, n_name FROM customer LEFT JOIN nation
      ON CASE WHEN c_nationkey % 5 = 0 THEN NULL ELSE c_nationkey END IS NOT DISTINCT FROM n_nationkey""")
def _(t):
    """Null-safe lookup with a broadcast hint, given only after counting the lookup side."""
    key = F.when(F.col("c_nationkey") % 5 != 0, F.col("c_nationkey"))
    left = t.customer.select("c_custkey", key.alias("n_nationkey"))
    right = t.nation.select("n_nationkey", "n_name")
    small = right.limit(10_001).count() <= 10_000
    return null_safe_join(left, right, ["n_nationkey"], small=small).select("c_custkey", "n_name")


@query("b06_pricing_summary", """
    SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base,
      round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc, round(avg(l_quantity), 6) AS avg_qty,
      round(avg(l_extendedprice), 4) AS avg_price, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship,
      count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""")
def _(t):
    shipped = t.lineitem.where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    return shipped.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum("l_extendedprice"), 2).alias("sum_base"),
        F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("sum_disc"),
        F.round(F.avg("l_quantity"), 6).alias("avg_qty"), F.round(F.avg("l_extendedprice"), 4).alias("avg_price"),
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"), F.count(F.lit(1)).alias("n"))


@query("b07_distinct_aggregates", """
    SELECT l_suppkey, count(DISTINCT l_partkey) AS n_parts, round(sum(DISTINCT l_quantity), 2) AS qty FROM lineitem GROUP BY 1""")
def _(t):
    return t.lineitem.groupBy("l_suppkey").agg(
        F.count_distinct("l_partkey").alias("n_parts"), F.round(F.sum_distinct("l_quantity"), 2).alias("qty"))


@query("b07_approx_distinct")
def _(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.approx_count_distinct("l_partkey", 0.02).alias("n_parts"))


@query("b07_approx_distinct_error", "SELECT l_suppkey, true AS near FROM lineitem GROUP BY 1")
def _(t):
    """The estimate lies within five standard errors of the exact number."""
    both = t.lineitem.groupBy("l_suppkey").agg(
        F.approx_count_distinct("l_partkey", 0.02).alias("about"), F.countDistinct("l_partkey").alias("exact"))
    return both.select("l_suppkey", (F.abs(F.col("about") - F.col("exact")) <= F.greatest(0.1 * F.col("exact"), F.lit(2))).alias("near"))


@query("b07_merged_sketches", """
    SELECT event_type, count(*) AS n, true AS near_users, true AS near_theta, true AS near_median FROM events GROUP BY 1""")
def _(t):
    """Sketches are stored per kind and day and merged per kind; the estimates lie within five standard errors."""
    path = workspace(t.spark, "sketches")
    day = F.to_date("ts").alias("day")
    sketches.sketched(t.events, ["event_type", day], "user_id", "value").write.parquet(path)
    found = sketches.merged(t.spark.read.parquet(path), ["event_type"]).select(
        "event_type", "n", sketches.n_distinct().alias("users"), sketches.n_distinct_theta().alias("theta"), sketches.quantile(0.5).alias("median"))
    exact = t.events.join(found.select("event_type", "median"), "event_type").groupBy("event_type").agg(
        F.count_distinct("user_id").alias("exact"), F.avg((F.col("value") <= F.col("median")).cast("int")).alias("rank"))

    def near(about):
        return F.abs(F.col(about) - F.col("exact")) <= F.greatest(0.08 * F.col("exact"), F.lit(1))

    return found.join(exact, "event_type").select(
        "event_type", "n", near("users").alias("near_users"), near("theta").alias("near_theta"), F.col("rank").between(0.46, 0.54).alias("near_median"))


@query("b08_rollup", """
    SELECT c_mktsegment, o_orderstatus, CAST(grouping(c_mktsegment) AS INTEGER) AS g_segment, count(*) AS n,
      round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey
    GROUP BY ROLLUP (c_mktsegment, o_orderstatus)""")
def _(t):
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.rollup("c_mktsegment", "o_orderstatus").agg(
        F.grouping("c_mktsegment").cast("int").alias("g_segment"), F.count(F.lit(1)).alias("n"),
        F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("b08_cube", """
    SELECT c_mktsegment, o_orderstatus, CAST(grouping_id(c_mktsegment, o_orderstatus) AS BIGINT) AS gid, count(*) AS n
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY CUBE (c_mktsegment, o_orderstatus)""")
def _(t):
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.cube("c_mktsegment", "o_orderstatus").agg(
        F.grouping_id().cast("long").alias("gid"), F.count(F.lit(1)).alias("n"))


@query("b09_pivot", """
    SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O",
      count(*) FILTER (o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1""")
def _(t):
    return t.orders.groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).agg(
        F.count(F.lit(1))).na.fill(0, ["F", "O", "P"])


@query("b10_statistics", """
    SELECT l_returnflag, round(stddev_samp(l_quantity), 6) AS sd, round(var_pop(l_quantity), 6) AS variance,
      round(covar_samp(l_quantity, l_discount), 6) AS cov, round(corr(l_quantity, l_extendedprice), 6) AS corr,
      round(avg(power(l_quantity - m, 3)) / power(stddev_pop(l_quantity), 3), 5) AS skew,
      round(avg(power(l_quantity - m, 4)) / power(var_pop(l_quantity), 2) - 3, 5) AS kurt
    FROM lineitem JOIN (SELECT l_returnflag AS f, avg(l_quantity) AS m FROM lineitem GROUP BY 1) ON f = l_returnflag GROUP BY 1""")
def _(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.round(F.stddev("l_quantity"), 6).alias("sd"), F.round(F.var_pop("l_quantity"), 6).alias("variance"),
        F.round(F.covar_samp("l_quantity", "l_discount"), 6).alias("cov"),
        F.round(F.corr("l_quantity", "l_extendedprice"), 6).alias("corr"),
        F.round(F.skewness("l_quantity"), 5).alias("skew"), F.round(F.kurtosis("l_quantity"), 5).alias("kurt"))


@query("b10_percentiles")
def _(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.percentile_approx("l_extendedprice", [0.25, 0.5, 0.75], 10000).alias("quartiles"))


@query("b10_exact_percentiles", """
    SELECT l_returnflag, list_transform(quantile_cont(l_extendedprice, [0.25, 0.5, 0.75]), lambda x: round(x, 4)) AS quartiles,
      true AS near FROM lineitem GROUP BY 1""")
def _(t):
    """Exact quartiles, and whether the estimates lie within a hundredth of the range around them.

    Equal prices are counted in the map tasks, so a group ships its distinct values.
    """
    price = F.col("l_extendedprice")
    found = t.lineitem.groupBy("l_returnflag").agg(
        F.percentile(price, [0.25, 0.5, 0.75]).alias("q"), F.percentile_approx(price, [0.25, 0.5, 0.75], 10000).alias("about"),
        (F.max(price) - F.min(price)).alias("range"))
    gaps = F.zip_with("q", "about", lambda a, b: F.abs(a - b))
    return found.select("l_returnflag", F.transform("q", lambda x: F.round(x, 4)).alias("quartiles"),
                        F.forall(gaps, lambda g: g <= 0.01 * F.col("range")).alias("near"))


@query("b11_collected_sets", """
    WITH y AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS n FROM orders GROUP BY 1, 2),
    l AS (SELECT o_custkey, list({'y': y, 'n': n} ORDER BY y) AS per_year FROM y GROUP BY 1)
    SELECT o.o_custkey, list_sort(list_distinct(list(o_orderpriority))) AS priorities, any_value(per_year) AS per_year,
      arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_order, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_order,
      round(product(1 + o_orderkey % 3 / 100.0), 6) AS growth
    FROM orders o JOIN l ON l.o_custkey = o.o_custkey GROUP BY 1""")
def _(t):
    """Collected values per customer. What is collected has few values by nature: priorities and years."""
    orders = t.orders.withColumn("y", F.year("o_orderdate"))
    at = F.struct("o_orderdate", "o_orderkey")
    factor = 1 + F.col("o_orderkey") % 3 / F.lit(100.0)
    by_year = orders.groupBy("o_custkey", "y").agg(
        F.count(F.lit(1)).alias("n"), F.collect_set("o_orderpriority").alias("p"),
        F.min_by("o_orderkey", at).alias("f"), F.min(at).alias("fa"),
        F.max_by("o_orderkey", at).alias("l"), F.max(at).alias("la"), F.product(factor).alias("g"))
    return by_year.groupBy("o_custkey").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("p")))).alias("priorities"),
        F.array_sort(F.collect_list(F.struct("y", "n"))).alias("per_year"),
        F.min_by("f", "fa").alias("first_order"), F.max_by("l", "la").alias("last_order"),
        F.round(F.product("g"), 6).alias("growth"))


_RANK_SQL = """
    SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS row_number,
      rank() OVER w AS rank, dense_rank() OVER w AS dense_rank, round(percent_rank() OVER w, 6) AS percent_rank,
      round(cume_dist() OVER w, 6) AS cume_dist,
      ntile(4) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS tile
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate)"""


def _ranked(t, group_rows):
    orders = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    out = scan.ranked(orders, ["o_custkey"], "o_orderdate", "o_orderkey", 4, group_rows, bound=t.orders)
    return out.drop("o_orderdate").withColumns({c: F.round(c, 6) for c in ("percent_rank", "cume_dist")})


@query("b12_ranking", _RANK_SQL)
def _(t):
    return _ranked(t, scan.GROUP_ROWS)


@query("b12_ranking_hot_keys", _RANK_SQL)
def _(t):
    """The same with customers of more than 12 orders treated as hot keys."""
    return _ranked(t, 12)


@query("b13_neighbours", """
    SELECT o_orderkey, lag(o_totalprice) OVER w AS previous, lead(o_totalprice) OVER w AS following,
      nth_value(o_totalprice, 2) OVER w AS second,
      datediff('day', lag(o_orderdate) OVER w, o_orderdate) AS days_since
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def _(t):
    return _neighbours(t, scan.GROUP_ROWS)


@query("b13_neighbours_hot_keys", """
    SELECT o_orderkey, lag(o_totalprice) OVER w AS previous, lead(o_totalprice) OVER w AS following,
      nth_value(o_totalprice, 2) OVER w AS second,
      datediff('day', lag(o_orderdate) OVER w, o_orderdate) AS days_since
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def _(t):
    return _neighbours(t, 14)


def _neighbours(t, group_rows):
    here = F.struct(F.col("o_totalprice").alias("p"), F.col("o_orderdate").alias("d"))
    orders = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice", here.alias("here"))
    up, down = ["o_orderdate", "o_orderkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    hot = hot_keys(orders, ["o_custkey"], group_rows)
    forth = scan.running(orders, ["o_custkey"], up, {
        "before": scan.latest("here", before=True), "n": scan.running_count()}, hot=hot)
    both = scan.running(forth, ["o_custkey"], down, {"after": scan.latest("here", before=True)}, hot=hot)
    # The second value is known from the second row on.
    both = both.withColumn("here_2", F.when(F.col("n") == 2, F.col("o_totalprice")))
    out = scan.running(both, ["o_custkey"], up, {"second": scan.latest("here_2")}, hot=hot)
    return out.select(
        "o_orderkey", F.col("before.p").alias("previous"), F.col("after.p").alias("following"), "second",
        F.datediff("o_orderdate", F.col("before.d")).cast("long").alias("days_since"))


@query("b14_range_frame", """
    SELECT o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate
      RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW), 2) AS week_total FROM orders""")
def _(t):
    """Seven-day sums. Days are summed first, so a window holds days, not rows."""
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1970-01-01").cast("date"))
    orders = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice", day.alias("day"))
    days = orders.groupBy("o_orderpriority", "day").agg(F.sum("o_totalprice").alias("total"))
    week = scan.W.partitionBy("o_orderpriority").orderBy("day").rangeBetween(-6, 0)
    sums = days.select("o_orderpriority", "day", F.round(F.sum("total").over(week), 2).alias("week_total"))
    return orders.join(sums, ["o_orderpriority", "day"]).select("o_orderkey", "week_total")


@query("b14_rows_frame", """
    SELECT o_orderkey, round(avg(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
      ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS moving_mean FROM orders""")
def _(t):
    """Three-row moving mean from the two rows before; a missing value is a row all the same."""
    return moving_mean(t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"))


def moving_mean(orders, group_rows=scan.GROUP_ROWS):
    order = ["o_orderdate", "o_orderkey"]
    hot = hot_keys(orders, ["o_custkey"], group_rows, bound=orders)
    # The value travels inside a struct, which is never missing itself.
    here = orders.withColumn("here", F.struct(F.col("o_totalprice").alias("v")))
    one = scan.running(here, ["o_custkey"], order, {"p1": scan.latest("here", before=True)}, group_rows, hot=hot)
    two = scan.running(one, ["o_custkey"], order, {"p2": scan.latest("p1", before=True)}, group_rows, hot=hot)
    values = F.array_compact(F.array("o_totalprice", "p1.v", "p2.v"))
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return two.select("o_orderkey", F.round(F.try_divide(total, F.size(values)), 4).alias("moving_mean"))


@query("b15_top_k", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS price FROM orders
    ORDER BY price DESC NULLS LAST, o_orderkey LIMIT 10""")
def _(t):
    price = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")).alias("price")
    return t.orders.select("o_orderkey", price).orderBy(F.col("price").desc_nulls_last(), "o_orderkey").limit(10)


@query("b15_top_k_per_group", """
    SELECT c_nationkey, c_custkey, c_acctbal FROM customer
    QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) <= 3""")
def _(t):
    best = rows.first_per_key(t.customer, ["c_nationkey"], [F.col("c_acctbal").desc(), "c_custkey"], n=3)
    return best.select("c_nationkey", "c_custkey", "c_acctbal")


@query("b16_set_operations", """
    SELECT 'union' AS op, count(*) AS n FROM (SELECT c_nationkey FROM customer UNION SELECT s_nationkey FROM supplier)
    UNION ALL SELECT 'intersect', count(*) FROM (SELECT c_nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier)
    UNION ALL SELECT 'intersect_all', count(*) FROM (SELECT c_nationkey FROM customer INTERSECT ALL SELECT s_nationkey FROM supplier)
    UNION ALL SELECT 'except', count(*) FROM (SELECT c_nationkey FROM customer EXCEPT SELECT s_nationkey FROM supplier)
    UNION ALL SELECT 'except_all', count(*) FROM (SELECT c_nationkey FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier)""")
def _(t):
    a = t.customer.select(F.col("c_nationkey").alias("k"))
    b = t.supplier.select(F.col("s_nationkey").alias("k"))
    results = {"union": a.unionByName(b).distinct(), "intersect": a.intersect(b), "intersect_all": a.intersectAll(b),
               "except": a.subtract(b), "except_all": a.exceptAll(b)}
    return rows.union_by_name([df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("op"), "n") for n, df in results.items()])


@query("b16_intersect_rows", """
    SELECT o_custkey AS custkey FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'
    EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'""")
def _(t):
    def keys(condition):
        return t.orders.where(condition).select(F.col("o_custkey").alias("custkey"))
    return keys("o_orderstatus = 'F'").intersect(keys("o_orderstatus = 'P'")).subtract(keys("o_orderpriority = '1-URGENT'"))


@query("b17_distinct_drop_fill", """
    SELECT DISTINCT coalesce(CASE WHEN l_partkey % 3 <> 0 THEN l_suppkey END, -1) AS supplier,
      CASE l_returnflag WHEN 'R' THEN 'returned' ELSE l_returnflag END AS flag
    FROM lineitem WHERE CASE WHEN l_orderkey % 4 <> 0 THEN l_linestatus END IS NOT NULL""")
def _(t):
    df = t.lineitem.select(
        F.when(F.col("l_partkey") % 3 != 0, F.col("l_suppkey")).alias("supplier"), F.col("l_returnflag").alias("flag"),
        F.when(F.col("l_orderkey") % 4 != 0, F.col("l_linestatus")).alias("status"))
    kept = df.dropna(subset=["status"]).fillna(-1, ["supplier"]).replace("R", "returned", ["flag"])
    return kept.dropDuplicates(["supplier", "flag"]).select("supplier", "flag")


@query("b18_hash_sample", """
    SELECT l_orderkey, count(*) AS n FROM lineitem
    WHERE ('0x' || substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 4))::INTEGER % 100 < 20 GROUP BY 1""")
def _(t):
    """A repeatable fifth of the orders, chosen by a hash of the key."""
    bucket = F.conv(F.substring(F.md5(F.col("l_orderkey").cast("string")), 1, 4), 16, 10).cast("int") % 100
    return t.lineitem.where(bucket < 20).groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))


@query("b18_sample")
def _(t):
    return t.lineitem.sample(fraction=0.1, seed=14).select("l_orderkey", "l_linenumber")


@query("b18_sample_share", """
    SELECT l_returnflag, true AS near_share FROM lineitem GROUP BY 1""")
def _(t):
    """Every stratum gives its share of rows within five standard deviations."""
    shares = {"R": 0.5, "A": 0.1, "N": 0.25}
    taken = t.lineitem.sampleBy("l_returnflag", shares, seed=14).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("taken"))
    of = t.lineitem.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n")).join(taken, "l_returnflag", "left")
    share = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])[F.col("l_returnflag")]
    off = F.abs(F.coalesce("taken", F.lit(0)) - F.col("n") * share)
    return of.select("l_returnflag", (off <= 5 * F.sqrt(F.col("n") * share * (1 - share)) + 1).alias("near_share"))


@query("b18_exact_sample", """
    SELECT l_returnflag, l_linestatus, least(count(*), 100) AS n FROM lineitem GROUP BY 1, 2""")
def _(t):
    """A hundred lines of every flag and status, or all there are."""
    taken = sampling.exact_sample(t.lineitem, ["l_returnflag", "l_linestatus"], 100, ["l_orderkey", "l_linenumber"])
    return taken.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@query("b18_weighted_sample", """
    SELECT c_mktsegment, least(count(*) FILTER (c_acctbal > 0), 60) AS n, true AS leans FROM customer GROUP BY 1""")
def _(t):
    """Sixty customers of every segment in proportion to their balance; they are richer than the segment, where it is large enough to tell."""
    taken = sampling.exact_sample(t.customer, ["c_mktsegment"], 60, ["c_custkey"], weight="c_acctbal")
    whole = t.customer.where("c_acctbal > 0").groupBy("c_mktsegment").agg(F.avg("c_acctbal").alias("mean"), F.count(F.lit(1)).alias("of"))
    found = taken.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.avg("c_acctbal").alias("drawn"))
    return found.join(whole, "c_mktsegment").select(
        "c_mktsegment", "n", ((F.col("drawn") > F.col("mean")) | (F.col("of") < 120)).alias("leans"))


@query("b18_sample_by")
def _(t):
    return t.lineitem.sampleBy("l_returnflag", {"R": 0.5, "A": 0.1, "N": 0.0}, seed=14).groupBy("l_returnflag").count()


@query("b19_string_functions", """
    SELECT c_custkey, upper(c_name) AS up, lower(c_mktsegment) AS low, length(c_name) AS len,
      substr(c_name, 10, 4) AS sub, lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS padded, concat_ws('-', c_name, c_mktsegment) AS joined,
      strpos(c_name, '#') AS hash_at, reverse(c_mktsegment) AS reversed, repeat(substr(c_mktsegment, 1, 1), 3) AS repeated,
      translate(c_mktsegment, 'AEI', 'aei') AS translated, string_split(c_name, '#')[2] AS tail,
      levenshtein(c_mktsegment, 'MACHINE') AS distance, ascii(c_mktsegment) AS code, trim('  ' || c_name || ' ') AS trimmed
    FROM customer""")
def _(t):
    name, seg = F.col("c_name"), F.col("c_mktsegment")
    return t.customer.select(
        "c_custkey", F.upper(name).alias("up"), F.lower(seg).alias("low"), F.length(name).cast("long").alias("len"),
        F.substring(name, 10, 4).alias("sub"), F.lpad(F.col("c_custkey").cast("string"), 6, "0").alias("padded"),
        F.concat_ws("-", name, seg).alias("joined"), F.instr(name, "#").cast("long").alias("hash_at"),
        F.reverse(seg).alias("reversed"), F.repeat(F.substring(seg, 1, 1), 3).alias("repeated"),
        F.translate(seg, "AEI", "aei").alias("translated"), F.split(name, "#")[1].alias("tail"),
        F.levenshtein(seg, F.lit("MACHINE")).cast("long").alias("distance"), F.ascii(seg).alias("code"),
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"))


@query("b20_date_functions", """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(quarter(o_orderdate) AS INTEGER) AS q,
      CAST(month(o_orderdate) AS INTEGER) AS m, CAST(day(o_orderdate) AS INTEGER) AS d, CAST(dayofyear(o_orderdate) AS INTEGER) AS doy,
      CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS dow, CAST(weekofyear(o_orderdate) AS INTEGER) AS week,
      CAST(o_orderdate + INTERVAL 30 DAYS AS DATE) AS plus_30, last_day(o_orderdate) AS month_end,
      CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, strftime(o_orderdate, '%Y/%m/%d') AS written,
      datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS days, CAST(o_orderdate + INTERVAL 2 MONTHS AS DATE) AS plus_2m
    FROM orders""")
def _(t):
    at = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey", F.year(at).alias("y"), F.quarter(at).alias("q"), F.month(at).alias("m"), F.dayofmonth(at).alias("d"),
        F.dayofyear(at).alias("doy"), F.dayofweek(at).alias("dow"), F.weekofyear(at).alias("week"),
        F.date_add(at, 30).alias("plus_30"), F.last_day(at).alias("month_end"), F.trunc(at, "month").alias("month_start"),
        F.date_format(at, "yyyy/MM/dd").alias("written"),
        F.datediff(at, F.lit("1995-01-01").cast("date")).cast("long").alias("days"), F.add_months(at, 2).alias("plus_2m"))


@query("b21_math_functions", """
    SELECT o_orderkey, round(sqrt(o_totalprice), 6) AS root, ceil(o_totalprice)::BIGINT AS up, floor(o_totalprice)::BIGINT AS down,
      round(ln(o_totalprice), 6) AS ln, round(log10(o_totalprice), 6) AS lg, round(power(o_totalprice, 0.25), 6) AS fourth,
      o_orderkey % 7 AS rest, o_orderkey & 6 AS bits, xor(o_orderkey, 5) AS flipped, o_orderkey << 2 AS shifted,
      md5(CAST(o_orderkey AS VARCHAR)) AS digest, round(sin(o_totalprice), 6) AS sine, upper(hex(o_orderkey)) AS hexed FROM orders""")
def _(t):
    price, key = F.col("o_totalprice"), F.col("o_orderkey")
    return t.orders.select(
        "o_orderkey", F.round(F.sqrt(price), 6).alias("root"), F.ceil(price).alias("up"), F.floor(price).alias("down"),
        F.round(F.log(price), 6).alias("ln"), F.round(F.log10(price), 6).alias("lg"), F.round(F.pow(price, F.lit(0.25)), 6).alias("fourth"),
        (key % 7).alias("rest"), key.bitwiseAND(6).alias("bits"), key.bitwiseXOR(5).alias("flipped"), F.shiftleft(key, 2).alias("shifted"),
        F.md5(key.cast("string")).alias("digest"), F.round(F.sin(price), 6).alias("sine"), F.hex(key).alias("hexed"))


@query("b21_digests", """
    SELECT o_orderkey, sha256(CAST(o_orderkey AS VARCHAR)) AS sha, md5(o_orderpriority) AS md5 FROM orders""")
def _(t):
    return t.orders.select("o_orderkey", F.sha2(F.col("o_orderkey").cast("string"), 256).alias("sha"), F.md5("o_orderpriority").alias("md5"))


@query("b21_hash_functions")
def _(t):
    key = F.col("o_orderkey")
    return t.orders.select("o_orderkey", F.xxhash64(key).alias("xx"), F.hash(key).alias("murmur"),
                           F.crc32(key.cast("string")).alias("crc"), F.sha2(key.cast("string"), 256).alias("sha"))


@query("b22_array_functions", """
    SELECT vec_id, len(embedding) AS n, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x)), 5) AS norm,
      round(CAST(list_max(embedding) AS DOUBLE), 6) AS top, len(list_filter(embedding, lambda x: x > 0)) AS positives,
      round(CAST(embedding[3] AS DOUBLE), 6) AS third, len(list_filter(embedding, lambda x: x > 0.3)) > 0 AS has_large,
      list_transform(embedding[1:2], lambda x: round(CAST(x AS DOUBLE), 6)) AS head FROM embeddings""")
def _(t):
    v = F.col("embedding")
    return t.embeddings.select(
        "vec_id", F.size(v).cast("long").alias("n"),
        F.round(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x), 5).alias("norm"),
        F.round(F.array_max(v).cast("double"), 6).alias("top"), F.size(F.filter(v, lambda x: x > 0)).cast("long").alias("positives"),
        F.round(F.element_at(v, 3).cast("double"), 6).alias("third"), F.exists(v, lambda x: x > 0.3).alias("has_large"),
        F.transform(F.slice(v, 1, 2), lambda x: F.round(x.cast("double"), 6)).alias("head"))


@query("b22_array_sets", """
    WITH w AS (SELECT conv_id, turn, string_split(text, ' ') AS ws FROM conversations)
    SELECT conv_id, turn, len(list_distinct(ws)) AS n_words, list_contains(ws, 'the') AS has_the,
      array_to_string(list_sort(list_distinct(list_filter(ws, lambda x: length(x) = 2))), ' ') AS short FROM w""")
def _(t):
    words = F.split("text", " ")
    short = F.array_sort(F.array_distinct(F.filter(words, lambda x: F.length(x) == 2)))
    return t.conversations.select(
        "conv_id", "turn", F.size(F.array_distinct(words)).cast("long").alias("n_words"),
        F.array_contains(words, "the").alias("has_the"), F.array_join(short, " ").alias("short"))


@query("b23_map_functions", """
    WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2)
    SELECT user_id, event_type, n * 10 AS scaled FROM c WHERE n >= 10""")
def _(t):
    """Counts per type as one map per user, filtered and scaled as a map, then as rows."""
    counts = t.events.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    # At most one entry per event type.
    maps = counts.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("m"))
    kept = F.transform_values(F.map_filter("m", lambda k, v: v >= 10), lambda k, v: v * 10)
    return maps.select("user_id", F.explode(kept).alias("event_type", "scaled"))


@query("b24_json_functions", """
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k') AS k_text,
      '{"id":' || event_id || ',"kind":"' || event_type || '"}' AS packed, event_type || ',' || user_id AS line FROM events""")
def _(t):
    parsed = F.from_json("props", "k bigint")
    return t.events.select(
        "event_id", parsed["k"].alias("k"), F.get_json_object("props", "$.k").alias("k_text"),
        F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"))).alias("packed"),
        F.to_csv(F.struct("event_type", "user_id")).alias("line"))


@query("b25_explode", """
    WITH w AS (SELECT conv_id, turn, CASE WHEN turn % 3 <> 0 THEN string_split(text, ' ') END AS ws FROM conversations)
    SELECT conv_id, turn, i - 1 AS pos, ws[i] AS word FROM w, LATERAL (SELECT unnest(range(1, len(ws) + 1)) AS i) WHERE ws IS NOT NULL
    UNION ALL SELECT conv_id, turn, NULL, NULL FROM w WHERE ws IS NULL""")
def _(t):
    words = F.when(F.col("turn") % 3 != 0, F.split("text", " "))
    return t.conversations.select("conv_id", "turn", F.posexplode_outer(words).alias("pos", "word")).select(
        "conv_id", "turn", F.col("pos").cast("long").alias("pos"), "word")


@query("b25_unpivot", """
    SELECT p_partkey, 'size' AS measure, CAST(p_size AS DOUBLE) AS value FROM part
    UNION ALL SELECT p_partkey, 'price', p_retailprice FROM part""")
def _(t):
    wide = t.part.select("p_partkey", F.col("p_size").cast("double").alias("size"), F.col("p_retailprice").alias("price"))
    return wide.unpivot("p_partkey", ["size", "price"], "measure", "value")


@query("b27_conditionals", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
      CASE WHEN l_quantity > 25 THEN 'large' WHEN l_quantity > 10 THEN 'medium' ELSE 'small' END AS size,
      greatest(l_tax, l_discount) + 0.0 AS high, least(l_tax, l_discount) + 0.0 AS low,
      coalesce(nullif(l_discount, 0), -1) AS discount, nullif(l_returnflag, 'N') AS flag FROM lineitem""")
def _(t):
    q = F.col("l_quantity")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        F.when(q > 25, "large").when(q > 10, "medium").otherwise("small").alias("size"),
        (F.greatest("l_tax", "l_discount") + F.lit(0.0)).alias("high"), (F.least("l_tax", "l_discount") + F.lit(0.0)).alias("low"),
        F.coalesce(F.nullif("l_discount", F.lit(0.0)), F.lit(-1.0)).alias("discount"), F.nullif("l_returnflag", F.lit("N")).alias("flag"))


_SUBQUERY = """
    SELECT o_orderkey, o_totalprice FROM orders o
    WHERE o_totalprice > (SELECT avg(i.o_totalprice) FROM orders i WHERE i.o_custkey = o.o_custkey)
      AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
      AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')
      AND o_totalprice < (SELECT max(o_totalprice) FROM orders)"""


@query("b28_subqueries", _SUBQUERY)
def _(t):
    for name in ("orders", "customer", "lineitem"):
        getattr(t, name).createOrReplaceTempView(name)
    return t.spark.sql(_SUBQUERY)
