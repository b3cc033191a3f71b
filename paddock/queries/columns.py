"""Projection, filter and repair rules on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from paddock.functions import columns as C
from paddock.operators import joins, profile, rows
from paddock.queries.registry import query

# Ranges of part positions and the group each one stands for.
POSITION_RANGES = ((0, 57, "sc"), (58, 167, "xf"), (168, 288, "cw"))
PRIORITY_CODES = {" 1-URGENT": "u", " 2-HIGH": "h", "3-MEDIUM &amp; up": "m", " 5-LOW": "l"}


# Projections

@query("p01_drop_listed", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def _(t):
    return C.drop_listed(t.orders, ["o_orderstatus", "o_orderpriority"])


@query("p02_drop_tolerant", "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def _(t):
    return C.drop_listed(t.customer, ["c_mktsegment", "college"])


@query("p03_constant_column", "SELECT n_nationkey, n_name, 'xf' AS series, 2022 AS season FROM nation")
def _(t):
    return C.with_constant(t.nation, series="xf", season=2022).drop("n_regionkey")


@query("p04_select", "SELECT l_orderkey, l_quantity FROM lineitem")
def _(t):
    return t.lineitem.select("l_orderkey", "l_quantity")


@query("p05_rename", "SELECT s_suppkey AS id, s_name AS full_name, s_nationkey AS nation_id, s_acctbal FROM supplier")
def _(t):
    return t.supplier.withColumnsRenamed({"s_suppkey": "id", "s_name": "full_name", "s_nationkey": "nation_id"})


@query("p06_try_cast", """
    SELECT p_partkey, TRY_CAST(p_name AS DOUBLE) AS p_name,
           TRY_CAST(substr(p_brand, 7) AS INTEGER) AS brand_no FROM part""")
def _(t):
    df = t.part.select("p_partkey", "p_name", F.substring("p_brand", 7, 9).alias("brand_no"))
    return C.try_cast_columns(df, {"p_name": "double", "brand_no": "int"})


@query("p07_years_since", """
    SELECT o_orderkey, CAST(2022 - year(o_orderdate) AS INTEGER) AS experience FROM orders""")
def _(t):
    return t.orders.select("o_orderkey", C.years_since(F.year("o_orderdate")).alias("experience"))


@query("p08_ratio_or_zero", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
           round(coalesce(l_tax / NULLIF(l_discount, 0), 0.0), 6) + 0.0 AS ratio FROM lineitem""")
def _(t):
    ratio = F.round(C.ratio_or_zero(F.col("l_tax"), F.col("l_discount")), 6) + F.lit(0.0)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
                             ratio.alias("ratio"))


@query("p09_rank_band", """
    SELECT p_partkey, p_size, CASE WHEN p_size BETWEEN 0 AND 10 THEN 1 WHEN p_size BETWEEN 11 AND 30 THEN 2
           WHEN p_size BETWEEN 31 AND 50 THEN 3 ELSE 4 END AS band FROM part""")
def _(t):
    return t.part.select("p_partkey", "p_size", C.rank_band(F.col("p_size")).alias("band"))


@query("p10_flag_label", """
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'F' ELSE 'M' END AS gender FROM customer""")
def _(t):
    return t.customer.select("c_custkey", C.flag_label(F.col("c_acctbal") < 0).alias("gender"))


@query("p11_by_position", """
    SELECT p_partkey, CASE WHEN p_partkey BETWEEN 0 AND 57 THEN 'sc' WHEN p_partkey BETWEEN 58 AND 167 THEN 'xf'
           WHEN p_partkey BETWEEN 168 AND 288 THEN 'cw' END AS series FROM part""")
def _(t):
    return t.part.select("p_partkey", C.by_position(F.col("p_partkey"), POSITION_RANGES).alias("series"))


@query("p13_columns_by_type", """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
           l_tax, l_returnflag, l_linestatus FROM lineitem""")
def _(t):
    return t.lineitem.select(*C.columns_except_time(t.lineitem))


@query("p14_schema_rows", """
    SELECT count(*) AS n_rows, v.position, v."column", v.type FROM orders, (VALUES (0, 'o_orderkey', 'bigint'), (1, 'o_custkey', 'bigint'),
      (2, 'o_orderstatus', 'string'), (3, 'o_totalprice', 'double'), (4, 'o_orderdate', 'timestamp_ntz'), (5, 'o_orderpriority', 'string'))
      v(position, "column", type) GROUP BY ALL""")
def _(t):
    """Position, name, type of every column next to the row count of the table."""
    described = F.explode(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(n).alias("column"), F.lit(k).alias("type"))
        for i, n, k, _ in profile.schema_rows(t.orders)]))
    return profile.shape(t.orders).select("n_rows", described.alias("c")).select("n_rows", "c.*")


# Filters

@query("f01_null_filter", """
    SELECT c.c_custkey, c.c_name FROM customer c LEFT JOIN
      (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 300000) o
      ON c.c_custkey = o.o_custkey WHERE o.o_custkey IS NULL""")
def _(t):
    urgent = t.orders.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 300000))
    joined = t.customer.join(urgent.select("o_custkey").distinct(),
                             F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.where(F.col("o_custkey").isNull()).select("c_custkey", "c_name")


@query("f02_conjunction", """
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'""")
def _(t):
    both = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "2-HIGH")
    return t.orders.where(both).select("o_orderkey", "o_totalprice")


@query("f03_contains", """
    SELECT p_partkey, p_name, contains(p_name, 'bolt') AS has_text,
           regexp_matches(p_name, '^s.*t$') AS has_pattern FROM part""")
def _(t):
    name = F.col("p_name")
    return t.part.select("p_partkey", "p_name", C.contains_text(name, "bolt").alias("has_text"),
                         C.matches(name, "^s.*t$").alias("has_pattern"))


@query("f04_membership", """
    SELECT p_partkey, p_brand, coalesce(CASE WHEN p_partkey % 7 <> 0 THEN p_brand END
           IN ('Brand#1', 'Brand#5', 'Brand#13'), false) AS listed FROM part""")
def _(t):
    brand = F.when(F.col("p_partkey") % 7 != 0, F.col("p_brand"))
    return t.part.select("p_partkey", "p_brand",
                         C.is_listed(brand, ["Brand#1", "Brand#5", "Brand#13"]).alias("listed"))


@query("f04_membership_table", """
    SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'
           AND o_totalprice > 300000) AS listed FROM customer""")
def _(t):
    """Membership in a list that is itself a table: distinct first, then one left join."""
    members = (t.orders.where("o_orderpriority = '1-URGENT' AND o_totalprice > 300000")
               .select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("m", F.lit(True)))
    flagged = t.customer.select("c_custkey").join(members, "c_custkey", "left")
    return flagged.select("c_custkey", F.coalesce("m", F.lit(False)).alias("listed"))


@query("f05_delete_where", """
    SELECT p_partkey, CASE WHEN p_partkey % 5 <> 0 THEN p_type END AS p_type FROM part
    WHERE CASE WHEN p_partkey % 5 <> 0 THEN p_type END IS DISTINCT FROM 'PROMO'""")
def _(t):
    kind = F.when(F.col("p_partkey") % 5 != 0, F.col("p_type"))
    return C.delete_where(t.part.select("p_partkey", kind.alias("p_type")), F.col("p_type") == "PROMO")


_HANDLES = """
    WITH h AS (SELECT DISTINCT o_custkey AS driver_id,
               CASE WHEN o_orderkey % 3 <> 0 THEN 'h' || (o_orderkey % 5) END AS twitter FROM orders)"""


@query("f06_unique_or_complete", _HANDLES + """
    SELECT driver_id, twitter FROM (SELECT *, count(*) OVER (PARTITION BY driver_id) AS n FROM h)
    WHERE n = 1 OR twitter IS NOT NULL""")
def _(t):
    handle = F.when(F.col("o_orderkey") % 3 != 0, F.concat(F.lit("h"), F.col("o_orderkey") % 5))
    handles = t.orders.select(F.col("o_custkey").alias("driver_id"), handle.alias("twitter")).distinct()
    return rows.unique_or_complete(handles, ["driver_id"])


def _with_gaps(t):
    """lineitem measures with NULL and NaN put in by rule."""
    key = F.col("l_orderkey")
    return t.lineitem.select(
        F.when(key % 7 != 0, F.col("l_quantity")).alias("quantity"),
        F.when(key % 11 == 0, F.lit(float("nan"))).otherwise(F.col("l_discount")).alias("discount"),
        F.when(key % 3 == 0, F.col("l_returnflag")).alias("flag"),
        F.col("l_tax").alias("tax"), F.col("l_shipdate").alias("shipdate"))


_GAPS = """
    WITH g AS (SELECT CASE WHEN l_orderkey % 7 <> 0 THEN l_quantity END AS quantity,
      CASE WHEN l_orderkey % 11 = 0 THEN 'NaN'::DOUBLE ELSE l_discount END AS discount,
      CASE WHEN l_orderkey % 3 = 0 THEN l_returnflag END AS flag, l_tax AS tax, l_shipdate AS shipdate FROM lineitem),
    m AS (SELECT 'quantity' AS "column", count(*) FILTER (quantity IS NULL) AS n_null,
                 count(*) FILTER (isnan(quantity)) AS n_nan, count(*) AS n_rows FROM g
     UNION ALL SELECT 'discount', count(*) FILTER (discount IS NULL), count(*) FILTER (isnan(discount)), count(*) FROM g
     UNION ALL SELECT 'flag', count(*) FILTER (flag IS NULL), 0, count(*) FROM g
     UNION ALL SELECT 'tax', count(*) FILTER (tax IS NULL), count(*) FILTER (isnan(tax)), count(*) FROM g)"""


@query("f07_columns_with_missing", _GAPS + """
    SELECT "column", n_null, n_nan FROM m WHERE n_null + n_nan > 0""")
def _(t):
    df = _with_gaps(t)
    return profile.columns_with_missing(df, C.columns_except_time(df)).select("column", "n_null", "n_nan")


@query("a01_missing_count", _GAPS + ' SELECT "column", n_null, n_nan FROM m')
def _(t):
    df = _with_gaps(t)
    return profile.missing_profile(df, C.columns_except_time(df)).select("column", "n_null", "n_nan")


@query("a02_missing_share", _GAPS + """
    SELECT "column", round((n_null + n_nan) / n_rows, 6) AS share FROM m""")
def _(t):
    df = _with_gaps(t)
    return profile.missing_profile(df, C.columns_except_time(df)).select("column", F.round("share", 6).alias("share"))


# Repair

@query("n01_fill_from_column", """
    SELECT c_custkey, coalesce(CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END, c_name) AS filled FROM customer""")
def _(t):
    partial = F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment"))
    return t.customer.select("c_custkey", F.coalesce(partial, F.col("c_name")).alias("filled"))


@query("n02_fill_constant", """
    SELECT p_partkey, coalesce(CASE WHEN p_partkey % 4 <> 0 THEN p_size END, 9) AS p_size,
           CASE WHEN p_partkey % 5 = 0 THEN 1.5 ELSE p_retailprice END AS p_retailprice FROM part""")
def _(t):
    price = F.when(F.col("p_partkey") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("p_retailprice"))
    size = F.when(F.col("p_partkey") % 4 != 0, F.col("p_size"))
    return t.part.select("p_partkey", size.alias("p_size"), price.alias("p_retailprice")).na.fill(
        {"p_size": 9, "p_retailprice": 1.5})


@query("n03_encode_missing", """
    SELECT CAST(p_partkey AS VARCHAR) AS p_partkey,
           coalesce(CASE WHEN p_partkey % 4 <> 0 THEN p_brand END, 'nan value') AS p_brand,
           coalesce(CASE WHEN p_partkey % 6 <> 0 THEN CAST(p_size AS VARCHAR) END, 'nan value') AS p_size FROM part""")
def _(t):
    key = F.col("p_partkey")
    return C.encode_missing(t.part.select(
        key, F.when(key % 4 != 0, F.col("p_brand")).alias("p_brand"),
        F.when(key % 6 != 0, F.col("p_size")).alias("p_size")))


@query("n04_decode_missing", """
    SELECT c_custkey, CASE WHEN c_custkey % 4 < 2 THEN NULL ELSE c_name END AS c_name, c_mktsegment FROM customer""")
def _(t):
    key = F.col("c_custkey") % 4
    name = F.when(key == 0, F.lit("nan value")).when(key == 1, F.lit("nan")).otherwise(F.col("c_name"))
    return C.decode_missing(t.customer.select("c_custkey", name.alias("c_name"), "c_mktsegment"))


@query("n05_blank_to_null", """
    SELECT c_custkey, nullif(regexp_replace(c_mktsegment, 'BUILDING', ''), '') AS segment FROM customer""")
def _(t):
    emptied = F.regexp_replace("c_mktsegment", "BUILDING", "")
    return t.customer.select("c_custkey", C.blank_to_null(emptied).alias("segment"))


def _override_rows(t):
    """Overrides taken from the orders: the order key is their sequence."""
    return t.orders.select(
        F.col("o_orderkey").alias("seq"), F.col("o_custkey").alias("c_custkey"),
        F.when(F.col("o_orderkey") % 2 == 0, F.element_at(F.array(
            F.lit("BUILDING"), F.lit("MACHINERY")), (F.col("o_orderkey") % 4 / 2 + 1).cast("int"))).alias("c_mktsegment"),
        F.col("o_orderpriority").alias("value"))


@query("n06_override_one_key", """
    SELECT c_custkey, coalesce(v, c_name) AS c_name FROM customer LEFT JOIN
      (SELECT o_custkey, arg_max(o_orderpriority, o_orderkey) AS v FROM orders WHERE o_totalprice > 400000 GROUP BY 1)
      ON c_custkey = o_custkey""")
def _(t):
    wanted = t.orders.where("o_totalprice > 400000").select(
        F.col("o_orderkey").alias("seq"), F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("value"))
    return joins.apply_overrides(t.customer.select("c_custkey", "c_name"), wanted, "c_custkey", "c_name")


@query("n07_override_two_keys", """
    SELECT c_custkey, c_mktsegment, coalesce(v, c_name) AS c_name FROM customer LEFT JOIN
      (SELECT o_custkey, CASE WHEN o_orderkey % 4 < 2 THEN 'BUILDING' ELSE 'MACHINERY' END AS seg,
              arg_max(o_orderpriority, o_orderkey) AS v FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1, 2)
      ON c_custkey = o_custkey AND c_mktsegment = seg""")
def _(t):
    wanted = _override_rows(t).where(F.col("c_mktsegment").isNotNull())
    return joins.apply_overrides(t.customer.select("c_custkey", "c_mktsegment", "c_name"), wanted, "c_custkey",
                                 "c_name", second_key="c_mktsegment")


@query("n08_ordered_overrides", """
    SELECT c_custkey, c_mktsegment, coalesce(v, c_name) AS c_name FROM customer LEFT JOIN
      (SELECT c_custkey AS k, arg_max(o_orderpriority, o_orderkey) AS v FROM orders JOIN customer ON o_custkey = c_custkey
       WHERE o_orderkey % 2 = 1 OR c_mktsegment = CASE WHEN o_orderkey % 4 < 2 THEN 'BUILDING' ELSE 'MACHINERY' END
       GROUP BY 1) ON c_custkey = k""")
def _(t):
    return joins.apply_overrides(t.customer.select("c_custkey", "c_mktsegment", "c_name"), _override_rows(t),
                                 "c_custkey", "c_name", second_key="c_mktsegment")


@query("n09_strip_pattern", r"""
    SELECT c_custkey, regexp_replace(c_name, '#0*', '', 'g') AS handle,
           regexp_replace('(''' || c_name || ''', ''x'')', ',\s[(]|[(]|['']', '', 'g') AS cell FROM customer""")
def _(t):
    cell = F.concat(F.lit("('"), F.col("c_name"), F.lit("', 'x')"))
    return t.customer.select("c_custkey", C.strip_pattern(F.col("c_name"), "#0*").alias("handle"),
                             C.strip_pattern(cell, r",\s[(]|[(]|[']").alias("cell"))


@query("n10_value_mapping", """
    SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'u' WHEN '2-HIGH' THEN 'h'
           WHEN '3-MEDIUM' THEN 'm' WHEN '5-LOW' THEN 'l' ELSE ' ' || o_orderpriority END AS code FROM orders""")
def _(t):
    suffixed = F.when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("3-MEDIUM &amp; up")).otherwise(
        F.concat(F.lit(" "), F.col("o_orderpriority")))
    return t.orders.select("o_orderkey", C.map_values(suffixed, PRIORITY_CODES).alias("code"))


@query("n11_drop_sparse", """
    SELECT CASE WHEN l_orderkey % 7 <> 0 THEN l_quantity END AS quantity,
           CASE WHEN l_orderkey % 11 = 0 THEN 'NaN'::DOUBLE ELSE l_discount END AS discount,
           l_tax AS tax, l_shipdate AS shipdate FROM lineitem""")
def _(t):
    return profile.drop_sparse(_with_gaps(t), 0.5)


@query("n12_impute_zero_filled", _GAPS + """
    , z AS (SELECT sum(coalesce(quantity, 0)) / count(*) AS q,
                   sum(CASE WHEN isnan(discount) THEN 0 ELSE discount END) / count(*) AS d FROM g)
    SELECT round(coalesce(quantity, q), 4) AS quantity,
           round(CASE WHEN isnan(discount) THEN d ELSE discount END, 4) AS discount FROM g, z""")
def _(t):
    filled = profile.impute_zero_filled(_with_gaps(t), ["quantity", "discount"])
    return filled.select(F.round("quantity", 4).alias("quantity"), F.round("discount", 4).alias("discount"))


# Profiles

@query("a03_sum_count", """
    SELECT round(sum(l_quantity), 2) AS total, count(*) AS n FROM lineitem""")
def _(t):
    return t.lineitem.agg(F.round(F.sum("l_quantity"), 2).alias("total"), F.count(F.lit(1)).alias("n"))


@query("a04_zero_filled_mean", _GAPS + """
    SELECT round(sum(coalesce(quantity, 0)) / count(*), 6) AS quantity, round(avg(quantity), 6) AS plain_mean,
           round(sum(CASE WHEN isnan(discount) THEN 0 ELSE discount END) / count(*), 6) AS discount FROM g""")
def _(t):
    return _with_gaps(t).agg(
        F.round(profile.zero_filled_mean(F.col("quantity")), 6).alias("quantity"),
        F.round(F.avg("quantity"), 6).alias("plain_mean"),
        F.round(profile.zero_filled_mean(F.col("discount")), 6).alias("discount"))


_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


@query("a05_summary", " UNION ALL ".join(f"""
    SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev,
           round(CAST(min({c}) AS DOUBLE), 6) + 0.0 AS min, round(CAST(max({c}) AS DOUBLE), 6) AS max FROM lineitem"""
                                        for c in _MEASURES))
def _(t):
    rounded = [F.round(c, 6).alias(c) for c in ("mean", "stddev", "max")]
    low = (F.round("min", 6) + F.lit(0.0)).alias("min")
    return profile.summary(t.lineitem, _MEASURES).select("column", "n", *rounded, low)


_CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "net", "constant"]


@query("a06_correlated_pairs", """
    WITH d AS (SELECT l_quantity, l_extendedprice, l_discount, l_extendedprice * (1 - l_discount) AS net FROM lineitem),
    c AS (SELECT 'l_quantity' AS x, 'l_extendedprice' AS y, corr(l_quantity, l_extendedprice) AS r FROM d
      UNION ALL SELECT 'l_quantity', 'l_discount', corr(l_quantity, l_discount) FROM d
      UNION ALL SELECT 'l_quantity', 'net', corr(l_quantity, net) FROM d
      UNION ALL SELECT 'l_extendedprice', 'l_discount', corr(l_extendedprice, l_discount) FROM d
      UNION ALL SELECT 'l_extendedprice', 'net', corr(l_extendedprice, net) FROM d
      UNION ALL SELECT 'l_discount', 'net', corr(l_discount, net) FROM d)
    SELECT x, y, round(r, 6) AS corr FROM c WHERE r >= 0.7
    UNION ALL SELECT y, x, round(r, 6) FROM c WHERE r >= 0.7""")
def _(t):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    df = t.lineitem.withColumns({"net": net, "constant": F.lit(1.0)})
    return profile.correlated_pairs(df, _CORR_COLS).select("x", "y", F.round("corr", 6).alias("corr"))


@query("a07_shape", "SELECT count(*) AS n_rows, 11 AS n_columns FROM lineitem")
def _(t):
    return profile.shape(t.lineitem)
