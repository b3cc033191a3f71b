"""The statistics store built from the given tables.

Every order stands for one payload record: the customer is the driver, the order
status the series, the order year the season and the order key the position.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from paddock import contracts
from paddock.operators.rows import union_by_name
from paddock.plans import league
from paddock.queries.registry import query
from paddock.session import kept, workspace

_SERIES_SQL = "CASE o_orderstatus WHEN 'F' THEN 'sc' WHEN 'O' THEN 'xf' ELSE 'cw' END"


def _records(t):
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    series = F.when(F.col("o_orderstatus") == "F", "sc").when(F.col("o_orderstatus") == "O", "xf").otherwise("cw")
    return joined.withColumns({
        "id": F.concat(F.lit("d"), F.col("c_custkey")), "series": series, "season": F.year("o_orderdate").cast("string"),
        "pos": F.col("o_orderkey"), "full_name": F.col("c_name"), "first_name": F.substring("c_name", 1, 8),
        "last_name": F.substring("c_name", 10, 20)})


def stats_payload(t):
    c, o = F.col("c_custkey"), F.col("o_orderkey")
    return _records(t).select(
        "id", "first_name", "last_name", "full_name", "series", "season", "pos",
        F.when(c % 3 == 1, "M").when(c % 3 == 2, "F").alias("gender"),
        F.when(c % 4 == 0, F.lit("nan value")).otherwise((c % 50 + 150).cast("string")).alias("height"),
        (c % 40 + 60).cast("string").alias("weight"),
        F.concat(1960 + c % 40, F.lit("-03-07")).alias("birthday"),
        F.when(c % 5 == 0, F.lit("nan")).otherwise(F.concat(F.lit("City "), F.col("c_nationkey"))).alias("birth_place"),
        F.col("n_name").alias("country"),
        F.when(o % 4 != 0, F.concat(F.lit("@h"), o % 3)).alias("twitter"),
        F.when(c % 3 == 0, (1990 + c % 30).cast("int")).alias("rookie_year"),
        F.col("o_orderstatus").alias("status"), F.col("c_mktsegment").alias("residence"))


def standings_payload(t):
    o, price = F.col("o_orderkey"), F.col("o_totalprice")

    def count(n):
        return (o % n).cast("int")

    return _records(t).select(
        "id", "first_name", "last_name", "full_name", "series", "season", "pos",
        F.concat(F.lit("s"), F.col("c_custkey") % 4).alias("status"),
        count(61).alias("rank"), count(37).alias("starts"), count(1000).alias("points"), count(7).alias("wins"),
        F.when(o % 5 != 0, count(5)).alias("stage_wins"), count(3).alias("poles"), count(11).alias("top_5"),
        count(13).alias("top_10"), count(17).alias("top_15"), count(19).alias("top_20"),
        F.when(o % 3 != 0, (o % 20).cast("double")).alias("chase_bonus"), F.when(o % 9 == 0, (o % 4).cast("double")).alias("chase_wins"),
        F.when(o % 8 == 0, (o % 2).cast("double")).alias("chase_stage_wins"), count(500).alias("laps_led"),
        count(5000).alias("laps_completed"), (o % 40 + 0.5).cast("double").alias("avg_start_position"),
        (o % 43 + 0.25).cast("double").alias("avg_finish_position"), (price / 1000).alias("avg_laps_completed"),
        (o % 100 / F.lit(100.0)).alias("laps_led_pct"), count(6).alias("dnf"), (o % 2 == 0).alias("in_chase"),
        (-(o % 300)).cast("double").alias("behind"), price.alias("money"))


_RECORDS = f"""
    r AS (SELECT 'd' || c_custkey AS id, {_SERIES_SQL} AS series, CAST(CAST(year(o_orderdate) AS INTEGER) AS VARCHAR) AS season,
      o_orderkey AS pos, c_name AS full_name, substr(c_name, 1, 8) AS first_name, substr(c_name, 10) AS last_name,
      c_custkey, c_nationkey, n_name, o_orderkey, o_totalprice, c_mktsegment
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""
_STATS = f"""{_RECORDS},
    st AS (SELECT id, first_name, last_name, full_name, series, CASE c_custkey % 3 WHEN 1 THEN 'M' WHEN 2 THEN 'F' END AS gender,
      CASE WHEN c_custkey % 4 = 0 THEN 'nan value' ELSE CAST(c_custkey % 50 + 150 AS VARCHAR) END AS height,
      CAST(c_custkey % 40 + 60 AS VARCHAR) AS weight, (1960 + c_custkey % 40) || '-03-07' AS birthday,
      CASE WHEN c_custkey % 5 = 0 THEN 'nan' ELSE 'City ' || c_nationkey END AS birth_place, n_name AS country,
      CASE WHEN o_orderkey % 4 <> 0 THEN '@h' || (o_orderkey % 3) END AS twitter,
      CASE WHEN c_custkey % 3 = 0 THEN CAST(1990 + c_custkey % 30 AS INTEGER) END AS rookie_year
      FROM r QUALIFY row_number() OVER (PARTITION BY id, series ORDER BY season DESC, pos) = 1)"""
_STANDINGS = f"""{_RECORDS},
    sd AS (SELECT id, first_name, last_name, full_name, series, season, 's' || (c_custkey % 4) AS status,
      CAST(o_orderkey % 61 AS INTEGER) AS rank, CAST(o_orderkey % 37 AS INTEGER) AS starts, CAST(o_orderkey % 1000 AS INTEGER) AS points,
      CAST(o_orderkey % 7 AS INTEGER) AS wins, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 5 AS INTEGER) END AS stage_wins,
      CAST(o_orderkey % 3 AS INTEGER) AS poles, CAST(o_orderkey % 11 AS INTEGER) AS top_5, CAST(o_orderkey % 13 AS INTEGER) AS top_10,
      CAST(o_orderkey % 17 AS INTEGER) AS top_15, CAST(o_orderkey % 19 AS INTEGER) AS top_20,
      CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderkey % 20 AS DOUBLE) END AS chase_bonus,
      CASE WHEN o_orderkey % 9 = 0 THEN CAST(o_orderkey % 4 AS DOUBLE) END AS chase_wins,
      CASE WHEN o_orderkey % 8 = 0 THEN CAST(o_orderkey % 2 AS DOUBLE) END AS chase_stage_wins,
      CAST(o_orderkey % 500 AS INTEGER) AS laps_led, CAST(o_orderkey % 5000 AS INTEGER) AS laps_completed,
      CAST(o_orderkey % 40 + 0.5 AS DOUBLE) AS avg_start_position, CAST(o_orderkey % 43 + 0.25 AS DOUBLE) AS avg_finish_position,
      o_totalprice / 1000 AS avg_laps_completed, o_orderkey % 100 / 100.0::DOUBLE AS laps_led_pct, CAST(o_orderkey % 6 AS INTEGER) AS dnf,
      o_orderkey % 2 = 0 AS in_chase, CAST(-(o_orderkey % 300) AS DOUBLE) AS behind, o_totalprice AS money
      FROM r QUALIFY row_number() OVER (PARTITION BY id, series, season ORDER BY pos) = 1)"""


@query("c01_build_stats", f"WITH {_STATS} SELECT * FROM st")
def _(t):
    return league.build_stats(stats_payload(t))


@query("c02_build_standings", f"WITH {_STANDINGS} SELECT * FROM sd")
def _(t):
    return league.build_standings(standings_payload(t))


# Enrichment. The debut list, the pages and the overrides come from the tables too.

def _debut_inputs(t):
    c, name = F.col("c_custkey"), F.col("c_name").alias("full_name")
    listed = t.customer.where(c % 4 == 1).select(name, c.alias("pos"), (2000 + c % 20).cast("int").alias("rookie_year"))
    debut = listed.withColumn("series", F.lit("sc")).unionByName(
        listed.withColumns({"series": F.lit("sc"), "pos": F.col("pos") + 1_000_000_000, "rookie_year": F.col("rookie_year") + 1}))
    others = t.customer.where(c % 5 == 2).select(name, c.alias("pos"), (1970 + c % 20).cast("int").alias("rookie_year"))
    year = F.concat(F.lit("20"), F.lpad((c % 20).cast("string"), 2, "0"))
    link = F.concat(F.lit('<a href="/r" title="'), year, F.lit(' League Xfinity Series">'), year, F.lit("</a>"))
    line = F.concat(F.lit("\n<li>First race "), F.when(c % 3 != 0, link).otherwise(F.lit("")), F.lit("</li>\n"))
    key = F.when(c % 2 == 0, F.col("c_name")).otherwise(F.concat("c_name", F.lit("_(racing_driver)")))
    pages = t.pages.join(t.customer, F.col("page_id") == c).select(key.alias("page_key"), F.concat("html", line).alias("html"))
    names = t.customer.select(name)
    aliases = t.customer.where(c % 7 == 0).select(name, F.concat(F.lit("Customer#"), F.lpad((c + 1).cast("string"), 9, "0"), F.lit("_(racing_driver)")).alias("page_key"))
    late = t.orders.where("o_totalprice > 450000").join(t.customer, F.col("o_custkey") == c)
    overrides = late.select(F.col("o_orderkey").alias("seq"), name, F.when(F.col("o_orderkey") % 2 == 1, F.lit("xf")).alias("series"),
                            (1900 + F.col("o_orderkey") % 100).cast("int").alias("value"))
    return debut, others, league.page_races(names, pages, aliases, "League"), overrides


@query("c03_debut_enrichment", f"""
    WITH {_STATS},
    d AS (SELECT c_name AS full_name, CAST(2000 + c_custkey % 20 AS INTEGER) AS y FROM customer WHERE c_custkey % 4 = 1),
    o AS (SELECT c_name AS full_name, CAST(1970 + c_custkey % 20 AS INTEGER) AS y FROM customer WHERE c_custkey % 5 = 2),
    k AS (SELECT c_name AS full_name, c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE c_name || '_(racing_driver)' END AS page_key
          FROM customer JOIN pages ON page_id = c_custkey WHERE c_custkey % 3 <> 0),
    n AS (SELECT c_name AS full_name, 1 AS tier, c_name AS page_key FROM customer
      UNION ALL SELECT c_name, 2, c_name || '_(racing_driver)' FROM customer
      UNION ALL SELECT c_name, 3, 'Customer#' || lpad(CAST(c_custkey + 1 AS VARCHAR), 9, '0') || '_(racing_driver)' FROM customer WHERE c_custkey % 7 = 0),
    p AS (SELECT n.full_name, CAST('20' || lpad(CAST(c_custkey % 20 AS VARCHAR), 2, '0') AS INTEGER) AS y FROM n JOIN k USING (page_key)
          QUALIFY row_number() OVER (PARTITION BY n.full_name ORDER BY tier, page_key) = 1),
    v AS (SELECT o_orderkey AS seq, c_name AS full_name, CASE WHEN o_orderkey % 2 = 1 THEN 'xf' END AS series,
                 CAST(1900 + o_orderkey % 100 AS INTEGER) AS y FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 450000),
    w AS (SELECT st.id, st.series, arg_max(v.y, v.seq) AS y FROM st JOIN v ON v.full_name = st.full_name AND (v.series IS NULL OR v.series = st.series) GROUP BY 1, 2)
    SELECT st.id, st.series, st.full_name, coalesce(w.y, st.rookie_year, d.y, o.y, p.y) AS rookie_year
    FROM st LEFT JOIN d ON d.full_name = st.full_name AND st.series = 'sc' LEFT JOIN o ON o.full_name = st.full_name
    LEFT JOIN p ON p.full_name = st.full_name AND st.series = 'xf' LEFT JOIN w ON w.id = st.id AND w.series = st.series""")
def _(t):
    stats = league.build_stats(stats_payload(t))
    return league.enrich_debut(stats, *_debut_inputs(t)).select("id", "series", "full_name", "rookie_year")


@query("c04_gender_enrichment", f"""
    WITH {_STATS} SELECT id, series, coalesce(gender, CASE WHEN full_name IN (SELECT c_name FROM customer WHERE c_custkey % 6 < 2) THEN 'F' ELSE 'M' END) AS gender FROM st""")
def _(t):
    stats = league.build_stats(stats_payload(t))
    women = t.customer.where("c_custkey % 6 < 2").select(F.col("c_name").alias("full_name"))
    return league.enrich_gender(stats, women).select("id", "series", "gender")


# The eight tables.

def _sources(t):
    return kept(league.build_stats(stats_payload(t))), kept(league.build_standings(standings_payload(t)))


def _table(t, name):
    """One table; the lazy inputs are read once, so nothing is written in between."""
    stats, standings = league.build_stats(stats_payload(t)), league.build_standings(standings_payload(t))
    return league.normalise(stats, standings, [name], bound=t.orders)[name]


_PEOPLE = f"""{_STATS},
    pf AS (SELECT * FROM st QUALIFY row_number() OVER (PARTITION BY id ORDER BY CASE series WHEN 'cw' THEN 1 WHEN 'xf' THEN 2 ELSE 3 END) = 1),
    pi AS (SELECT row_number() OVER (ORDER BY id) AS pid, * FROM pf)"""
_RACES = "ri AS (SELECT row_number() OVER (ORDER BY season, series) AS rid, series, season FROM (SELECT DISTINCT series, season FROM r))"
_ALL = f"{_PEOPLE}, {_STANDINGS.removeprefix(_RECORDS + ',')}, {_RACES}"


@query("c05_personal_info", f"""
    WITH {_PEOPLE} SELECT pid AS id, id AS driver_id, first_name, last_name, full_name, gender, TRY_CAST(height AS DOUBLE) AS height,
      TRY_CAST(weight AS DOUBLE) AS weight, CAST(birthday AS TIMESTAMP) AS birthday, nullif(birth_place, 'nan') AS birth_place, country FROM pi""")
def _(t):
    people = _table(t, "personal_info")
    return people.withColumn("birthday", F.col("birthday").cast("timestamp_ntz"))


@query("c05_race_info", f"WITH {_RECORDS}, {_RACES} SELECT rid AS id, series, CAST(season AS INTEGER) AS season FROM ri")
def _(t):
    return _table(t, "race_info")


@query("c05_social_media", f"""
    WITH {_PEOPLE}, h AS (SELECT DISTINCT id, replace(twitter, '@', '') AS twitter FROM st),
    u AS (SELECT * FROM h QUALIFY count(*) OVER (PARTITION BY id) = 1 OR twitter IS NOT NULL)
    SELECT row_number() OVER (ORDER BY u.id, u.twitter NULLS FIRST) AS social_media_id, pid AS driver_id, u.twitter FROM u JOIN pi ON pi.id = u.id""")
def _(t):
    return _table(t, "social_media")


@query("c05_debut_info", f"""
    WITH {_PEOPLE} SELECT row_number() OVER (ORDER BY st.id, st.series) AS debut_info_id, pid AS driver_id, st.series, st.rookie_year
    FROM st JOIN pi ON pi.id = st.id""")
def _(t):
    return _table(t, "debut_info")


@query("c05_status_info", f"""
    WITH {_ALL}, s AS (SELECT DISTINCT id, status FROM sd)
    SELECT row_number() OVER (ORDER BY s.id, status) AS status_info_id, pid AS driver_id, status FROM s JOIN pi ON pi.id = s.id""")
def _(t):
    return _table(t, "status_info")


def _fact_sql(key, measures):
    names = ", ".join(f"sd.{m}" for m in measures)
    return f"""
    WITH {_ALL} SELECT row_number() OVER (ORDER BY sd.id, sd.series, sd.season) AS {key}, rid AS race_id, pid AS driver_id, {names}
    FROM sd JOIN pi ON pi.id = sd.id JOIN ri ON ri.series = sd.series AND ri.season = sd.season"""


_ACHIEVEMENT = ["rank", "starts", "points", "wins", "stage_wins", "poles", "top_5", "top_10", "top_15", "top_20"]
_PERFORMANCE = ["chase_bonus", "chase_wins", "chase_stage_wins", "laps_led", "laps_completed", "avg_start_position",
                "avg_finish_position", "avg_laps_completed", "laps_led_pct", "dnf", "in_chase", "behind"]


@query("c05_seasonal_achievement", _fact_sql("seasonal_achievement_id", _ACHIEVEMENT))
def _(t):
    return _table(t, "seasonal_achievement")


@query("c05_detailed_performance", _fact_sql("detailed_performance_id", _PERFORMANCE))
def _(t):
    return _table(t, "detailed_performance")


@query("c05_earnings", _fact_sql("earnings_id", ["money"]))
def _(t):
    return _table(t, "earnings")


_COUNTS = f"""
    WITH {_ALL}, h AS (SELECT DISTINCT id, twitter FROM st),
    u AS (SELECT * FROM h QUALIFY count(*) OVER (PARTITION BY id) = 1 OR twitter IS NOT NULL)
    SELECT 'personal_info' AS table_name, count(*) AS n_rows FROM pi UNION ALL SELECT 'race_info', count(*) FROM ri
    UNION ALL SELECT 'social_media', count(*) FROM u UNION ALL SELECT 'seasonal_achievement', count(*) FROM sd
    UNION ALL SELECT 'detailed_performance', count(*) FROM sd UNION ALL SELECT 'earnings', count(*) FROM sd
    UNION ALL SELECT 'debut_info', count(*) FROM st UNION ALL SELECT 'status_info', count(*) FROM (SELECT DISTINCT id, status FROM sd)"""


@query("c06_store_and_load", _COUNTS)
def _(t):
    """Write the tables, create them again from the files and count through SQL."""
    folder = workspace(t.spark, "store")
    league.load(t.spark, league.store(*_sources(t), folder))
    counts = [t.spark.sql(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}") for n in contracts.LOAD_ORDER]
    return union_by_name(counts)


def _page_sources(t):
    """List pages, driver pages and hand-made values; a list page holds the customers of 1,600 keys."""
    c, name = F.col("c_custkey"), F.col("c_name")

    def pages(rows, line):
        listed = rows.groupBy(F.floor(c / 1600).alias("page")).agg(F.array_sort(F.collect_list(F.struct(c.alias("k"), line.alias("line")))).alias("r"))
        return listed.select(F.array_join(F.transform("r", lambda x: x["line"]), "\n").alias("html"))

    debut = F.concat(F.lit('<td><a href="/a" title="x">'), name, F.lit("</a>\n</td>\n<td>"), (2000 + c % 20).cast("string"), F.lit("\n</td>"))
    female = F.concat(F.lit('<th><a href="/a" title="x">'), name, F.lit("</a>\n</th>"))
    year = F.concat(F.lit("19"), F.lpad((c % 20).cast("string"), 2, "0"))
    race = F.concat(F.lit('First race <a href="/r" title="'), year, F.lit(' League Xfinity Series">'), year, F.lit("</a>\n"))
    late = t.orders.where("o_totalprice > 450000").join(t.customer, F.col("o_custkey") == c)
    return {
        "debut_pages": pages(t.customer.where(c % 4 != 2), debut), "female_pages": pages(t.customer.where(c % 6 < 2), female),
        "driver_pages": t.pages.join(t.customer.where(c % 3 != 0), F.col("page_id") == c).select(name.alias("page_key"), F.concat("html", F.lit("\n"), race).alias("html")),
        "aliases": t.customer.where(c % 7 == 0).select(name.alias("full_name"), F.concat(F.lit("Customer#"), F.lpad((c + 1).cast("string"), 9, "0")).alias("page_key")),
        "year_overrides": late.select(F.col("o_orderkey").alias("seq"), name.alias("full_name"), F.when(F.col("o_orderkey") % 2 == 1, F.lit("xf")).alias("series"),
                                      (1900 + F.col("o_orderkey") % 100).cast("int").alias("value")),
        "race_corrections": t.customer.where(c % 11 == 3).select(c.alias("seq"), name.alias("full_name"), F.lit("2015, Xfinity Series").alias("value")),
        "league": "League",
    }


@query("c06_store_from_pages", f"""
    WITH {_STATS},
    l AS (SELECT c_name AS full_name, CAST(2000 + c_custkey % 20 AS INTEGER) AS y,
            row_number() OVER (PARTITION BY c_custkey // 1600 ORDER BY c_custkey) - 1 AS pos FROM customer WHERE c_custkey % 4 <> 2),
    d AS (SELECT full_name, y, CASE WHEN pos <= 57 THEN 'sc' WHEN pos <= 167 THEN 'xf' WHEN pos <= 288 THEN 'cw' END AS series FROM l),
    k AS (SELECT c_name AS page_key, CAST('19' || lpad(CAST(c_custkey % 20 AS VARCHAR), 2, '0') AS INTEGER) AS y FROM customer JOIN pages ON page_id = c_custkey WHERE c_custkey % 3 <> 0),
    n AS (SELECT c_name AS full_name, 1 AS tier, c_name AS page_key FROM customer
      UNION ALL SELECT c_name, 3, 'Customer#' || lpad(CAST(c_custkey + 1 AS VARCHAR), 9, '0') FROM customer WHERE c_custkey % 7 = 0),
    p AS (SELECT n.full_name, y FROM n JOIN k USING (page_key) QUALIFY row_number() OVER (PARTITION BY n.full_name ORDER BY tier, page_key) = 1),
    q AS (SELECT c_name AS full_name, CASE WHEN c_custkey % 11 = 3 THEN 2015 ELSE p.y END AS y FROM customer LEFT JOIN p ON p.full_name = c_name),
    v AS (SELECT o_orderkey AS seq, c_name AS full_name, CASE WHEN o_orderkey % 2 = 1 THEN 'xf' END AS series,
                 CAST(1900 + o_orderkey % 100 AS INTEGER) AS y FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 450000),
    w AS (SELECT st.id, st.series, arg_max(v.y, v.seq) AS y FROM st JOIN v ON v.full_name = st.full_name AND (v.series IS NULL OR v.series = st.series) GROUP BY 1, 2),
    e AS (SELECT st.series, coalesce(st.gender, CASE WHEN st.full_name IN (SELECT c_name FROM customer WHERE c_custkey % 6 < 2) THEN 'F' ELSE 'M' END) AS gender,
        coalesce(w.y, st.rookie_year, d.y, o.y, CASE WHEN st.series = 'xf' THEN q.y END) AS rookie_year
      FROM st LEFT JOIN d ON d.full_name = st.full_name AND d.series = st.series LEFT JOIN d o ON o.full_name = st.full_name AND o.series IS NULL
      LEFT JOIN q ON q.full_name = st.full_name LEFT JOIN w ON w.id = st.id AND w.series = st.series)
    SELECT series, gender, count(*) AS n, count(rookie_year) AS n_years, CAST(sum(rookie_year) AS BIGINT) AS total FROM e GROUP BY 1, 2""")
def _(t):
    """Payloads and pages to the written store; its debut facts by series and gender."""
    folder = workspace(t.spark, "store")
    paths = league.collect_and_store(stats_payload(t), standings_payload(t), folder, **_page_sources(t))
    league.load(t.spark, paths)
    return t.spark.sql("""
        SELECT d.series, p.gender, count(*) AS n, count(d.rookie_year) AS n_years, sum(d.rookie_year) AS total
        FROM debut_info d JOIN personal_info p ON p.id = d.driver_id GROUP BY 1, 2""")


# Contract checks.

@query("s12_create_tables", f"""
    SELECT c.table_name, n_columns, n_rows FROM ({_COUNTS}) c JOIN (VALUES ('personal_info', 11), ('race_info', 3), ('social_media', 3),
      ('seasonal_achievement', 13), ('detailed_performance', 15), ('earnings', 4), ('debut_info', 4), ('status_info', 3)) v(table_name, n_columns)
      USING (table_name)""")
def _(t):
    """The eight tables created as views under their contract, described and counted through SQL."""
    stats, standings = _sources(t)
    names = contracts.create_tables(t.spark, league.normalise(stats, standings, bound=t.orders))
    counts = [t.spark.sql(f"SELECT '{n}' AS table_name, {len(t.spark.table(n).columns)} AS n_columns, count(*) AS n_rows FROM {n}") for n in names]
    return union_by_name(counts)


@query("d01_schema_contract", f"""
    SELECT c.*, column_name, wanted, found FROM ({_COUNTS}) c
    LEFT JOIN (VALUES ('race_info', 'season', 'int', 'string')) v(table_name, column_name, wanted, found) USING (table_name)""")
def _(t):
    """Rows of each table and its differences to the contract: only the planted one."""
    tables = league.normalise(*_sources(t), bound=t.orders)
    tables["race_info"] = tables["race_info"].withColumn("season", F.col("season").cast("string"))
    found = [v for n, df in tables.items() for v in contracts.schema_violations(df, n)]
    checked = union_by_name([df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows") for n, df in tables.items()])
    differences = t.spark.createDataFrame(found, "table_name string, column_name string, wanted string, found string")
    return checked.join(differences, "table_name", "left")


@query("d02_foreign_keys", """
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size < 40)""")
def _(t):
    """Lines that point to no part of size below 40."""
    parents = t.part.where("p_size < 40")
    return contracts.orphans(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), "l_partkey", parents, "p_partkey")


@query("d02_store_keys", """
    SELECT * FROM (VALUES ('primary_key', 'personal_info', 'id'), ('primary_key', 'race_info', 'id'),
      ('primary_key', 'social_media', 'social_media_id'), ('primary_key', 'seasonal_achievement', 'seasonal_achievement_id'),
      ('primary_key', 'detailed_performance', 'detailed_performance_id'), ('primary_key', 'earnings', 'earnings_id'),
      ('primary_key', 'debut_info', 'debut_info_id'), ('primary_key', 'status_info', 'status_info_id'),
      ('foreign_key', 'social_media', 'driver_id'), ('foreign_key', 'seasonal_achievement', 'race_id'),
      ('foreign_key', 'seasonal_achievement', 'driver_id'), ('foreign_key', 'detailed_performance', 'race_id'),
      ('foreign_key', 'detailed_performance', 'driver_id'), ('foreign_key', 'earnings', 'driver_id'), ('foreign_key', 'earnings', 'race_id'),
      ('foreign_key', 'debut_info', 'driver_id'), ('foreign_key', 'status_info', 'driver_id')) v(kind, table_name, column_name),
      (SELECT CAST(0 AS BIGINT) AS n_bad)""")
def _(t):
    """All keys of the built store hold."""
    folder = workspace(t.spark, "store")
    paths = league.store(*_sources(t), folder)
    return contracts.violations({n: t.spark.read.schema(contracts.schema_of(n)).parquet(p) for n, p in paths.items()})


@query("d03_primary_key", """
    SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def _(t):
    return contracts.repeated_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("d04_row_count", "SELECT count(*) AS n_rows, 25::BIGINT AS expected, count(*) = 25 AS ok FROM customer")
def _(t):
    return contracts.row_count_check(t.customer, 25)


_EXPECTED = ", ".join(f"('{n}', {rows})" for n, rows in contracts.EXPECTED_ROWS.items())


@query("d04_contract_counts", f"""
    SELECT table_name, n_rows, expected, n_rows = expected AS ok FROM ({_COUNTS}) JOIN (VALUES {_EXPECTED}) e(table_name, expected) USING (table_name)""")
def _(t):
    """Rows of every stored table, counted while it was written, next to the number the contract states for the original season data."""
    counts: dict[str, int] = {}
    league.store(*_sources(t), workspace(t.spark, "store"), counts)
    found = [(n, rows, contracts.EXPECTED_ROWS[n], rows == contracts.EXPECTED_ROWS[n]) for n, rows in counts.items()]
    return t.spark.createDataFrame(found, "table_name string, n_rows long, expected int, ok boolean")
