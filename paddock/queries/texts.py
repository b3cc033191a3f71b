"""Pattern extraction from the pages and texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from paddock.functions import text as X
from paddock.operators import scan
from paddock.queries.registry import query

# Alternation of a headline and a link; each match fills one of the two groups.
HEAD_OR_LINK = r'<h1>([^<]*)</h1>|<li><a href="[^"]*">([^<]*)</a></li>'
# Odd page names and the key they stand for.
ALIASES = (("blog.tionsh", "tionsh"), ("blog.ththan", "ththan"), ("m.ththth", "ththth"))
ROW_PATTERN = r'<td>([^<]*)</td>'


@query("r01_find_all_groups", f"""
    WITH m AS (SELECT page_id, regexp_extract_all(html, '{HEAD_OR_LINK}', 1) AS a,
                      regexp_extract_all(html, '{HEAD_OR_LINK}', 2) AS b FROM pages)
    SELECT page_id, i - 1 AS pos, coalesce(a[i], '') AS head, coalesce(b[i], '') AS link
    FROM m, LATERAL (SELECT unnest(range(1, len(a) + 1)) AS i)""")
def _(t):
    found = X.find_all(F.col("html"), HEAD_OR_LINK, (1, 2))
    return t.pages.select("page_id", F.posexplode(found).alias("pos", "m")).select(
        "page_id", F.col("pos").cast("long").alias("pos"), F.col("m.g1").alias("head"), F.col("m.g2").alias("link"))


@query("r02_merge_groups", f"""
    WITH m AS (SELECT page_id, regexp_extract_all(html, '{HEAD_OR_LINK}', 1) AS a,
                      regexp_extract_all(html, '{HEAD_OR_LINK}', 2) AS b FROM pages)
    SELECT page_id, i - 1 AS pos, concat(a[i], b[i]) AS name FROM m, LATERAL (SELECT unnest(range(1, len(a) + 1)) AS i)""")
def _(t):
    merged = X.merged_matches(F.col("html"), HEAD_OR_LINK, (1, 2))
    return t.pages.select("page_id", F.posexplode(merged).alias("pos", "name")).select(
        "page_id", F.col("pos").cast("long").alias("pos"), "name")


@query("r03_find_all_one_group", r"""
    SELECT page_id, unnest(regexp_extract_all(html, 'track\((\d+)\)', 1)) AS track FROM pages""")
def _(t):
    return t.pages.select("page_id", F.explode(F.regexp_extract_all("html", F.lit(r"track\((\d+)\)"), 1)).alias("track"))


_FACT_SQL = """
    WITH f AS (SELECT page_id, html || '<li>First race ' ||
      CASE WHEN page_id % 3 = 0 THEN '' ELSE '<a href="/r" title="20' || lpad(CAST(page_id % 20 AS VARCHAR), 2, '0')
        || ' League Cup Series">20' || lpad(CAST(page_id % 20 AS VARCHAR), 2, '0') || '</a>' END || '</li>' AS html FROM pages)
"""


def _fact_pages(t):
    """The pages with a "first race" line in two of three."""
    year = F.concat(F.lit("20"), F.lpad((F.col("page_id") % 20).cast("string"), 2, "0"))
    line = F.concat(F.lit('<a href="/r" title="'), year, F.lit(' League Cup Series">'), year, F.lit("</a>"))
    shown = F.when(F.col("page_id") % 3 == 0, F.lit("")).otherwise(line)
    return t.pages.select("page_id", F.concat("html", F.lit("<li>First race "), shown, F.lit("</li>")).alias("html"))


@query("r04_first_races", _FACT_SQL + r"""
    , m AS (SELECT page_id, regexp_extract_all(html, 'First\srace.*?title="(\d{4}?).*League\s(.*?)">\d{4}</a>', 1) AS y,
            regexp_extract_all(html, 'First\srace.*?title="(\d{4}?).*League\s(.*?)">\d{4}</a>', 2) AS s FROM f)
    SELECT page_id, y[i] AS year, s[i] AS series FROM m, LATERAL (SELECT unnest(range(1, len(y) + 1)) AS i)""")
def _(t):
    races = F.explode(X.first_races(F.col("html"), "League")).alias("r")
    return _fact_pages(t).select("page_id", races).select("page_id", "r.year", "r.series")


@query("r05_list_cell_rows", """
    WITH l AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 3 END AS n,
                      o_orderstatus AS s, CAST(CAST(year(o_orderdate) AS INTEGER) AS VARCHAR) AS y FROM orders)
    SELECT o_orderkey, CASE WHEN n IS NULL THEN NULL ELSE y || ', ' || s END AS race FROM l
    UNION ALL SELECT o_orderkey, y || ', X' FROM l WHERE n = 2""")
def _(t):
    """A list of pairs that was written as text becomes rows again."""
    year = F.year("o_orderdate").cast("string")
    pair = F.concat(F.lit("('"), year, F.lit("', '"), F.col("o_orderstatus"), F.lit("')"))
    second = F.concat(F.lit(", ('"), year, F.lit("', 'X')"))
    kind = F.col("o_orderkey") % 3
    cell = F.concat(F.lit("["), F.when(kind == 0, "").when(kind == 1, pair).otherwise(F.concat(pair, second)), F.lit("]"))
    cells = t.orders.select("o_orderkey", cell.alias("cell"))
    return X.list_cell_rows(cells, "cell", "race").select("o_orderkey", "race")


@query("r06_split_two", """
    SELECT conv_id, turn, trim(string_split(text, ',')[1]) AS head,
           CASE WHEN contains(text, ',') THEN trim(substr(text, strpos(text, ',') + 1)) END AS rest FROM conversations""")
def _(t):
    head, rest = X.split_two(F.col("text"))
    return t.conversations.select("conv_id", "turn", head.alias("head"), rest.alias("rest"))


@query("r07_page_key", """
    SELECT p_partkey, replace(p_name, ' ', '_') || '_(racing_driver)' AS page_key FROM part""")
def _(t):
    return t.part.select("p_partkey", X.page_key(F.col("p_name"), X.PAGE_SUFFIX).alias("page_key"))


_HOST = "regexp_extract(url, '^https?://([^/]+)', 1)"


@query("r08_alias_map", f"""
    WITH h AS (SELECT page_id, regexp_replace({_HOST}, '[.]example[.].*$', '') AS host FROM pages)
    SELECT page_id, host, CASE host WHEN 'blog.tionsh' THEN 'tionsh' WHEN 'blog.ththan' THEN 'ththan'
           WHEN 'm.ththth' THEN 'ththth' ELSE host END AS page_key FROM h""")
def _(t):
    aliases = t.spark.createDataFrame(list(ALIASES), "host string, alias string")
    host = F.regexp_replace(F.regexp_extract("url", "^https?://([^/]+)", 1), "[.]example[.].*$", "")
    return t.pages.select("page_id", host.alias("host")).join(aliases, "host", "left").select(
        "page_id", "host", F.coalesce("alias", "host").alias("page_key"))


@query("r09_resolve_pages", f"""
    WITH p AS (SELECT DISTINCT regexp_replace({_HOST}, '[.]example[.].*$', '')
                      || CASE WHEN page_id % 2 = 0 THEN '_(racing_driver)' ELSE '' END AS page_key FROM pages),
    n AS (SELECT DISTINCT regexp_replace({_HOST}, '^(blog|m)[.]|[.]example[.].*$', '', 'g') AS full_name FROM pages),
    a AS (SELECT full_name, 'blog.' || full_name AS page_key FROM n),
    c AS (SELECT full_name, 1 AS tier, full_name AS page_key FROM n
          UNION ALL SELECT full_name, 2, full_name || '_(racing_driver)' FROM n
          UNION ALL SELECT full_name, 3, page_key FROM a)
    SELECT full_name, tier, page_key FROM c JOIN p USING (page_key)
    QUALIFY row_number() OVER (PARTITION BY full_name ORDER BY tier, page_key) = 1""")
def _(t):
    host = F.regexp_extract("url", "^https?://([^/]+)", 1)
    suffix = F.when(F.col("page_id") % 2 == 0, F.lit(X.PAGE_SUFFIX)).otherwise(F.lit(""))
    pages = t.pages.select(F.concat(F.regexp_replace(host, "[.]example[.].*$", ""), suffix).alias("page_key")).distinct()
    names = t.pages.select(F.regexp_replace(host, "^(blog|m)[.]|[.]example[.].*$", "").alias("full_name")).distinct()
    aliases = names.select("full_name", F.concat(F.lit("blog."), F.col("full_name")).alias("page_key"))
    return X.resolve_pages(names, pages, aliases)


@query("r10_year_of", "SELECT event_id, CAST(year(ts) AS INTEGER) AS year FROM events")
def _(t):
    return t.events.select("event_id", F.year("ts").alias("year"))


@query("e01_word_count", """
    SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY 1""")
def _(t):
    return t.documents.select(F.explode(F.split("text", " ")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("e02_sort_numbers", "SELECT l_quantity FROM lineitem ORDER BY 1")
def _(t):
    return scan.in_order(t.lineitem.select("l_quantity"), ["l_quantity"])


@query("e14_access_log", r"""
    WITH p AS (SELECT regexp_extract(url, '^(https?)://([^/]+)/([^?#]*)\?(.*)$', 2) AS host,
        regexp_extract(url, '^(https?)://([^/]+)/([^?#]*)\?(.*)$', 3) AS path,
        regexp_extract(url, '^(https?)://([^/]+)/([^?#]*)\?(.*)$', 4) AS search,
        regexp_matches(url, '^(https?)://([^/]+)/([^?#]*)\?(.*)$') AS ok, octet_length(encode(html)) AS bytes FROM pages)
    SELECT CASE WHEN ok THEN host END AS host, CASE WHEN ok THEN path END AS path, CASE WHEN ok THEN search END AS search,
      count(*) AS n, CAST(sum(CASE WHEN ok THEN bytes ELSE 0 END) AS BIGINT) AS bytes FROM p GROUP BY 1, 2, 3""")
def _(t):
    """Requests and bytes per (host, path, search); lines that do not parse share the empty key."""
    pattern = r"^(https?)://([^/]+)/([^?#]*)\?(.*)$"
    ok = F.col("url").rlike(pattern)
    part = {n: F.when(ok, F.regexp_extract("url", pattern, i)).alias(n) for i, n in ((2, "host"), (3, "path"), (4, "search"))}
    size = F.when(ok, F.octet_length("html")).otherwise(0)
    parsed = t.pages.select(*part.values(), size.alias("bytes"))
    return parsed.groupBy("host", "path", "search").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
