"""The registered queries of the operators, with SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.llm import (
    bitplanes, chat, decontaminate, extract, fixity, interaction, packing, quality, repeats, secret_scan, simhash, urls, vector_codes,
)
from paddock.llm.exprs import sha256_hex
from paddock.llm.tokens import encoder
from paddock.operators.hot import null_safe_join
from paddock.operators.scan import running, running_sum
from paddock.session import checkpoint, prepare, workspace

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            prepare(spark)
            return fn(lambda table: spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet"))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql.strip()
        return fn

    return register


# Records per archive file, and which pages the second copy has damaged or lost.
PAGES_PER_FILE = 512
DAMAGED_EVERY, LOST_EVERY = 97, 331

_RECORD_SQL = """
WITH r AS (
  SELECT page_id, CAST(floor(page_id / 512) AS BIGINT) AS file,
    strlen('WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')
      || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
      || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10)) AS length
  FROM pages),
o AS (SELECT page_id, file, length, CAST(sum(length) OVER (PARTITION BY file ORDER BY page_id) - length AS BIGINT) AS "offset" FROM r)
"""


@_query("op2_fixity_audit", _RECORD_SQL + """
SELECT page_id, file, "offset", CAST(length AS BIGINT) AS length,
  CASE WHEN page_id % 331 = 7 THEN 'missing' ELSE 'changed' END AS kind,
  CAST(floor("offset" / 262144) AS BIGINT) * 262144 AS range_start
FROM o WHERE page_id % 97 = 13 OR page_id % 331 = 7
""")
def op2_fixity_audit(table):
    """Pages laid out as archive records; the damaged and lost records of a second copy, found through the trees.

    The second copy is the first with one byte changed in every 97th record and
    every 331st record gone.
    """
    pages = table("pages").select("page_id", "url", "html")
    record = fixity.record_bytes(F.col("url"), F.col("html"))
    sized = pages.select("page_id", F.floor(F.col("page_id") / PAGES_PER_FILE).alias("file"),
                         F.length(record).cast("long").alias("length"), F.sha2(record, 256).alias("digest"),
                         F.sha2(F.concat(record, F.encode(F.lit("!"), "UTF-8")), 256).alias("hurt"))
    laid = checkpoint(running(sized, ["file"], ["page_id", "digest"], {"offset": running_sum("length", before=True)}, bound=pages))
    left = laid.select("page_id", "file", "offset", "length", "digest")
    hurt = F.when(F.pmod("page_id", F.lit(DAMAGED_EVERY)) == 13, F.col("hurt")).otherwise(F.col("digest"))
    right = laid.where(F.coalesce(F.pmod("page_id", F.lit(LOST_EVERY)) != 7, F.lit(True))).select(
        "file", "offset", "length", hurt.alias("digest"))
    found = fixity.audit(left, right)
    return null_safe_join(found, left.select("page_id", "file", "offset"), ["file", "offset"], "inner").select(
        "page_id", "file", "offset", "length", "kind", "range_start")


_WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_OP6_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t, {_WORDS_SQL} AS w FROM documents),
p AS (SELECT k, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM d),
g AS (SELECT k, i, a, lead(a) OVER o AS b, lead(a, 2) OVER o AS c FROM p WINDOW o AS (PARTITION BY k ORDER BY i)),
f AS (SELECT k, i, count(*) OVER (PARTITION BY k, a, b, c) > 1 AS twice FROM g WHERE c IS NOT NULL),
cov AS (SELECT k, count(DISTINCT j) AS n FROM (SELECT k, unnest([i, i + 1, i + 2]) AS j FROM f WHERE twice) GROUP BY k),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) AS BIGINT) AS n_lines,
    CAST(len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
      - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN cov USING (k)),
v AS (SELECT *, n_words < 50 AS r0, 100 * n_repeat_words > 50 * n_words AS r1, 10 * n_symbols > n_words AS r2,
    100 * n_dup_lines > 40 * n_lines AS r3, n_words > 0 AND (word_chars < 3 * n_words OR word_chars > 10 * n_words) AS r4 FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, r0 OR r1 AS base_failed,
  NOT (r0 OR r1 OR r2 OR r3 OR r4) AS kept,
  CAST(r0 AS BIGINT) + 2 * CAST(r1 AS BIGINT) + 4 * CAST(r2 AS BIGINT) + 8 * CAST(r3 AS BIGINT) + 16 * CAST(r4 AS BIGINT) AS failed
FROM v
"""


@_query("op6_quality_ledger", _OP6_SQL)
def op6_quality_ledger(table):
    """Measures, failure bits and the verdicts of two policies for every document."""
    entries = quality.ledger(table("documents").select("doc_id", "text"))
    judged = quality.decide(quality.decide(entries, quality.POLICIES["base"], "_base"), quality.POLICIES["v1"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         (~F.col("_base")).alias("base_failed"), "kept", "failed")


@_query("op8_secret_scan")
def op8_secret_scan(table):
    """Base and entropy spans of every document, counted, digested and written out."""
    found = secret_scan.scan(table("documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["rank"] < len(secret_scan.BASE_KINDS))

    def n(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[n(k) for k in secret_scan.BASE_KINDS],
                        sha256_hex(secret_scan.written(base)).alias("base_sha256"),
                        secret_scan.written(F.col("spans")).alias("spans"))


# The rules of the url query.
URL_RULES = [
    urls.UrlRule("allow", "com", "/"),
    urls.UrlRule("block", "example.com", "/en/"),
    urls.UrlRule("allow", "www.example.com", "/en/"),
    urls.UrlRule("block", "net", "/es/"),
    urls.UrlRule("block", "net", "/fr/"),
]

_OP10_SQL = r"""
WITH RECURSIVE u AS (
  SELECT page_id, url, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
rules(verdict, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fit AS (SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
  FROM u JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN fit USING (page_id)
"""


@_query("op10_url_filter", _OP10_SQL.replace("WITH RECURSIVE", "WITH"))
def op10_url_filter(table):
    """Host, path, deciding rule and verdict of every page; no page of these tables has an alias link."""
    return urls.judge(table("pages").select("page_id", "url", "html"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict")


@_query("op3_simhash")
def op3_simhash(table):
    """Fingerprint and component of every document."""
    found = simhash.components(table("documents").select("doc_id", "text"))
    return found.select("doc_id", simhash.print_hex().alias("fingerprint"), "component_id")


_OP7_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT k, s, n, array_to_string(w[s:s + n - 1], ' ') AS phrase
  FROM (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d CROSS JOIN sizes WHERE len(w) >= n)),
m AS (SELECT DISTINCT k, s, n, item_id FROM dw JOIN iw USING (n, phrase)),
hits AS (SELECT k, count(DISTINCT j) AS n_hit FROM (SELECT k, unnest(range(s, s + n)) AS j FROM m) GROUP BY k),
named AS (SELECT k, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM m GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (k) LEFT JOIN named USING (k)
"""


@_query("op7_decontaminate", _OP7_SQL)
def op7_decontaminate(table):
    """Words of every document inside windows of benchmark items, and the items they come from."""
    return decontaminate.contamination(table("documents").select("doc_id", "text"), table("benchmark"))


@_query("op4_best_fit_packing")
def op4_best_fit_packing(table):
    """Every piece of every document with its sequence and place."""
    return packing.pack_documents(table("documents").select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


@_query("op5_bit_planes")
def op5_bit_planes(table):
    """Every document as read back from the files of planes."""
    docs = table("documents").select("doc_id", "text")
    spark = docs.sparkSession
    path = workspace(spark, "token-ids")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    # Pieces hold most words here; two workers of an executor have to fit beside its heap.
    bitplanes.write_shards(docs, path, lambda text: encoder(tokenizer, 230_000, 50_000).ids(text))
    return bitplanes.read_documents(spark, path)


_OP1_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, length(role) + length(text) + 13 + length(role) - length(replace(role, chr(10), ''))
    + length(role || ' ' || text) - length(replace(role || ' ' || text, '\', ''))
    + coalesce(list_sum(list_transform(regexp_extract_all(role || ' ' || text, '#{3,}'), lambda x: length(x) - 2)), 0)
    + len(regexp_extract_all(role || ' ' || text, '</turn>')) AS size FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(size) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@_query("op1_chat_format", _OP1_SQL)
def op1_chat_format(table):
    """Every conversation formatted, and what is read back from the formatted form."""
    turns = table("conversations").select("conv_id", "turn", "role", "text")
    odd = "\\### Assistant: </turn> ok"
    more = turns.sparkSession.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], turns.schema)
    return chat.digests(chat.format_conversations(turns.unionByName(more)))


@_query("op9_main_text")
def op9_main_text(table):
    """The main text of every page and its length."""
    found = extract.extract(table("pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def _op11_sql() -> str:
    """Every round spelled out: assign by squared distance, then means rounded down. Products of lists are exact up to 2 ** 53."""
    def assigned(n):
        return f"""a{n} AS MATERIALIZED (SELECT p.r, p.part, min(CAST(p.q + c.q - 2 * list_inner_product(p.v, c.v) AS BIGINT) * 256 + c.e) AS best
  FROM p JOIN c{n} c USING (part) GROUP BY p.r, p.part)"""

    def moved(n):
        return f"""m{n} AS (SELECT part, e, list(m ORDER BY i) AS v FROM (
    SELECT part, best % 256 AS e, i, floor(sum(x) / count(*)) AS m
    FROM (SELECT part, best, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM p JOIN a{n} USING (r, part)) GROUP BY ALL) GROUP BY ALL),
c{n + 1} AS MATERIALIZED (SELECT part, e, v, list_inner_product(v, v) AS q
  FROM (SELECT part, e, coalesce(m.v, c.v) AS v FROM c{n} c LEFT JOIN m{n} m USING (part, e)))"""

    rounds = ",\n".join(f"{assigned(n)},\n{moved(n)}" for n in range(vector_codes.ROUNDS))
    last = vector_codes.ROUNDS
    return f"""
WITH k AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS r, vec_id, label,
    list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT r, part, v, list_inner_product(v, v) AS q FROM (
    SELECT r, part, x[part * (len(x) // 4) + 1:(part + 1) * (len(x) // 4)] AS v FROM k, (SELECT unnest(range(4)) AS part))),
c0 AS MATERIALIZED (SELECT part, r AS e, v, q FROM p WHERE r < 256),
{rounds},
{assigned(last)},
coded AS (SELECT r, string_agg(printf('%02x', best % 256), '' ORDER BY part) AS code, CAST(sum(best // 256) AS BIGINT) AS error
  FROM a{last} GROUP BY r),
books AS (SELECT sha256(string_agg(array_to_string(list_transform(v, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ','), ',' ORDER BY part, e)) AS d
  FROM c{last})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, d AS codebooks_sha256
FROM k JOIN coded USING (r), books
"""


@_query("op11_vector_codes", _op11_sql())
def op11_vector_codes(table):
    """Code and error of every vector, with the error of its label and the digest of the codebooks."""
    coded, books = vector_codes.compress(table("embeddings"))
    digest = F.lit(books.digest() if books else None).cast("string")
    return vector_codes.with_label_errors(coded).select(
        "vec_id", vector_codes.code_hex().alias("code"), "error", "label_error", digest.alias("codebooks_sha256"))


_OP12_SQL = """
WITH d AS (SELECT row_number() OVER () AS k, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS MATERIALIZED (SELECT k, doc_id, i, substr(h, 2 * i + 1, 100) AS s
  FROM (SELECT k, doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM d WHERE length(h) >= 100)),
least AS (SELECT s, min(doc_id) AS f FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT k, i FROM w JOIN least USING (s) WHERE doc_id > f),
opened AS (SELECT k, i, CASE WHEN i > lag(i) OVER (PARTITION BY k ORDER BY i) + 50 THEN 1 ELSE 0 END AS o FROM hit),
grouped AS (SELECT k, i, sum(o) OVER (PARTITION BY k ORDER BY i) AS g FROM opened),
span AS (SELECT k, min(i) AS a, max(i) + 50 AS b FROM grouped GROUP BY k, g),
gaps AS (SELECT k, a, b, substr(h, 2 * coalesce(lag(b) OVER o, 0) + 1, 2 * (a - coalesce(lag(b) OVER o, 0))) AS before
  FROM span JOIN d USING (k) WINDOW o AS (PARTITION BY k ORDER BY a)),
cut AS (SELECT k, count(*) AS n, sum(b - a) AS gone, string_agg(before, '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS kept
  FROM gaps JOIN d USING (k) GROUP BY k)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(n, 0) AS n_spans,
  sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN cut USING (k)
"""


@_query("op12_suffix_dedup", _OP12_SQL)
def op12_suffix_dedup(table):
    """Bytes of every document, those that go because a smaller id has them, and the digest of the rest."""
    found = repeats.remove_repeats(table("documents").select("doc_id", "text"))
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["stop"] - x["start"])
    return found.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


_OP13_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) < doc_id AS again FROM d),
f AS (SELECT part,
    CAST(len(w) < 200 AS INT) + 2 * CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INT)
    + 4 * CAST(100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) AS INT)
    + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT) + 16 * CAST(coalesce(again, false) AS INT) AS bits,
    doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good, doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic FROM w),
c AS (SELECT part, bits, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS x, 1 << (ascii(substr(filter_order, step, 1)) - 65) AS bit,
    CAST(coalesce(list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(substr(filter_order, CAST(i AS INT), 1)) - 65))), 0) AS INT) AS before
  FROM o, (SELECT CAST(unnest(range(1, 6)) AS INT) AS step)),
r AS (SELECT part, filter_order, step, x,
    sum(CASE WHEN bits & (bit | before) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN bits & bit <> 0 AND bits & before = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN bits & bit <> 0 AND bits & before <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN bits = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN bits & bit <> 0 AND bits & before = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN bits & bit <> 0 AND bits & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, x)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM r
"""


@_query("op13_filter_interactions", _OP13_SQL)
def op13_filter_interactions(table):
    """What five filters remove in every order, per source."""
    return interaction.audit(table("documents"), table("labels"))
