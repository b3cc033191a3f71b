"""URL rules, and block decisions carried over to aliases.

A rule is a host and a path prefix with a verdict. It fits its host and all
subdomains; the longest fitting rule decides, allow before block among equals.
Pages without a fitting rule take over what their aliases were told: two urls are
aliases when a canonical link or a redirect leads from one to the other, directly
or over others. An allowed alias outweighs blocked ones; with neither the page is
allowed.

Aliases are the connected components of the link edges, found in rounds of joins
and aggregates; only urls with a link take part, and each round is written to the
shared folder. The rule list is configuration: it is a Python value of at most
``MAX_RULES`` entries and travels inside the expression.

Link targets are read as a browser reads them: character references are decoded,
relative targets are resolved against the url of the page. Aliases are matched
without dot segments, and an empty path is the path ``/``.

Defined cases: a link to something without a host (``mailto:``) is no alias; a missing url, or one without ``://``, has an empty host and path,
fits no rule and is allowed; repeated urls get equal verdicts; pages without links
need no join; the columns host, path, rule and verdict replace input columns of
these names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.llm.exprs import let
from paddock.operators.graph import connected_components

MAX_RULES = 10_000

# Links that make two urls aliases: rel=canonical, and refresh with a target.
CANONICAL = (
    r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*\bhref\s*=\s*["']?([^"'\s>]+)""",
    r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\burl\s*=\s*["']?((?:[^"'\s>;&]++|&#?\w{1,31}+;|&)+)""",
)

# Character references: decimal, hexadecimal, by name.
_REFERENCE = r"&(?:#0*([0-9]{1,7});?|#[xX]0*([0-9A-Fa-f]{1,6});?|(amp|lt|gt|quot|apos);)"
_NAMED = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _plain_path(path: Column) -> Column:
    """``path`` without ``.`` and ``..`` segments; an empty one is ``/``."""
    def walk(done, x):
        return F.when(x == ".", done).when(x == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))).otherwise(
            F.concat(done, F.array(x)))

    walked = F.array_join(F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), walk), "/")
    dotted = F.concat(walked, F.when(path.rlike(r"/\.\.?$"), F.lit("/")).otherwise(F.lit("")))
    return F.when(path == "", F.lit("/")).when(path.rlike(r"/\.\.?(?:/|$)"), dotted).otherwise(path)


def alias_key(url: Column) -> Column:
    """What names a page whatever the scheme: host, path and query, without the fragment."""
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1)
    return F.when(url.contains("://"), F.concat(host_of(url), _plain_path(path_of(url)), query))


def _decoded(text: Column) -> Column:
    """``text`` with its character references replaced, each once."""
    def of(group):
        return F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(group))

    def char(code):
        known = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        return F.decode(F.unhex(F.lpad(F.hex(F.when(known, code).otherwise(F.lit(0xFFFD))), 8, "0")), "UTF-32")

    def read(number, hexadecimal):
        return F.when(number != "", char(number.try_cast("long"))).when(
            hexadecimal != "", char(F.conv(hexadecimal, 16, 10).try_cast("long")))

    names = F.create_map(*[F.lit(x) for pair in _NAMED.items() for x in pair])
    chars = F.zip_with(F.zip_with(of(1), of(2), read), of(3), lambda c, name: F.coalesce(c, names[name]))
    whole = F.zip_with(F.split(text, _REFERENCE, -1), chars, lambda gap, c: F.concat(gap, F.coalesce(c, F.lit(""))))
    return F.when(text.contains("&"), F.array_join(whole, "")).otherwise(text)


def resolved(target: Column, url: Column) -> Column:
    """``target`` as an absolute url, seen from the page ``url``; missing if it has no host."""
    scheme_host = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*", 0)
    folder = F.regexp_extract(path_of(url), r"(?s)^.*/", 0)
    return (F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
            .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
            .when(target.startswith("//"), F.concat(F.lit("http:"), target))
            .when(target.startswith("/"), F.concat(scheme_host, target))
            .when(target.startswith("?"), F.concat(scheme_host, path_of(url), target))
            .when(target.startswith("#"), url)
            .otherwise(F.concat(scheme_host, F.when(folder == "", F.lit("/")).otherwise(folder), target)))


def fitting_rule(host: Column, path: Column, rules: list[UrlRule]) -> Column:
    """The longest rule that fits as (size, allow, rule, verdict), or missing.

    The suffixes of the host are looked up in a map of rules by host, so the work
    per url grows with its labels and not with the number of rules.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    by_host: dict[str, list[UrlRule]] = {}
    for rule in rules:
        by_host.setdefault(rule.host, []).append(rule)

    def entry(rule):
        return F.struct(F.lit(len(rule.text)).alias("size"), F.lit(rule.verdict == "allow").alias("allow"),
                        F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"), F.lit(rule.path).alias("path"))

    pairs = [x for h, some in by_host.items() for x in (F.lit(h), F.array(*[entry(r) for r in some]))]
    if not pairs:
        return F.lit(None).cast("struct<size:int,allow:boolean,rule:string,verdict:string,path:string>")
    table = F.create_map(*pairs)

    def best(labels):
        suffixes = F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))
        known = F.filter(F.transform(suffixes, lambda s: table[s]), lambda r: r.isNotNull())
        return F.array_max(F.filter(F.flatten(known), lambda r: path.startswith(r["path"])))

    return let(F.split(host, r"\."), best)


def links(pages: DataFrame) -> DataFrame:
    """Distinct (src, dst) alias keys of the canonical and redirect links of the pages.

    Links without a host are relative to the page's own url.
    """
    found = F.flatten(F.array(*[F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(p), F.lit(1)) for p in CANONICAL]))
    targets = pages.where(F.col("url").contains("://")).select("url", F.explode(found).alias("to")).withColumn(
        "to", _decoded(F.col("to"))).withColumn("to", resolved(F.col("to"), F.col("url")))
    edges = targets.where(F.col("to").isNotNull()).select(alias_key(F.col("url")).alias("src"), alias_key(F.col("to")).alias("dst"))
    return edges.where("src <> dst").distinct()


def judge(pages: DataFrame, rules: list[UrlRule], edges: DataFrame | None = None) -> DataFrame:
    """``pages`` with host, path, rule and verdict. ``edges`` adds (src, dst) urls of known redirects."""
    made = ("host", "path", "rule", "verdict")
    own = pages.drop(*made).withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    own = own.withColumn("_fit", fitting_rule(F.col("host"), F.col("path"), rules))
    all_links = links(pages)
    if edges is not None:
        more = edges.select(alias_key(F.col("src")).alias("src"), alias_key(F.col("dst")).alias("dst"))
        all_links = all_links.unionByName(more.where("src <> dst")).distinct()
    # Only linked urls are labelled: their number is that of the links, not of the pages.
    labels = connected_components(all_links)
    member = labels.withColumn("_host", F.regexp_extract("id", r"(?s)^[^/?]*", 0)).withColumn(
        "_path", F.regexp_extract("id", r"(?s)^[^/?]*([^?]*)", 1))
    told = member.withColumn("fit", fitting_rule(F.col("_host"), F.col("_path"), rules))
    decision = told.groupBy("component").agg(F.max(F.col("fit.allow")).alias("any_allow"),
                                             F.max(F.col("fit.verdict") == "block").alias("any_block"))
    carried = labels.join(decision, "component").select(
        F.col("id").alias("_key"), F.when(F.coalesce("any_allow", F.lit(False)), F.lit("allow"))
        .when(F.coalesce("any_block", F.lit(False)), F.lit("block")).alias("_alias"))
    keyed = own.withColumn("_key", F.when(F.col("_fit").isNull(), alias_key(F.col("url"))))
    joined = keyed.join(carried, "_key", "left")
    return joined.withColumns({
        "rule": F.col("_fit.rule"),
        "verdict": F.coalesce(F.col("_fit.verdict"), F.col("_alias"), F.lit("allow")),
    }).drop("_fit", "_key", "_alias")
