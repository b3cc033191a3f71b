"""Pattern extraction from pages and list cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Suffix of a disambiguated page title, and the row patterns of a
# debut list (two spellings of the name cell, year cell may be empty).
PAGE_SUFFIX = "_(racing_driver)"
DEBUT_ROW = r'">([^<>\n]*)</a>(?:</span></span></span>)?\n</td>\n<td>(\d{4})?\n</td>'
# The "first race" line of a driver's page: the year of the link and the series after the league's name.
# The league's name comes before the series; it is a parameter.
FIRST_RACE = r'First\srace.*?title="(\d{4}?).*LEAGUE\s(.*?)">\d{4}</a>'
FEMALE_ROW = r'<th>[^\n]*">([^\n<]*)</a>(?:<sup class="reference"|\n</th>)'


def find_all(text: Column, pattern: str, groups: Sequence[int]) -> Column:
    """All matches as array<struct<g1, g2, ...>>, empty text for an unused group."""
    lists = [F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in groups]
    return F.arrays_zip(*[c.alias(f"g{g}") for g, c in zip(groups, lists)])


def merged_matches(text: Column, pattern: str, groups: Sequence[int]) -> Column:
    """All matches with the groups of each match joined to one text."""
    found = find_all(text, pattern, groups)
    return F.transform(found, lambda m: F.concat(*[m[f"g{g}"] for g in groups]))


def positions_of(items: Column, element: Column) -> Column:
    """Zero-based positions of an element in an array, ascending."""
    marked = F.transform(items, lambda x, i: F.when(x == element, i))
    return F.array_compact(marked)


def split_two(column: Column, separator: str = ",") -> tuple[Column, Column]:
    """Text before and after the first separator, trimmed; NULL if there is none."""
    parts = F.split(column, separator, 2)
    return F.trim(parts[0]), F.trim(F.get(parts, F.lit(1)))


def insert_gap(items: Column, position: int | Column) -> Column:
    """The array with a NULL inserted at a zero-based position."""
    missing, position = F.array(F.lit(None).cast("string")), F.lit(position)
    return F.concat(F.slice(items, F.lit(1), position), missing,
                    F.slice(items, position + 1, F.greatest(F.size(items) - position, F.lit(0))))


def page_key(name: Column, suffix: str = "") -> Column:
    return F.concat(F.replace(name, F.lit(" "), F.lit("_")), F.lit(suffix))


def first_races(html: Column, league: str) -> Column:
    """array<struct<year, series>> of the "first race" lines of a driver's page."""
    found = find_all(html, FIRST_RACE.replace("LEAGUE", league), (1, 2))
    return F.transform(found, lambda m: F.struct(m["g1"].alias("year"), m["g2"].alias("series")))


def list_cell_rows(df: DataFrame, cell: str, as_name: str) -> DataFrame:
    """Rows from a list written as text, ``[('2018', 'B'), ('2020', 'C')]``.

    An empty list gives one row with NULL, each pair one row ``2018, B``.
    """
    inner = F.nullif(F.translate(F.col(cell), "[]", ""), F.lit(""))
    parts = F.filter(F.split(inner, r"\)"), lambda x: x != "")
    exploded = df.select("*", F.explode_outer(parts).alias(as_name))
    cleaned = F.regexp_replace(F.col(as_name), r",\s\(|\(|'", "")
    return exploded.withColumn(as_name, cleaned)


def resolve_pages(names: DataFrame, pages: DataFrame, aliases: DataFrame, suffix: str = PAGE_SUFFIX) -> DataFrame:
    """The page of every name: plain key first, then suffixed key, then alias.

    ``names(full_name)``, ``pages(page_key, ...)``, ``aliases(full_name, page_key)``.
    All candidate keys meet the pages in one join; the lowest tier that hit wins.
    """
    plain = page_key(F.col("full_name"))
    candidates = names.select("full_name", F.explode(F.array(
        F.struct(F.lit(1).alias("tier"), plain.alias("page_key")),
        F.struct(F.lit(2).alias("tier"), F.concat(plain, F.lit(suffix)).alias("page_key")),
    )).alias("c")).select("full_name", "c.*")
    aliased = names.join(aliases, "full_name").select("full_name", F.lit(3).alias("tier"), "page_key")
    hits = candidates.unionByName(aliased).join(pages.select("page_key"), "page_key")
    best = hits.groupBy("full_name").agg(F.min(F.struct("tier", "page_key")).alias("b"))
    return best.select("full_name", "b.tier", "b.page_key")
