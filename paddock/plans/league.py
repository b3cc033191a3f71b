"""The season statistics store: collect, enrich, normalise into eight tables, load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock import contracts
from paddock.functions import columns as C
from paddock.functions import text as X
from paddock.operators import joins, rows
from paddock.operators.scan import dense_ids
from paddock.plans import values as V
from paddock.session import checkpoint, kept
from paddock.sources import files


# What a season's fact belongs to.
NATURAL = ["driver_id", "series", "season"]


def build_stats(payloads: DataFrame) -> DataFrame:
    """One row per (id, series), from the newest season that has the driver."""
    kept = C.drop_listed(payloads, V.DROPPED_FIELDS)
    newest = rows.first_per_key(kept, ["id", "series"], [F.col("season").desc(), "pos"])
    return newest.drop("season", "pos")


def build_standings(payloads: DataFrame) -> DataFrame:
    """One row per (id, series, season), the first one of its payload."""
    return rows.first_per_key(payloads, ["id", "series", "season"], ["pos"]).drop("pos")


def enrich_debut(stats: DataFrame, debut: DataFrame, debut_others: DataFrame, races: DataFrame,
                 overrides: DataFrame) -> DataFrame:
    """Fill ``rookie_year``: debut list by name and series, then by name, then the pages.

    ``debut(full_name, series, rookie_year, pos)``, ``debut_others(full_name,
    rookie_year, pos)``, ``races(full_name, series, rookie_year)``, and
    ``overrides(seq, full_name, series, value)`` last.
    """
    exact = rows.first_per_key(debut, ["full_name", "series"], ["pos"]).select(
        "full_name", "series", F.col("rookie_year").alias("_exact"))
    loose = rows.first_per_key(debut_others, ["full_name"], ["pos"]).select("full_name", F.col("rookie_year").alias("_loose"))
    pages = races.groupBy("full_name", "series").agg(F.min("rookie_year").alias("_page"))
    joined = stats.join(exact, ["full_name", "series"], "left").join(loose, "full_name", "left").join(
        pages, ["full_name", "series"], "left")
    year, _ = joins.first_known({c: F.col(c) for c in ("rookie_year", "_exact", "_loose", "_page")})
    filled = joined.withColumn("rookie_year", year).select(*stats.columns)
    return joins.apply_overrides(filled, overrides, "full_name", "rookie_year", second_key="series")


def debut_list(pages: DataFrame) -> DataFrame:
    """(pos, full_name, rookie_year, series) from list pages ``(html)``, series by position."""
    rows_found = F.posexplode(X.find_all(F.col("html"), X.DEBUT_ROW, (1, 2))).alias("pos", "m")
    listed = pages.select(rows_found).select("pos", F.col("m.g1").alias("full_name"), F.col("m.g2").try_cast("int").alias("rookie_year"))
    return listed.withColumn("series", C.by_position(F.col("pos"), V.DEBUT_RANGES))


def debut_lists(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The list in two parts: rows of the three series, and rows of other series for lookups by name alone."""
    listed = checkpoint(debut_list(pages))
    return listed.where("series IS NOT NULL"), listed.where("series IS NULL").drop("series")


def female_names(pages: DataFrame) -> DataFrame:
    """(full_name) from list pages ``(html)``."""
    return pages.select(F.explode(X.merged_matches(F.col("html"), X.FEMALE_ROW, (1,))).alias("full_name"))


def page_races(names: DataFrame, pages: DataFrame, aliases: DataFrame, league: str) -> DataFrame:
    """(full_name, series, rookie_year) from the page of every name.

    ``pages(page_key, html)``; the page is found by plain, suffixed or alias key.
    """
    races = pages.select("page_key", X.first_races(F.col("html"), league).alias("races"))
    # Written once: both joins below need it, and the pages are the large input.
    found = checkpoint(races.where(F.size("races") > 0))
    chosen = X.resolve_pages(names, found, aliases).join(found, "page_key")
    races = chosen.select("full_name", F.explode("races").alias("r"))
    return races.select("full_name", C.map_values(F.col("r.series"), V.SERIES_CODES).alias("series"),
                        F.col("r.year").try_cast("int").alias("rookie_year"))


def corrected_races(names: DataFrame, races: DataFrame, corrections: DataFrame) -> DataFrame:
    """First races with the cells entered by hand, ``corrections(seq, full_name, value)``.

    A correction replaces all races of a name, the last one wins, and a name
    without a page gets its race that way. Names that are not asked for stay out.
    """
    newest = corrections.join(names.select("full_name").distinct(), "full_name", "left_semi").groupBy("full_name").agg(
        F.max_by("value", "seq").alias("value"))
    year, series = X.split_two(F.col("value"))
    entered = newest.select("full_name", C.map_values(series, V.SERIES_CODES).alias("series"), year.try_cast("int").alias("rookie_year"))
    return races.join(newest.select("full_name"), "full_name", "left_anti").unionByName(entered)


def enrich(stats: DataFrame, debut_pages: DataFrame, driver_pages: DataFrame, female_pages: DataFrame, aliases: DataFrame,
           year_overrides: DataFrame, race_corrections: DataFrame, league: str) -> DataFrame:
    """``stats`` with debut years and genders, from the pages and the values entered by hand."""
    exact, others = debut_lists(debut_pages)
    names = checkpoint(stats.select("full_name").distinct())
    races = corrected_races(names, page_races(names, driver_pages, aliases, league), race_corrections)
    return enrich_gender(enrich_debut(stats, exact, others, races, year_overrides), female_names(female_pages))


def collect_and_store(stats_payloads: DataFrame, standings_payloads: DataFrame, folder: str, **sources) -> dict[str, str]:
    """From payloads and pages to the eight written tables; ``sources`` are those of ``enrich``."""
    stats = kept(enrich(build_stats(stats_payloads), **sources))
    return store(stats, kept(build_standings(standings_payloads)), folder)


def enrich_gender(stats: DataFrame, female_names: DataFrame) -> DataFrame:
    """Fill ``gender`` from the list of female names; nobody on the list is M."""
    listed = female_names.select("full_name").distinct().withColumn("_female", F.lit(True))
    joined = stats.join(listed, "full_name", "left")
    label = C.flag_label(F.coalesce("_female", F.lit(False)))
    return joined.withColumn("gender", F.coalesce("gender", label)).select(*stats.columns)


def personal_info(stats: DataFrame, bound: DataFrame | int | None = None) -> DataFrame:
    """One row per driver, ids in the order of the natural key."""
    place = F.array_position(F.array(*[F.lit(x) for x in V.SERIES_ORDER]), F.col("series"))
    people = rows.first_per_key(stats, ["driver_id"], [place, "series"])
    wanted = [f.name for f in contracts.schema_of("personal_info") if f.name != "id"]
    return contracts.conform(dense_ids(people.select(*wanted), ["driver_id"], bound=bound), "personal_info")


def race_info(standings: DataFrame, bound: DataFrame | int | None = None) -> DataFrame:
    races = standings.select("series", F.col("season").try_cast("int").alias("season")).distinct()
    return contracts.conform(dense_ids(races, ["season", "series"], bound=bound), "race_info")


def _measures(table: str) -> list[str]:
    return [f.name for f in contracts.schema_of(table) if f.name not in (contracts.PRIMARY_KEYS[table], "driver_id", "race_id")]


def _fact(source: DataFrame, table: str, people: DataFrame, races: DataFrame | None,
          bound: DataFrame | int | None) -> DataFrame:
    """Distinct fact rows with surrogate keys and ids in the order of the row."""
    measures = _measures(table)
    if races is None:
        natural = ["driver_id"]
    else:
        natural = NATURAL
        source = source.withColumn("season", F.col("season").try_cast("int"))
    facts = source.select(*natural, *measures).distinct()
    numbered = dense_ids(facts, natural + [m for m in measures if m not in natural], contracts.PRIMARY_KEYS[table], bound=bound)
    return contracts.conform(_linked(numbered, people, races), table)


def _linked(numbered: DataFrame, people: DataFrame, races: DataFrame | None) -> DataFrame:
    """Natural keys replaced by those of the parents."""
    if races is not None:
        numbered = joins.surrogate(numbered, races, ["series", "season"], "id", "race_id")
    driver = people.select(F.col("driver_id").alias("_natural"), F.col("id").alias("_driver"))
    linked = numbered.withColumnRenamed("driver_id", "_natural")
    return linked.join(driver, linked["_natural"].eqNullSafe(driver["_natural"]), "left").drop("_natural").withColumnRenamed("_driver", "driver_id")


def _season_facts(standings: DataFrame, names: list[str], people: DataFrame, races: DataFrame,
                  bound: DataFrame | int | None) -> dict[str, DataFrame]:
    """The named fact tables per driver and race.

    Where no natural key repeats, which is looked at, their rows have the same
    order, whatever the measures, so they are numbered and linked once for all.
    """
    rows = standings.withColumn("season", F.col("season").try_cast("int"))
    if len(names) < 2 or not rows.groupBy(*NATURAL).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        return {n: _fact(standings, n, people, races, bound) for n in names}
    measures = list(dict.fromkeys(m for n in names for m in _measures(n)))
    numbered = dense_ids(rows.select(*NATURAL, *measures), NATURAL, "_number", bound=bound)
    linked = kept(_linked(numbered, people, races))
    return {n: contracts.conform(linked.withColumnRenamed("_number", contracts.PRIMARY_KEYS[n]), n) for n in names}


def social_media(stats: DataFrame, people: DataFrame, bound: DataFrame | int | None = None) -> DataFrame:
    handles = stats.select("driver_id", C.strip_pattern(F.col("twitter"), "@").alias("twitter")).distinct()
    return _fact(rows.unique_or_complete(handles, ["driver_id"]), "social_media", people, None, bound)


def normalise(stats: DataFrame, standings: DataFrame, names: list[str] = tuple(contracts.LOAD_ORDER),
              people: DataFrame | None = None, races: DataFrame | None = None,
              bound: DataFrame | int | None = None) -> dict[str, DataFrame]:
    """The named tables; missing values are decoded first, keys become surrogates.

    ``people`` and ``races`` are the two parent tables if they are built already.
    ``bound`` is a number of rows no table exceeds, or a frame with at least as many rows that is cheap to count.
    """
    stats = C.decode_missing(stats.withColumnRenamed("id", "driver_id"))
    standings = C.decode_missing(standings.withColumnRenamed("id", "driver_id"))
    facts = {"seasonal_achievement", "detailed_performance", "earnings"}
    # Parents that several children look their keys up in are written once, and not built again for each.
    shared = checkpoint if len(set(names) - {"personal_info", "race_info"}) > 1 else (lambda df: df)
    if people is None and set(names) != {"race_info"}:
        people = shared(personal_info(stats, bound))
    if races is None and facts.union(["race_info"]).intersection(names):
        races = shared(race_info(standings, bound))
    build = {
        "personal_info": lambda: people,
        "race_info": lambda: races,
        "social_media": lambda: social_media(stats, people, bound),
        "debut_info": lambda: _fact(stats, "debut_info", people, None, bound),
        "status_info": lambda: _fact(standings, "status_info", people, None, bound),
    }
    seasons = _season_facts(standings, [n for n in names if n in facts], people, races, bound) if facts.intersection(names) else {}
    return {n: build[n]() if n in build else seasons[n] for n in names}


def store(stats: DataFrame, standings: DataFrame, folder: str, counts: dict[str, int] | None = None) -> dict[str, str]:
    """Build and write all tables; children look their keys up in the written parents.

    ``counts`` gets the rows of every table, counted while they are written.
    """
    counts = {} if counts is None else counts
    spark = stats.sparkSession
    paths = {n: f"{folder}/{n}.parquet" for n in contracts.LOAD_ORDER}
    parents = ["personal_info", "race_info"]
    # No table has more rows than both sources together; they are counted once for all tables.
    bound = stats.count() + standings.count()
    for name, df in normalise(stats, standings, parents, bound=bound).items():
        counts[name] = files.write_counted(df, paths[name])
    people, races = (spark.read.schema(contracts.schema_of(n)).parquet(paths[n]) for n in parents)
    children = [n for n in contracts.LOAD_ORDER if n not in parents]
    for name, df in normalise(stats, standings, children, people, races, bound).items():
        counts[name] = files.write_counted(df, paths[name])
    return paths


def load(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """Read the stored tables and create a view of each, parents first."""
    tables = {n: spark.read.schema(contracts.schema_of(n)).parquet(p) for n, p in paths.items()}
    contracts.create_tables(spark, tables)
    return tables


def star(tables: dict[str, DataFrame]) -> DataFrame:
    """One wide row per driver and race, the input of the feature job."""
    races = tables["race_info"].select(F.col("id").alias("race_id"), "series", "season")
    people = tables["personal_info"].select(F.col("id").alias("driver_id"), "gender", "country", "birthday")
    debut = tables["debut_info"].groupBy("driver_id", "series").agg(F.min("rookie_year").alias("rookie_year"))
    facts = tables["seasonal_achievement"].drop("seasonal_achievement_id").join(
        tables["detailed_performance"].drop("detailed_performance_id"), ["driver_id", "race_id"])
    return facts.join(races, "race_id").join(people, "driver_id").join(debut, ["driver_id", "series"], "left")
