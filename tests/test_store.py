import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock import contracts
from paddock.plans import league
from paddock.session import workspace
from paddock.sources import files, jdbc

STATS = ("id string, first_name string, last_name string, full_name string, gender string, height string, weight string, birthday string, "
         "birth_place string, country string, twitter string, rookie_year int, series string")
STANDING = ("id string, series string, season string, status string, rank int, starts int, points int, wins int, stage_wins int, poles int, "
            "top_5 int, top_10 int, top_15 int, top_20 int, chase_bonus double, chase_wins double, chase_stage_wins double, laps_led int, "
            "laps_completed int, avg_start_position double, avg_finish_position double, avg_laps_completed double, laps_led_pct double, "
            "dnf int, in_chase boolean, behind double, money double")


@pytest.fixture(scope="module")
def inputs(spark):
    def person(i, series, twitter, gender=None, year=None):
        return (i, "F", "L", f"F L {i}", gender, "nan value", "70", "1990-02-03", "nan", "US", twitter, year, series)

    def standing(i, series, season, rank):
        return (i, series, season, "act", rank, 1, 2, 3, None, 5, 6, 7, 8, 9, None, None, None, 1, 2, 1.0, 2.0, 3.0, 0.5, 0, True, -1.0, 9.5)

    stats = spark.createDataFrame(
        [person("d1", "xf", "@a", year=2001), person("d1", "cw", None), person("d2", "sc", None), person("d3", "sc", "x"), person("d3", "xf", "@y")], STATS)
    standings = spark.createDataFrame(
        [standing("d1", "xf", "2021", 3), standing("d1", "cw", "2020", 4), standing("d2", "sc", "2021", 60), standing("d3", "sc", "2021", 20)], STANDING)
    return stats, standings


def test_store_has_whole_keys_and_round_trips(spark, inputs):
    counts = {}
    paths = league.store(*inputs, workspace(spark, "store"), counts)
    tables = league.load(spark, paths)
    assert counts == {n: df.count() for n, df in tables.items()}
    assert counts == {"personal_info": 3, "race_info": 3, "social_media": 4, "seasonal_achievement": 4, "detailed_performance": 4,
                      "earnings": 4, "debut_info": 5, "status_info": 3}
    assert contracts.violations(tables).where("n_bad > 0").isEmpty()
    assert all(not contracts.schema_violations(df, n) for n, df in tables.items())
    people = {r.driver_id: r for r in tables["personal_info"].collect()}
    assert people["d1"].id == 1 and people["d1"].height is None and people["d1"].weight == 70.0 and people["d1"].birth_place is None
    handles = sorted((r.driver_id, r.twitter or "") for r in tables["social_media"].collect())
    assert handles == [(1, "a"), (2, ""), (3, "x"), (3, "y")]
    wide = league.star(tables)
    assert wide.count() == 4 and wide.where("series = 'xf'").first().rookie_year == 2001


def test_violations_are_found(spark, inputs):
    tables = league.normalise(*inputs)
    tables["earnings"] = tables["earnings"].withColumn("driver_id", F.when(F.col("money") > 0, F.lit(99)).cast("long"))
    tables["race_info"] = tables["race_info"].unionByName(tables["race_info"])
    bad = {(r.kind, r.table_name): r.n_bad for r in contracts.violations(tables).where("n_bad > 0").collect()}
    assert bad == {("primary_key", "race_info"): 3, ("foreign_key", "earnings"): 4}
    assert contracts.row_count_check(tables["personal_info"], 481).first().ok is False


def test_build_takes_the_newest_season(spark):
    payload = spark.createDataFrame(
        [("a", "xf", "2020", 0, "old", "s"), ("a", "xf", "2022", 1, "new2", "s"), ("a", "xf", "2022", 0, "new", "s"), ("a", "cw", "2015", 0, "cw", "s")],
        "id string, series string, season string, pos int, full_name string, status string")
    built = {(r.series, r.full_name) for r in league.build_stats(payload).collect()}
    assert built == {("xf", "new"), ("cw", "cw")} and "status" not in league.build_stats(payload).columns
    assert league.build_standings(payload).count() == 3


def test_payload_scan_with_drifting_fields(spark):
    path = workspace(spark, "payloads")
    for season, text in (("2021", '{"drivers":[{"id":"a","college":"x"},{"id":"b"}]}'), ("2022", '{\n"drivers":[{"id":"a"}]\n}')):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{path}/series=xf/season={season}")
    rows = files.read_payloads(spark, path, T.StructType.fromDDL("id string, college string")).collect()
    assert sorted((r.season, r.pos, r.id, r.college) for r in rows) == [
        (2021, 0, "a", "x"), (2021, 1, "b", None), (2022, 0, "a", None)]


def test_bad_lines_are_kept_apart(spark):
    path = workspace(spark, "lines")
    spark.createDataFrame([("id,n",), ("1,2",), ("x,3",), ("4,5,6",), ("7",)], "value string").write.text(path)
    good, bad = files.load_checked(spark, path, T.StructType.fromDDL("id int, n int"), header="id,n")
    assert [tuple(r) for r in good.collect()] == [(1, 2)]
    assert {r[files.BAD] for r in bad.collect()} == {"x,3", "4,5,6", "7"}


def test_csv_index_column_is_dropped(spark):
    path = workspace(spark, "csv")
    spark.createDataFrame([(",full_name,year",), ("0,A B,2007",), ("1,\"C, D\",",)], "value string").coalesce(1).write.text(path)
    rows = files.read_csv(spark, path, T.StructType.fromDDL("full_name string, year int"), index_column="_c0").collect()
    assert [tuple(r) for r in rows] == [("A B", 2007), ("C, D", None)]


def test_pages_are_read_whole(spark):
    path = workspace(spark, "pages")
    spark.createDataFrame([("<a>",), ("</a>",)], "value string").coalesce(1).write.text(path)
    assert [r.html for r in files.read_pages(spark, path).collect()] == ["<a>\n</a>\n"]


def test_jdbc_append_goes_parents_first():
    written = []

    class Writer:
        def __init__(self, name):
            self.write, self.name = self, name

        def jdbc(self, url, table, mode, properties):
            written.append((table, mode))

    names = ["earnings", "race_info", "personal_info"]
    order = jdbc.append_tables({n: Writer(n) for n in names}, "jdbc:x", {"user": "u"}, prefix="s.")
    assert order == ["personal_info", "race_info", "earnings"] and written[0] == ("s.personal_info", "append")


def test_workspace_is_cleared_as_a_whole(spark):
    from paddock.session import clear_workspace
    path = workspace(spark, "gone")
    spark.range(3).write.parquet(path)
    assert clear_workspace(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


FACTS = ["seasonal_achievement", "detailed_performance", "earnings"]


def _facts(tables):
    return {n: sorted(map(tuple, tables[n].collect()), key=str) for n in FACTS}


@pytest.mark.parametrize("repeated", [False, True])
def test_season_facts_are_numbered_once_and_as_they_were_each(spark, inputs, monkeypatch, repeated):
    stats, standings = inputs
    if repeated:
        # One more row of a key, with measures of its own for one table only.
        standings = standings.unionByName(standings.withColumn("money", F.lit(-1).cast(standings.schema["money"].dataType)))
    alone = {n: league.normalise(stats, standings, [n])[n] for n in FACTS}
    calls, real = [], league.dense_ids
    monkeypatch.setattr(league, "dense_ids", lambda *a, **k: calls.append(1) or real(*a, **k))
    together = league.normalise(stats, standings, ["personal_info", "race_info", *FACTS])
    assert _facts(together) == _facts(alone)
    assert len(calls) == 2 + (3 if repeated else 1)
