from pyspark.sql import functions as F

from paddock.functions import text as X
from paddock.plans import league, values as V

DEBUT_PAGE = (
    '<td><a href="/a" title="A B">A B</a>\n</td>\n<td>2007\n</td>'
    '<td><span><span><span><a href="/c" title="C D">C D</a></span></span></span>\n</td>\n<td>2010\n</td>'
    '<td><a href="/e" title="E F">E F</a>\n</td>\n<td>\n</td>'
    '<td><a href="/g" title="G H">G H</a>\n</td>\n<td>2020\n</td>')
FEMALE_PAGE = '<th><a href="/a">Ann A</a><sup class="reference">1</sup></th>\n<th><a href="/b">Bea B</a>\n</th>\n<td><a href="/c">No C</a></td>'
TWO_RACES = ('<th>First race</th> <a title="2018 League Camping World Truck Series">2018</a>\n'
             'First race <a title="2020 League Xfinity Series">2020</a>')


def test_debut_list_keeps_the_row_without_year(spark):
    pages = spark.createDataFrame([(DEBUT_PAGE,)], "html string")
    assert [tuple(r) for r in league.debut_list(pages).orderBy("pos").collect()] == [
        (0, "A B", 2007, "sc"), (1, "C D", 2010, "sc"), (2, "E F", None, "sc"), (3, "G H", 2020, "sc")]


def test_female_names(spark):
    pages = spark.createDataFrame([(FEMALE_PAGE,)], "html string")
    assert [r.full_name for r in league.female_names(pages).collect()] == ["Ann A", "Bea B"]


def test_pages_with_no_one_and_two_races(spark):
    names = spark.createDataFrame([("A B",), ("C D",), ("E F",), ("G H",)], "full_name string")
    one = 'First race <a title="2011 League Cup Series">2011</a>'
    pages = spark.createDataFrame(
        [("A_B", TWO_RACES), ("C_D", "nothing"), ("C_D_(racing_driver)", one), ("Odd_F", one), ("E_F", "nothing")], "page_key string, html string")
    aliases = spark.createDataFrame([("E F", "Odd_F")], "full_name string, page_key string")
    found = {tuple(r) for r in league.page_races(names, pages, aliases, "League").collect()}
    assert found == {("A B", "cw", 2018), ("A B", "xf", 2020), ("C D", "sc", 2011), ("E F", "sc", 2011)}


def test_list_cells_become_rows(spark):
    df = spark.createDataFrame([(1, "[('2018', 'B'), ('2020', 'C')]"), (2, "[]"), (3, None)], "id int, cell string")
    assert {(r.id, r.race) for r in X.list_cell_rows(df, "cell", "race").collect()} == {
        (1, "2018, B"), (1, "2020, C"), (2, None), (3, None)}


def test_split_two_keeps_later_separators(spark):
    head, rest = X.split_two(F.col("s"))
    df = spark.createDataFrame([("a, b, c",), ("a",), (None,)], "s string").select(head.alias("h"), rest.alias("r"))
    assert [tuple(r) for r in df.collect()] == [("a", "b, c"), ("a", None), (None, None)]


def test_positions_and_gap(spark):
    df = spark.createDataFrame([(["x", "y", "x"],)], "a array<string>")
    assert df.select(X.positions_of(F.col("a"), F.lit("x")).alias("p")).first().p == [0, 2]
    assert df.select(X.insert_gap(F.col("a"), 1).alias("p")).first().p == ["x", None, "y", "x"]
    assert df.select(X.insert_gap(F.col("a"), 3).alias("p")).first().p == ["x", "y", "x", None]


def test_merged_groups(spark):
    df = spark.createDataFrame([("<a>1</a><b>2</b>",)], "s string")
    assert df.select(X.merged_matches(F.col("s"), "<a>(.)</a>|<b>(.)</b>", (1, 2)).alias("m")).first().m == ["1", "2"]


def test_fixed_values_are_usable(spark):
    assert V.year_overrides(spark).count() == 32 and V.race_overrides(spark).count() == 9 and V.page_aliases(spark).count() == 12
