"""Fixed values of the season statistics store, stated as data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Payload fields that are not kept.
DROPPED_FIELDS = ["status", "residence", "track_type_splits", "track_splits", "race_splits", "children", "hobbies", "college"]

# The order in which the series are put together; the first row of a driver wins.
SERIES_ORDER = ("cw", "xf", "sc")

# Positions on the debut list and the series they belong to; later rows are other series.
DEBUT_RANGES = ((0, 57, "sc"), (58, 167, "xf"), (168, 288, "cw"))

# Names of the series in text and the code of each.
SERIES_CODES = {
    "Camping World Truck Series": "cw",
    "Craftsman Truck Series": "cw",
    "Gander Outdoors Truck Series": "cw",
    "Gander RV &amp; Outdoors Truck Series": "cw",
    "Xfinity Series": "xf",
    "Nationwide Series": "xf",
    "Busch Series": "xf",
    "Cup Series": "sc",
    "Sprint Cup Series": "sc",
}

# First-season corrections (name, series or None for all, year), in the order they apply.
YEAR_OVERRIDES = [
    ("Ronnie Bassett Jr", None, 2019),
    ("Cj McLaughlin", None, 2019),
    ("George Gorham Jr", None, 2021),
    ("T.J. Bell", None, 2003),
    ("D.J. Kennington", None, 2010),
    ("Darwin Peters Jr", None, 2019),
    ("Jason M. White", "xf", 1999),
    ("Jason M. White", "cw", 2018),
    ("Howie Disavino III", None, 2022),
    ("Trey Hutchens III", None, 2019),
    ("Juan Ma Gonzalez", None, 2019),
    ("Ty Majeski", None, 2019),
    ("Chris Fontaine", "xf", 2002),
    ("Josh Williams", "sc", 2022),
    ("Claire Decker", "xf", 2016),
    ("Gregory Vandersluis", "xf", 2017),
    ("Claire Decker", "xf", 2016),
    ("David Levine", "xf", 2015),
    ("Mark Meunier", "xf", 2019),
    ("Ryan Eversley", "xf", 2021),
    ("Robert Mitten", "cw", 2015),
    ("Jim Weiler", "cw", 2015),
    ("Cody Lane", "cw", 2015),
    ("Madeline Crane", "cw", 2015),
    ("Kyle Soper", "cw", 2016),
    ("Charles Buchanan", "cw", 2014),
    ("Jeff Zillweger", "cw", 2018),
    ("John Provenzano", "cw", 2018),
    ("Braden Mitchell", "cw", 2018),
    ("Rj Otto Jr", "cw", 2018),
    ("Brad Gross", "cw", 2021),
    ("Trevor Collins", "cw", 2018),
]

# First races entered by hand (name, text of the page cell), in the order they apply.
RACE_OVERRIDES = [
    ("Justin S Carroll", "2022, Camping World Truck Series"),
    ("Samuel Lecomte", "2021, Camping World Truck Series"),
    ("Jake Garcia", "2022, Camping World Truck Series"),
    ("John Atwell", "2021, Camping World Truck Series"),
    ("Buddy Kofoid", "2022, Camping World Truck Series"),
    ("Cody Lane", "2015, Camping World Truck Series"),
    ("Cody Lane", "2018, Xfinity Series"),
    ("Cassie Gannis", "2015, Camping World Truck Series"),
    ("Gar Robinson", "2022, Xfinity Series"),
]

# Names whose page has an unexpected key.
PAGE_ALIASES = [
    ("Doug Coby III", "Doug_Coby"),
    ("Jr Heffner", "J._R._Heffner"),
    ("Anthony Mrakovich", "Tony_Mrakovich"),
    ("Victor Gonzalez Jr", "Victor_Gonzalez_Jr."),
    ("Joshua Reeves", "Josh_Reeves"),
    ("Cj Faison", "C._J._Faison"),
    ("Derek Scott Jr", "Derek_Scott_Jr."),
    ("Nicholas Sanchez", "Nick_Sanchez"),
    ("Rc Enerson", "R._C._Enerson"),
    ("Robert Richardson", "Robert_Richardson_Jr._(racing_driver)"),
    ("Ruben Pardo", "Rubén_Pardo_(racing_driver)"),
    ("Matthew Bell", "Matt_Bell_(racing_driver)"),
]


def year_overrides(spark: SparkSession) -> DataFrame:
    rows = [(i, *r) for i, r in enumerate(YEAR_OVERRIDES)]
    return spark.createDataFrame(rows, "seq int, full_name string, series string, value int")


def race_overrides(spark: SparkSession) -> DataFrame:
    rows = [(i, *r) for i, r in enumerate(RACE_OVERRIDES)]
    return spark.createDataFrame(rows, "seq int, full_name string, value string")


def page_aliases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PAGE_ALIASES, "full_name string, page_key string")
