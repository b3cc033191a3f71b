import math

from pyspark.sql import functions as F

from paddock.functions import columns as C
from paddock.operators import profile


def values(df, column):
    return [r[column] for r in df.collect()]


def test_rank_band_edges(spark):
    df = spark.createDataFrame([(x,) for x in (None, -1.0, 0.0, 10.0, 10.5, 11.0, 30.0, 31.0, 50.0, 51.0)], "v double")
    assert values(df.select(C.rank_band(F.col("v")).alias("b")), "b") == [4, 4, 1, 1, 4, 2, 2, 3, 3, 4]


def test_ratio_is_zero_where_undefined(spark):
    df = spark.createDataFrame([(3, 0), (1, 2), (None, 0)], "a int, b int")
    assert values(df.select(C.ratio_or_zero(F.col("a"), F.col("b")).alias("r")), "r") == [0.0, 0.5, 0.0]


def test_missing_spellings(spark):
    df = spark.createDataFrame(
        [("x", 1.0), (None, float("nan")), ("", None), ("nan", 2.0), ("nan value", 3.0), ("4.5", 4.0)], "s string, d double")
    assert values(C.decode_missing(df), "s") == ["x", None, "", None, None, "4.5"]
    assert values(df.select(C.blank_to_null(F.col("s")).alias("s")), "s") == ["x", None, None, "nan", "nan value", "4.5"]
    encoded = C.encode_missing(df)
    assert values(encoded, "s")[1] == "nan value" and values(encoded, "d")[1:3] == ["nan value", "nan value"]
    assert values(C.try_cast_columns(df, {"s": "double"}), "s")[5] == 4.5
    assert values(C.try_cast_columns(df, {"s": "int"}), "s")[0] is None
    found = {r["column"]: (r.n_null, r.n_nan) for r in profile.missing_profile(df).collect()}
    assert found == {"s": (1, 0), "d": (1, 1)}


def test_fill_truncates_to_the_column_type(spark):
    df = spark.createDataFrame([(1, float("nan")), (None, None)], "i int, d double").na.fill({"i": 9.7, "d": 1.5})
    assert [tuple(r) for r in df.collect()] == [(1, 1.5), (9, 1.5)]


def test_value_mapping_trims_and_unescapes(spark):
    df = spark.createDataFrame([(" Truck &amp; Co",), ("Cup",), ("other",), (None,)], "s string")
    mapped = df.select(C.map_values(F.col("s"), {" Truck &amp; Co": "cw", "Cup": "sc"}).alias("s"))
    assert values(mapped, "s") == ["cw", "sc", "other", None]


def test_delete_where_keeps_unknown(spark):
    df = spark.createDataFrame([("",), (None,), ("a",)], "s string")
    assert values(C.delete_where(df, F.col("s") == ""), "s") == [None, "a"]


def test_zero_filled_mean_and_imputation(spark):
    df = spark.createDataFrame([(2.0,), (float("nan"),), (None,), (4.0,)], "v double")
    assert df.agg(profile.zero_filled_mean(F.col("v")).alias("m")).first().m == 1.5
    assert values(profile.impute_zero_filled(df, ["v"]), "v") == [2.0, 1.5, 1.5, 4.0]


def test_sparse_columns_are_dropped(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, None, float("nan")), (3, "x", 2.0)], "a int, b string, c double")
    assert profile.drop_sparse(df, 0.5).columns == ["a", "c"]


def test_correlation_skips_constant_columns_and_keeps_the_sign(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, -float(i), 7.0) for i in range(10)], "a double, b double, c double, k double")
    found = {(r.x, r.y) for r in profile.correlated_pairs(df, ["a", "b", "c", "k"]).collect()}
    assert found == {("a", "b"), ("b", "a")}


def test_summary_of_text_numbers(spark):
    row = profile.summary(spark.createDataFrame([(1,), (2,), (4,)], "v int"), ["v"]).first()
    assert (row.n, row.min, row.max) == (3, 1.0, 4.0) and math.isclose(row.mean, 7 / 3)


def test_schema_columns_except_time(spark):
    df = spark.sql("SELECT 1 AS a, current_timestamp() AS b, DATE '2020-01-01' AS c, TIMESTAMP_NTZ '2020-01-01' AS d, 'x' AS e")
    assert C.columns_except_time(df) == ["a", "e"]
