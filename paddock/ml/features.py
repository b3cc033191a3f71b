"""Feature table and feature vector of the rank-class model."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import MinMaxScaler, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.functions import columns as C
from paddock.operators import profile

# Columns of the model and the label.
CATEGORICAL = ["series", "gender", "country"]
NUMERIC = ["top_5", "chase_bonus", "avg_start_position", "avg_finish_position", "avg_laps_completed",
           "laps_led_pct", "age", "experience", "DNF_ratio"]
LABEL = "rank_class"
SPARSE = ["chase_wins", "chase_stage_wins"]


def feature_table(df: DataFrame, impute: list[str] = ("chase_bonus",), sparse: list[str] = tuple(SPARSE),
                  reference_year: int = C.REFERENCE_YEAR) -> DataFrame:
    """Missing values, ages, ratio and label, all in one projection after one pass for the means."""
    kept = profile.impute_zero_filled(C.drop_listed(df, sparse), list(impute))
    shaped = kept.withColumns({
        "age": C.years_since(F.year("birthday"), reference_year),
        "experience": C.years_since(F.col("rookie_year"), reference_year),
        "DNF_ratio": C.ratio_or_zero(F.col("dnf"), F.col("top_20")),
        LABEL: C.rank_band(F.col("rank")),
    })
    return shaped.drop("rookie_year", "birthday", "dnf", "top_20", "rank")


def encoder(categorical: list[str] = tuple(CATEGORICAL), numeric: list[str] = tuple(NUMERIC),
            invalid: str = "keep") -> Pipeline:
    """Index and one-hot the categories, scale the numbers to [0, 1], assemble ``features``."""
    index = StringIndexer(inputCols=list(categorical), outputCols=[c + "Index" for c in categorical],
                          handleInvalid=invalid, stringOrderType="frequencyDesc")
    one_hot = OneHotEncoder(inputCols=[c + "Index" for c in categorical], outputCols=[c + "classVec" for c in categorical])
    numbers = VectorAssembler(inputCols=list(numeric), outputCol="numbers", handleInvalid=invalid)
    scaled = MinMaxScaler(inputCol="numbers", outputCol="scaled")
    features = VectorAssembler(inputCols=[c + "classVec" for c in categorical] + ["scaled"], outputCol="features",
                               handleInvalid=invalid)
    return Pipeline(stages=[index, one_hot, numbers, scaled, features])


def stable_split(df: DataFrame, key: list[Column | str], share: int = 75, seed: int = 14) -> tuple[DataFrame, DataFrame]:
    """Two parts by a hash of the key: the same rows on every run and any layout."""
    bucket = F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(100))
    return df.where(bucket < share), df.where(bucket >= share)
