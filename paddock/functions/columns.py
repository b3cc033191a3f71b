"""Column expressions and whole-frame column rules: projection, filter, repair."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The spellings of "missing" found in landed text, and the band limits.
MISSING_TEXT = ("nan value", "nan")
SENTINEL = "nan value"
RANK_BANDS = ((0, 10, 1), (11, 30, 2), (31, 50, 3))
RANK_BAND_REST = 4
REFERENCE_YEAR = 2022


# Projections

def drop_listed(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop the listed columns; names that are not there are ignored."""
    return df.drop(*names)


def with_constant(df: DataFrame, **values) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def try_cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the named columns; text that does not parse becomes NULL."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in types.items()})


def years_since(year: Column, reference_year: int = REFERENCE_YEAR) -> Column:
    return F.lit(reference_year) - year


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator, and 0 where that is undefined."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def rank_band(value: Column) -> Column:
    """1 for 0-10, 2 for 11-30, 3 for 31-50, 4 for everything else and NULL."""
    bands = F
    for low, high, band in RANK_BANDS:
        bands = bands.when(value.between(low, high), F.lit(band))
    return bands.otherwise(F.lit(RANK_BAND_REST))


def flag_label(flag: Column, when_set: str = "F", otherwise: str = "M") -> Column:
    return F.when(flag, F.lit(when_set)).otherwise(F.lit(otherwise))


def by_position(position: Column, ranges: Sequence[tuple[int, int, str]]) -> Column:
    """The value of the inclusive range that holds the position, else NULL."""
    picked = F
    for low, high, value in ranges:
        picked = picked.when(position.between(low, high), F.lit(value))
    return picked


def columns_except_time(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if not isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))]


def age_in_days(birthday: Column, reference_date) -> Column:
    return F.datediff(F.lit(reference_date).cast("date"), birthday.cast("date"))


# Predicates

def contains_text(column: Column, text: str) -> Column:
    return column.contains(text)


def matches(column: Column, pattern: str) -> Column:
    return column.rlike(pattern)


def is_listed(column: Column, values: Sequence) -> Column:
    """Membership in a short list; a missing value is not a member."""
    return F.coalesce(column.isin(list(values)), F.lit(False))


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Remove the rows where the condition holds; unknown is kept."""
    return df.where(~F.coalesce(condition, F.lit(False)))


# Missing values

def _text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def decode_missing(df: DataFrame, spellings: Sequence[str] = MISSING_TEXT) -> DataFrame:
    """Every text column with the spellings of missing turned into NULL."""
    return df.withColumns({
        c: F.when(F.col(c).isin(*spellings), F.lit(None)).otherwise(F.col(c)) for c in _text_columns(df)})


def encode_missing(df: DataFrame, sentinel: str = SENTINEL) -> DataFrame:
    """Every column as text with NULL and NaN written as the sentinel."""
    def written(field):
        c = F.col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        return F.coalesce(c.cast("string"), F.lit(sentinel))

    return df.withColumns({f.name: written(f) for f in df.schema})


def blank_to_null(column: Column) -> Column:
    return F.nullif(column, F.lit(""))


def strip_pattern(column: Column, pattern: str, replacement: str = "") -> Column:
    return F.regexp_replace(column, pattern, replacement)


def map_values(column: Column, mapping: Mapping[str, str]) -> Column:
    """Values found in the mapping are replaced, others stay.

    Keys are compared trimmed and with the ampersand entity unescaped.
    """
    cleaned = F.trim(F.replace(column, F.lit("&amp;"), F.lit("&")))
    pairs = [F.lit(x) for key, value in mapping.items() for x in (key.strip().replace("&amp;", "&"), value)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), cleaned), column)
