"""User functions: vectorised scalars, aggregates, grouped maps and table functions.

These are the Python forms the engine offers for logic the built-in functions do
not have. Groups handed to pandas are bounded: rows are cut into pieces or
aggregated first. Types are objects, since text types would need a session at import.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PIECE_ROWS = 50_000


@F.pandas_udf(T.StructType().add("first", T.StringType()).add("rest", T.StringType()))
def split_name(names: pd.Series) -> pd.DataFrame:
    """Series to frame: text before and after the first '#'."""
    parts = names.str.partition("#")
    return pd.DataFrame({"first": parts[0], "rest": parts[2]})


@F.pandas_udf(T.DoubleType())
def discounted(price: pd.Series, discount: pd.Series) -> pd.Series:
    """Series to series."""
    return price * (1 - discount)


@F.pandas_udf(T.DoubleType())
def first_number(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Iterator of series: the first number of a JSON text, by a reader made once per task."""
    number = re.compile(r"-?[0-9]+(?:[.][0-9]+)?")

    def read(text):
        found = None if text is None else number.search(text)
        return float(found[0]) if found else None

    for texts in batches:
        yield texts.map(read, na_action=None).astype("float64")


# Upper bounds of the price bands, lowest first.
BANDS = (1_000.0, 10_000.0, 30_000.0, 60_000.0)


@F.pandas_udf(T.LongType())
def net_band(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Iterator of several series: the band of a discounted price, counted from 0."""
    bounds = np.array(BANDS)
    for price, discount in batches:
        yield pd.Series(np.searchsorted(bounds, (price * (1 - discount)).round(2), side="right"))


@F.pandas_udf(T.DoubleType())
def root_mean_square(values: pd.Series) -> float:
    """Series to scalar, usable as an aggregate and over a window."""
    known = values.to_numpy(dtype="float64")
    known = known[~np.isnan(known)]
    return float(np.sqrt(np.dot(known, known) / len(known))) if len(known) else None


@F.pandas_udf(T.LongType())
def size_of(values: pd.Series) -> int:
    return int(values.count())


def rms_in_pieces(df: DataFrame, keys: list[str], value: str, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Root mean square per key; the pandas aggregate sees at most ``piece_rows`` rows at once."""
    piece = F.expr(f"monotonically_increasing_id() div {int(piece_rows)}")
    pieces = df.select(*keys, value, piece.alias("_piece")).groupBy(*keys, "_piece").agg(
        root_mean_square(value).alias("_rms"), size_of(value).alias("_n"))
    squares = F.sum(F.col("_rms") * F.col("_rms") * F.col("_n"))
    return pieces.groupBy(*keys).agg(F.sqrt(squares / F.sum("_n")).alias("rms"))


def running_share(order: str, value: str):
    """Grouped map: the share of the group's total reached by each row, in order."""
    def share(group: pd.DataFrame) -> pd.DataFrame:
        ordered = group.sort_values(order)
        reached = ordered[value].cumsum()
        ordered[value] = reached / reached.iloc[-1]
        return ordered
    return share


def instalments(amount: str, count: int):
    """Map over batches that turns a row into ``count`` rows with equal parts of its amount."""
    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in range(1, count + 1):
                yield batch.assign(**{"part": part, amount: batch[amount] / count})
    return spread


def backlog(by: str, time: str, came: str, went: str):
    """Cogrouped map: what has come in so far less what has gone out, at every time of either side."""
    def level(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        change = left.set_index(time)[came].sub(right.set_index(time)[went], fill_value=0).sort_index().astype("int64")
        names = left[by] if len(left) else right[by]
        return pd.DataFrame({by: names.iloc[0], time: change.index, "open": change.cumsum().to_numpy()})
    return level


def partial_sums(key: str, value: str):
    """First half of a custom average: (key, sum, count) per Arrow batch."""
    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch]).group_by(key).aggregate([(value, "sum"), (value, "count")])
            named = table.select([key, f"{value}_sum", f"{value}_count"]).rename_columns([key, "total", "n"])
            yield from named.to_batches()
    return reduce


def custom_average(df: DataFrame, key: str, value: str) -> DataFrame:
    """Average from a reduce step per batch, a merge and a finish."""
    kind = df.schema[key].dataType.simpleString()
    reduced = df.select(key, value).mapInArrow(partial_sums(key, value), f"{key} {kind}, total double, n long")
    merged = reduced.groupBy(key).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    return merged.select(key, (F.col("total") / F.col("n")).alias("average"))


@F.udf(T.IntegerType(), useArrow=True)
def text_length(text: str) -> int:
    return None if text is None else len(text)


@F.udf(T.BooleanType(), useArrow=True)
def is_round(value: float) -> bool:
    return value is not None and value == int(value)


@F.udtf(returnType=T.StructType().add("place", T.IntegerType()).add("word", T.StringType()))
class Words:
    """Table function: the words of a text with their place."""

    def eval(self, text: str):
        if text is not None:
            yield from enumerate(text.split(" "))
