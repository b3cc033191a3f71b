"""File readers and writers: payloads, delimited text, pages, typed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BAD = "_bad"


def read_payloads(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """One row per object of the ``drivers`` array of every payload below ``path``.

    Folders named ``series=..`` and ``season=..`` become columns; ``pos`` is the
    place of the object in its payload.
    """
    payload = T.StructType([T.StructField("drivers", T.ArrayType(schema))])
    raw = spark.read.schema(payload).option("multiLine", multi_line).json(path)
    partitions = [c for c in raw.columns if c != "drivers"]
    return raw.select(*partitions, F.posexplode("drivers").alias("pos", "d")).select(*partitions, "pos", "d.*")


def read_csv(spark: SparkSession, path: str, schema: T.StructType, index_column: str | None = None) -> DataFrame:
    """CSV with header; ``index_column`` names an unnamed leading column to drop."""
    if index_column is None:
        return spark.read.schema(schema).csv(path, header=True)
    full = T.StructType([T.StructField(index_column, T.StringType()), *schema.fields])
    return spark.read.schema(full).csv(path, header=True, enforceSchema=True).drop(index_column)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, inferSchema=True)


def load_checked(spark: SparkSession, path: str, schema: T.StructType, separator: str = ",",
                 header: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Good rows under the contract, and the others with their raw text in ``_bad``.

    Lines are parsed as a whole by ``from_csv``: a CSV scan would parse the
    columns a query reads only, and a line could be good for one query and bad
    for the next. ``header`` is the header line, if the files have one.
    """
    lines = spark.read.text(path)
    if header is not None:
        lines = lines.where(F.col("value") != header)
    full = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full)
    options = {"sep": separator, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}
    rows = lines.select(F.from_csv("value", ddl, options).alias("r")).select("r.*")
    return rows.where(F.col(BAD).isNull()).drop(BAD), rows.where(F.col(BAD).isNotNull())


def write_csv(df: DataFrame, path: str, header: bool = True) -> str:
    df.write.mode("overwrite").option("header", header).csv(path)
    return path


def write_counted(df: DataFrame, path: str) -> int:
    """Write a table and return its rows, counted by the write itself and not by another scan."""
    told = Observation()
    write_parquet(df.observe(told, F.count(F.lit(1)).alias("n_rows")), path)
    return told.get["n_rows"]


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> str:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages, one file per page, as (url, html)."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("url"), F.col("value").alias("html"))


def extract_csv(spark: SparkSession, sql: str, path: str, files: int | None = None) -> str:
    """Result of a query as CSV; ``files=1`` only for extracts one task can write."""
    result = spark.sql(sql)
    return write_csv(result if files is None else result.coalesce(files), path)
