"""Readers and writers: tables are landed in a format and read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock.operators.rows import union_by_name
from paddock.queries.registry import query
from paddock.session import workspace
from paddock.sources import files


# Buckets of the bucketed tables: at 100 TB set to the input size over some 128 MB.
BUCKETS = 16


def _space(t, name):
    return workspace(t.spark, name)


PAYLOAD = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("full_name", T.StringType()),
    T.StructField("points", T.DoubleType()), T.StructField("status", T.StringType())])


@query("s01_payload_scan", """
    SELECT lower(o_orderstatus) AS series, CAST(year(o_orderdate) AS INTEGER) AS season, 0 AS pos, o_custkey AS id,
      'Customer ' || o_custkey AS full_name, o_totalprice AS points, NULL::VARCHAR AS status FROM orders
    UNION ALL SELECT lower(o_orderstatus), CAST(year(o_orderdate) AS INTEGER), 1, o_orderkey, 'Order ' || o_orderkey, NULL,
      o_orderpriority FROM orders""")
def _(t):
    """Payloads with an array of two objects each, in folders per series and season."""
    text = F.lit(None).cast("string")
    one = F.struct(F.col("o_custkey").alias("id"), F.concat(F.lit("Customer "), F.col("o_custkey")).alias("full_name"),
                   F.col("o_totalprice").alias("points"), text.alias("status"))
    two = F.struct(F.col("o_orderkey").alias("id"), F.concat(F.lit("Order "), F.col("o_orderkey")).alias("full_name"),
                   F.lit(None).cast("double").alias("points"), F.col("o_orderpriority").alias("status"))
    payload = F.to_json(F.struct(F.array(one, two).alias("drivers")))
    path = _space(t, "payloads")
    landed = t.orders.select(payload.alias("value"), F.lower("o_orderstatus").alias("series"), F.year("o_orderdate").alias("season"))
    # Rebalance gathers each folder's rows and splits a folder that is too large.
    landed.hint("rebalance", "series", "season").write.partitionBy("series", "season").text(path)
    return files.read_payloads(t.spark, path, PAYLOAD, multi_line=False)


@query("s02_csv_index_column", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def _(t):
    path = files.write_csv(t.nation.select(F.col("n_nationkey").alias("_c0"), "n_nationkey", "n_name", "n_regionkey"), _space(t, "csv"))
    return files.read_csv(t.spark, path, t.nation.schema, index_column="_c0")


@query("s03_csv_inferred", """
    SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part""")
def _(t):
    return files.read_csv_inferred(t.spark, files.write_csv(t.part, _space(t, "csv")))


@query("s04_parquet_scan", "SELECT * FROM lineitem")
def _(t):
    return t.lineitem


@query("s05_page_scan", "SELECT page_id, url, length(html) AS n_chars FROM pages")
def _(t):
    return t.pages.select("page_id", "url", F.length("html").cast("long").alias("n_chars"))


@query("s06_zipped_lists", """
    WITH w AS (SELECT conv_id, turn, string_split(text, ' ') AS a FROM conversations)
    SELECT conv_id, turn, i - 1 AS pos, a[i] AS name, length(a[i]) AS size FROM w, LATERAL (SELECT unnest(range(1, len(a) + 1)) AS i)""")
def _(t):
    """Two parallel lists of a row become a table, position by position."""
    names = F.split("text", " ")
    sizes = F.transform(names, lambda x: F.length(x).cast("long"))
    zipped = F.arrays_zip(names.alias("name"), sizes.alias("size"))
    return t.conversations.select("conv_id", "turn", F.posexplode(zipped).alias("pos", "e")).select(
        "conv_id", "turn", F.col("pos").cast("long").alias("pos"), "e.name", "e.size")


@query("s07_parquet_sink", """
    SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS season FROM orders""")
def _(t):
    """Written by season and read back, all seasons."""
    facts = t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("season"))
    path = files.write_parquet(facts.hint("rebalance", "season"), _space(t, "facts"), ("season",))
    return t.spark.read.parquet(path)


@query("s07_one_season", """
    SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS season FROM orders WHERE year(o_orderdate) = 1997""")
def _(t):
    """One season of the same sink; the folders of the others are not opened."""
    facts = t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("season"))
    path = files.write_parquet(facts.hint("rebalance", "season"), _space(t, "facts"), ("season",))
    return t.spark.read.parquet(path).where("season = 1997")


@query("s08_csv_sink", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def _(t):
    return files.read_csv(t.spark, files.write_csv(t.supplier, _space(t, "csv")), t.supplier.schema)


@query("s10_query_extract", "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal > 0")
def _(t):
    t.customer.createOrReplaceTempView("extract_source")
    path = files.extract_csv(t.spark, "SELECT c_custkey, c_name, c_acctbal FROM extract_source WHERE c_acctbal > 0", _space(t, "extract"))
    return files.read_csv(t.spark, path, T.StructType.fromDDL("c_custkey bigint, c_name string, c_acctbal double"))


@query("s11_bulk_load", """
    SELECT 'good' AS state, p_partkey, p_size, NULL::VARCHAR AS line FROM part WHERE p_partkey % 10 <> 3
    UNION ALL SELECT 'bad', p_partkey, NULL, p_partkey || ',' || p_brand || ',many' FROM part WHERE p_partkey % 10 = 3""")
def _(t):
    """Delimited text under a contract; lines that break it are kept apart as text."""
    size = F.when(F.col("p_partkey") % 10 == 3, F.lit("many")).otherwise(F.col("p_size").cast("string"))
    path = _space(t, "lines")
    t.part.select(F.concat_ws(",", F.col("p_partkey").cast("string"), "p_brand", size).alias("value")).write.text(path)
    good, bad = files.load_checked(t.spark, path, T.StructType.fromDDL("p_partkey bigint, p_brand string, p_size int"))
    return union_by_name([
        good.select(F.lit("good").alias("state"), "p_partkey", "p_size"),
        bad.select(F.lit("bad").alias("state"), "p_partkey", F.col(files.BAD).alias("line"))])


@query("e38_file_options", """
    SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal > 0 UNION ALL SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal <= 0""")
def _(t):
    """Nested folders, a name filter and a file that is no Parquet."""
    path = _space(t, "nested")
    rows = t.supplier.select("s_suppkey", "s_name", "s_acctbal")
    rows.where("s_acctbal > 0").drop("s_acctbal").write.parquet(f"{path}/a")
    rows.where("s_acctbal <= 0").drop("s_acctbal").write.parquet(f"{path}/a/b")
    rows.select("s_name").write.text(f"{path}/a/c")
    reader = t.spark.read.schema("s_suppkey bigint, s_name string")
    return reader.parquet(path, recursiveFileLookup=True, pathGlobFilter="*.parquet", modifiedAfter="2000-01-01T00:00:00",
                          ignoreCorruptFiles=True)


@query("e38_corrupt_files", "SELECT n_nationkey, n_name FROM nation")
def _(t):
    """Files that cannot be read are skipped, the others come back whole."""
    path = _space(t, "corrupt")
    t.nation.select("n_nationkey", "n_name").write.parquet(f"{path}/good")
    t.region.select("r_name").write.text(f"{path}/bad")
    reader = t.spark.read.schema("n_nationkey int, n_name string").option("ignoreCorruptFiles", True)
    return reader.parquet(f"{path}/good", f"{path}/bad")


@query("e39_partitioned_bucketed", """
    SELECT o_orderkey, c_name, o_orderstatus FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'P'""")
def _(t):
    """Both sides bucketed by customer, so the join needs no shuffle."""
    tag = workspace(t.spark, "t").rsplit("-", 1)[1]
    orders, customers = f"orders_{tag}", f"customers_{tag}"
    # Rows are dealt like the buckets, so a bucket is written by one task and is one file per folder.
    (t.orders.select("o_orderkey", "o_custkey", "o_orderstatus").repartition(BUCKETS, "o_custkey").write.partitionBy("o_orderstatus")
     .bucketBy(BUCKETS, "o_custkey").sortBy("o_custkey").option("path", _space(t, "orders")).saveAsTable(orders))
    (t.customer.select("c_custkey", "c_name").repartition(BUCKETS, "c_custkey").write.bucketBy(BUCKETS, "c_custkey").sortBy("c_custkey")
     .option("path", _space(t, "customers")).saveAsTable(customers))
    left, right = t.spark.table(orders).where("o_orderstatus = 'P'"), t.spark.table(customers)
    return left.join(right, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name", "o_orderstatus")


@query("e39_orc_options", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'")
def _(t):
    path = _space(t, "orc")
    (t.customer.select("c_custkey", "c_mktsegment").write.option("orc.bloom.filter.columns", "c_mktsegment")
     .option("orc.dictionary.key.threshold", "1.0").orc(path))
    return t.spark.sql(f"SELECT * FROM orc.`{path}` WHERE c_mktsegment = 'BUILDING'")


@query("e40_schema_merge", """
    SELECT s_suppkey, s_name, NULL::DOUBLE AS s_acctbal, 'names' AS delivery FROM supplier
    UNION ALL SELECT s_suppkey, NULL, s_acctbal, 'balances' FROM supplier""")
def _(t):
    """Deliveries of one table with other columns, read as one."""
    path = _space(t, "deliveries")
    t.supplier.select("s_suppkey", "s_name").write.parquet(f"{path}/delivery=names")
    t.supplier.select("s_suppkey", "s_acctbal").write.parquet(f"{path}/delivery=balances")
    return t.spark.read.option("mergeSchema", True).parquet(path)


@query("e41_json_dataset", "SELECT event_id, event_type, value FROM events")
def _(t):
    path = _space(t, "json")
    t.events.select("event_id", "event_type", "value").write.option("compression", "gzip").json(path)
    return t.spark.read.schema("event_id bigint, event_type string, value double").json(path)


@query("e41_csv_options", "SELECT c_custkey, '\"' || c_name || '\"; ' || c_mktsegment AS note FROM customer")
def _(t):
    path = _space(t, "csv")
    note = F.concat(F.lit('"'), "c_name", F.lit('"; '), "c_mktsegment")
    t.customer.select("c_custkey", note.alias("note")).write.csv(path, sep=";", header=True, quoteAll=True, escape='"')
    return t.spark.read.schema("c_custkey bigint, note string").csv(path, sep=";", header=True, escape='"')


@query("e41_text_dataset", "SELECT c_name AS value FROM customer UNION ALL SELECT s_name FROM supplier")
def _(t):
    path = _space(t, "text")
    t.customer.select("c_name").write.option("lineSep", "|").option("compression", "gzip").text(f"{path}/a")
    t.supplier.select("s_name").write.option("lineSep", "|").text(f"{path}/b")
    return t.spark.read.option("lineSep", "|").text([f"{path}/a", f"{path}/b"])
