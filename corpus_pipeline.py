"""The corpus pipeline: documents through five of the training-data operators.

Every stage takes what the one before it kept, all of it, and its decisions take
effect: documents that fail a quality rule, all but one of every group of near
copies, and documents with a passage of a benchmark item go; secrets are masked in
place; what is left is packed into sequences. All stages but the last return the
columns of ``documents``. Each result is written and read again, so a lost
executor never costs more than the stage at hand.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.llm import decontaminate, packing, quality, secret_scan, simhash
from paddock.session import prepare, workspace

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
POLICY = quality.POLICIES["v1"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return quality.passing(docs, POLICY)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return simhash.drop_near_copies(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masked texts; ``n_chars`` follows a text that was changed."""
    prepare(spark)
    masked = secret_scan.redact(docs.withColumn("_before", F.col("text")))
    if "n_chars" in docs.columns:
        changed = F.col("text") != F.col("_before")
        masked = masked.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return masked.drop("_before")


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack_documents(docs, TOKENIZER)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("benchmark_passages", benchmark_passages),
    ("secrets", secrets),
    ("sequences", sequences),
]

# Fingerprints and token ids cannot be said in SQL; the tests hold the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the kept documents with their sequences and places."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = workspace(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
