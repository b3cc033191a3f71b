"""Token ids in files of bit planes.

The ids of a shard, documents in ascending order, are one stream that is cut into
blocks of ``BLOCK`` ids. A block is transposed into byte or bit planes, each
plane is compressed on its own, and planes of zeros are left out. Blocks are
written by Spark as rows of a shard table: place of the block in its shard, number
of ids, the documents that begin in it, and the block itself, a self-contained
binary. The row is the chunk index: a reader that wants ids from some place on
asks for those rows only, and the writer's commit makes a lost or repeated task
harmless on any store Spark can reach.

A shard is a range of document ids, so shards are as even as the ids; documents
and blocks go through a task one after the other, and a task holds one block and
one batch. First ids are per shard; the shards' own starts are a running sum over
one number per shard.

Block layout, little-endian: ``BPL1``, plane kind (0 byte, 1 bit), number of
planes, number of ids, then the compressed size of each plane, then the planes.

Defined cases: a missing or empty text is the end id alone; rows with one id are
ordered by text and keep their own entries; a missing id sorts first; no rows,
no shards and no result.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from paddock.llm.batches import small_batches

BLOCK = 65_536
END_ID = 0
LEVEL = 3
MAGIC = b"BPL1"
KINDS = ("byte", "bit")


def encode_block(ids: np.ndarray, planes: str = "byte", level: int = LEVEL) -> bytes:
    """The binary of one block of 32-bit ids."""
    byte = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    if planes == "byte":
        rows = list(byte)
    else:
        rows = [np.packbits(b >> bit & 1, bitorder="little") for b in byte for bit in range(8)]
    pack = zstandard.ZstdCompressor(level=level)
    parts = [pack.compress(r.tobytes()) if r.any() else b"" for r in rows]
    head = struct.pack("<4sBBI", MAGIC, KINDS.index(planes), len(parts), len(ids))
    return head + struct.pack(f"<{len(parts)}I", *map(len, parts)) + b"".join(parts)


def decode_block(block: bytes) -> np.ndarray:
    """The ids of one block, as little-endian 32-bit integers."""
    magic, kind, count, n = struct.unpack_from("<4sBBI", block)
    if magic != MAGIC:
        raise ValueError("not a block of planes")
    at = struct.calcsize("<4sBBI")
    sizes = struct.unpack_from(f"<{count}I", block, at)
    at += 4 * count
    byte = np.zeros((4, n), dtype=np.uint8)
    unpack = zstandard.ZstdDecompressor()
    for p, size in enumerate(sizes):
        if size:
            raw = np.frombuffer(unpack.decompress(block[at:at + size]), dtype=np.uint8)
            if KINDS[kind] == "byte":
                byte[p] = raw
            else:
                byte[p // 8] |= np.unpackbits(raw, count=n, bitorder="little") << (p % 8)
        at += size
    return np.ascontiguousarray(byte.T).view("<u4").reshape(-1)


def write_shards(docs: DataFrame, path: str, encode: Callable[[str], bytes], doc_id: str = "doc_id", text: str = "text",
                 planes: str = "byte", block: int = BLOCK) -> None:
    """Encode whole texts, end id added, and write the blocks of all shards below ``path``."""
    small_batches(docs.sparkSession)
    kind = docs.schema[doc_id].dataType
    arrow = pa.schema([
        ("shard", pa.int32()), ("chunk", pa.int64()), ("first", pa.int64()), ("n_ids", pa.int64()),
        ("docs", pa.list_(pa.struct([("doc_id", to_arrow_type(kind)), ("first", pa.int64()), ("n_ids", pa.int64())]))),
        ("block", pa.binary())])
    end = END_ID.to_bytes(4, "little")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        held, begun, chunk, first = bytearray(), [], 0, 0

        def rows(least: int) -> Iterator[pa.RecordBatch]:
            """Blocks out of what is held, while it has ``least`` bytes or more."""
            nonlocal begun, chunk, first
            at = 0
            while len(held) - at >= least and at < len(held):
                ids = np.frombuffer(bytes(held[at:at + 4 * block]), dtype="<u4")
                here = [d for d in begun if d["first"] < first + len(ids)]
                begun = begun[len(here):]
                yield pa.RecordBatch.from_pydict({
                    "shard": [shard], "chunk": [chunk], "first": [first], "n_ids": [len(ids)], "docs": [here],
                    "block": [encode_block(ids, planes)]}, schema=arrow)
                chunk, first, at = chunk + 1, first + len(ids), at + 4 * block
            del held[:at]

        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(value.as_py() or "") + end
                begun.append({"doc_id": name, "first": first + len(held) // 4, "n_ids": len(ids) // 4})
                held += ids
                yield from rows(4 * block)
        yield from rows(1)

    spark_type = kind.simpleString()
    laid = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).repartitionByRange(
        "doc_id").sortWithinPartitions("doc_id", "text")
    blocks = laid.mapInArrow(write, "shard int, chunk long, first long, n_ids long, "
                             f"docs array<struct<doc_id:{spark_type},first:long,n_ids:long>>, block binary")
    blocks.write.mode("overwrite").option("compression", "none").parquet(path)


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """(shard, base): the ids of all shards before it. One row per shard."""
    sizes = spark.read.parquet(path).groupBy("shard").agg(F.sum("n_ids").alias("n"))
    return sizes.select("shard", (F.sum("n").over(W.orderBy("shard")) - F.col("n")).alias("base"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the blocks."""
    small_batches(spark)
    stored = spark.read.parquet(path)
    kind = stored.schema["docs"].dataType.elementType["doc_id"].dataType
    arrow = pa.schema([("shard", pa.int32()), ("doc_id", to_arrow_type(kind)), ("first", pa.int64()), ("n_tokens", pa.int64()),
                       ("ids_crc32", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_doc, crc, left = None, 0, 0
        for batch in batches:
            out = []
            columns = (batch.column(batch.schema.get_field_index(n)) for n in ("shard", "docs", "block"))
            for shard, begun, block in zip(*columns):
                ids = decode_block(block.as_py())
                shard, at = shard.as_py(), 0
                todo = iter(begun.as_py())
                while at < len(ids):
                    if not left:
                        open_doc, crc = next(todo), 0
                        left = open_doc["n_ids"]
                    part = ids[at:at + left]
                    crc, at, left = zlib.crc32(part, crc), at + len(part), left - len(part)
                    if not left:
                        out.append((shard, open_doc["doc_id"], open_doc["first"], open_doc["n_ids"], crc))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), arrow.types)], schema=arrow)

    ordered = stored.select("shard", "chunk", "docs", "block").repartition("shard").sortWithinPartitions("shard", "chunk")
    found = ordered.mapInArrow(read, f"shard int, doc_id {kind.simpleString()}, first long, n_tokens long, ids_crc32 long")
    # One row per shard, as many as the writer had partitions.
    based = found.join(F.broadcast(shard_starts(spark, path)), "shard")
    return based.select("doc_id", (F.col("first") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")


def read_ids(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """(position, id) for the stream places from ``start`` to before ``stop``; only blocks that hold some are read."""
    small_batches(spark)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = decode_block(block)
                yield pa.RecordBatch.from_pydict({"position": np.arange(at, at + len(ids)), "id": ids.astype(np.int64)})

    stored = spark.read.parquet(path).join(F.broadcast(shard_starts(spark, path)), "shard").withColumn(
        "at", F.col("first") + F.col("base"))
    wanted = stored.where((F.col("at") < stop) & (F.col("at") + F.col("n_ids") > start))
    return wanted.select("at", "block").mapInArrow(read, "position long, id long").where(
        (F.col("position") >= start) & (F.col("position") < stop))
