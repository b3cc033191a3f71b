"""Best-fit packing of token sequences.

Documents longer than a sequence are cut; the pieces are packed by best-fit
decreasing: the longest piece first, each into the open sequence with the least
room that still takes it, found in a segment tree over the remaining capacities.

Pieces of one length are alike, so the plan is made from the number of pieces of
each length, which is at most ``capacity`` numbers however large the corpus is.
It says which run of pieces goes to which run of sequences, and it is the same
packing that placing the pieces one by one gives. The pieces are then numbered in
the order of the plan by a distributed sort and look their place up by number. A
length that a third of all pieces share is split over as many sorted runs as it
needs; only the counts per length and per run reach the driver.

Defined cases: a missing or empty text is the end id alone; repeated rows are
packed one by one; a missing id is kept; no rows, no result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.llm.batches import small_batches
from paddock.llm.tokens import encoder
from paddock.session import checkpoint

CAPACITY = 2048
END_ID = 0
# Entries the encoder remembers: few, as the workers of a pipeline keep them beside the other stages' memory.
PIECES, PARTS = 150_000, 200_000


class Run(NamedTuple):
    """``count`` pieces from number ``rank`` on: ``per`` to each sequence from ``first`` on, the first at ``used``."""

    rank: int
    length: int
    first: int
    per: int
    used: int
    count: int


class Rooms:
    """A segment tree over remaining capacities: which of them have open sequences."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.held = [0] * (2 * self.size)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(self.size)]

    def add(self, room: int, run: tuple[int, int]) -> None:
        self.runs[room].append(run)
        self._change(room, 1)

    def take(self, room: int) -> tuple[int, int]:
        self._change(room, -1)
        return self.runs[room].pop()

    def _change(self, room: int, by: int) -> None:
        node = room + self.size
        while node:
            self.held[node] += by
            node //= 2

    def tightest(self, least: int) -> int | None:
        """The smallest room of at least ``least`` with an open sequence."""
        node = least + self.size
        if self.held[node]:
            return least
        while node > 1:
            if node % 2 == 0 and self.held[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.held[2 * node] else 2 * node + 1
                return node - self.size
            node //= 2
        return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Run], int]:
    """The runs of a best-fit decreasing packing of ``counts[length]`` pieces, and the number of sequences."""
    rooms, runs, opened, rank = Rooms(capacity), [], 0, 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = rooms.tightest(length)
            if room is None:
                room, per = capacity, capacity // length
                first, bins = opened, -(-left // per)
                opened += bins
            else:
                per = room // length
                first, bins = rooms.take(room)
                need = -(-left // per)
                if need < bins:
                    rooms.add(room, (first + need, bins - need))
                    bins = need
            # Once the tightest sequence has taken a piece it is tighter still, so it goes on until it is full.
            count = min(left, bins * per)
            runs.append(Run(rank, length, first, per, capacity - room, count))
            whole, rest = divmod(count, per)
            if whole:
                rooms.add(room - per * length, (first, whole))
            if rest:
                rooms.add(room - rest * length, (first + whole, 1))
            rank, left = rank + count, left - count
    return runs, opened


def pieces(docs: DataFrame, encode: Callable[[str], bytes], doc_id: str = "doc_id", text: str = "text",
           capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of the whole texts. ``encode`` gives packed 32-bit ids."""
    small_batches(docs.sparkSession)
    end = END_ID.to_bytes(4, "little")
    schema = pa.schema([("row", pa.int32()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, value in enumerate(batch.column(1)):
                ids = memoryview(encode(value.as_py() or "") + end)
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    out.append((row, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            cols = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(cols.column(0)), *cols.columns[1:]],
                                             names=[doc_id, *schema.names[1:]])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(doc_id, F.col(text).cast("string")).mapInArrow(
        cut, f"`{doc_id}` {kind}, piece int, start long, length long, ids_crc32 long")


def pack(items: DataFrame, order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``; ``length`` is 1 to ``capacity``, ``order`` settles equal lengths."""
    items = checkpoint(items)
    counts = {r["length"]: r["n"] for r in items.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return items.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    if min(counts) < 1 or max(counts) > capacity:
        raise ValueError(f"lengths must be 1 to {capacity}")
    runs, _ = plan(counts, capacity)
    by = [F.col("length").desc(), *order]
    numbered = checkpoint(items.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(
        "_row", F.monotonically_increasing_id()))
    # One count per sorted run.
    rows = numbered.groupBy(F.shiftright("_row", 33).alias("run")).agg(F.count(F.lit(1)).alias("n")).collect()
    before = np.zeros(max(r["run"] for r in rows) + 2, dtype=np.int64)
    for r in rows:
        before[r["run"] + 1] = r["n"]
    before = np.cumsum(before)
    shared = items.sparkSession.sparkContext.broadcast((before, np.array(runs, dtype=np.int64)))

    @F.pandas_udf("struct<sequence_id:long,offset:long>")
    def place(row: pd.Series) -> pd.DataFrame:
        bases, table = shared.value
        number = row.to_numpy()
        number = bases[number >> 33] + (number & ((1 << 33) - 1))
        run = table[np.searchsorted(table[:, 0], number, "right") - 1]
        within = number - run[:, 0]
        return pd.DataFrame({"sequence_id": run[:, 2] + within // run[:, 3],
                             "offset": run[:, 4] + within % run[:, 3] * run[:, 1]})

    return numbered.withColumn("_place", place("_row")).select(*items.columns, "_place.sequence_id", "_place.offset")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of all documents."""
    cut = pieces(docs, lambda text: encoder(tokenizer, PIECES, PARTS).ids(text), capacity=capacity)
    return pack(cut, ["doc_id", "piece", "ids_crc32"], capacity)
