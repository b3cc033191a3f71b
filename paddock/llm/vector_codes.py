"""Vector code compression: product codes found by an integer Walsh-Hadamard transform.

Components become integers, vectors are cut into parts, and every part is coded by the
nearest entry of its codebook. Parts and entries are padded with zeros to a power of two
and transformed by the Walsh-Hadamard matrix, rows in the order of their sign changes. The
matrix times its transpose is the length times the unit matrix, so the sum of the squared
differences of the transforms is the length times the squared distance, in integers and
without rounding. Sums grow coefficient by coefficient; an entry whose sum is beyond the
full sum of a known entry is dropped at once, and what is left at the end is exact.

A round sends the codebooks to the tasks (entries times components, however many vectors
there are); a task adds the parts it assigned up per entry, and Spark adds the tasks' sums
up. Nothing but codebooks and their sums reaches the driver.

Defined cases: a missing vector, and one with a missing or non-finite component or with a
scaled component of 2 ** 62 or more, is dropped; an empty vector is one of zeros, as parts
have the length that the longest vector asks for and shorter vectors are padded with zeros;
fewer vectors than entries give smaller codebooks; rows that share an id are coded one by
one, and where the start has to choose among them the smaller vector goes first; a missing
id goes last; labels that are missing are one label; an error beyond the range of a long is
missing; columns with other names are not looked at; no rows, no result.
"""

from __future__ import annotations

import copy
import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.session import checkpoint

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
# Vectors compared at once with all entries of a part, and the coefficients summed before entries are dropped.
ROWS, STEP = 512, 4
# Sums go on for all entries, in whole columns, until at most one in FEW of them is left.
FEW = 12
# Scaled components below this leave the sums of 64-bit integers exact for parts of up to 2 ** 10 components.
SMALL = 1 << 20
# Labels whose totals are sent to every task; totals of more labels are dealt over salts.
BROADCAST_LABELS, LABEL_SALTS = 100_000, 32
LARGEST = (1 << 63) - 1


def walsh(size: int) -> np.ndarray:
    """The Walsh-Hadamard matrix of a power of two, rows by their number of sign changes."""
    matrix = np.ones((1, 1), dtype=np.int64)
    while len(matrix) < size:
        matrix = np.block([[matrix, matrix], [matrix, -matrix]])
    return matrix[np.argsort((np.diff(matrix, axis=1) != 0).sum(axis=1))]


def transform(parts: np.ndarray) -> np.ndarray:
    """Coefficients of the rows of ``parts``, padded with zeros to a power of two."""
    size = 1 << max(parts.shape[1] - 1, 0).bit_length()
    matrix = walsh(size)[:, :parts.shape[1]]
    return parts @ matrix.T.astype(parts.dtype)


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the nearest entry, squared distance) of every row; the first of equally near entries."""
    if not (_narrow(parts) and _narrow(entries)):
        parts, entries = parts.astype(object), entries.astype(object)
    x, c = transform(parts), transform(entries)
    place, far = np.empty(len(x), dtype=np.int64), np.empty(len(x), dtype=x.dtype)
    for at in range(0, len(x), ROWS):
        place[at:at + ROWS], far[at:at + ROWS] = _nearest(x[at:at + ROWS], c)
    return place, far // x.shape[1]


def _narrow(values: np.ndarray) -> bool:
    return values.dtype != object and values.shape[1] <= 1 << 10 and (not values.size or int(np.abs(values).max()) < SMALL)


def _nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    def whole(entries):
        gap = x - c[entries]
        return (gap * gap).sum(axis=1)

    every, size, done = np.arange(len(x)), x.shape[1], 0
    partial, gap = np.zeros((len(x), len(c)), dtype=x.dtype), np.empty((len(x), len(c)), dtype=x.dtype)
    bound = None
    while done < size:
        for k in range(done, min(done + STEP, size)):
            np.subtract.outer(x[:, k], c[:, k], out=gap)
            np.multiply(gap, gap, out=gap)
            np.add(partial, gap, out=partial)
        done += STEP
        # The entry that is nearest so far gives a bound for the full sum; no farther entry can win.
        here = whole(partial.argmin(axis=1))
        bound = here if bound is None else np.minimum(bound, here)
        alive = partial <= bound[:, None]
        if np.count_nonzero(alive) * FEW <= alive.size:
            break
    row, entry = np.nonzero(alive)
    held = partial[row, entry]
    for first in range(done, size, STEP):
        gap = x[row, first:first + STEP] - c[entry, first:first + STEP]
        held = held + (gap * gap).sum(axis=1)
        alive = held <= bound[row]
        row, entry, held = row[alive], entry[alive], held[alive]
    # Every row keeps its nearest entries at least, in ascending order.
    least = np.minimum.reduceat(held, np.searchsorted(row, every)) if len(row) else held
    best = np.flatnonzero(held == least[row])
    return entry[best[np.searchsorted(row[best], every)]], least


def integers(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vectors`` without those that cannot be coded, and with their scaled integer components in ``_x``."""
    finite = F.forall(vector, lambda v: v.isNotNull() & (F.abs(v.cast("double") * SCALE) < float(1 << 62)))
    return vectors.where(F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False))).withColumn(
        "_x", F.transform(vector, lambda v: F.floor(v.cast("double") * SCALE)))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """The lists of an Arrow column as rows, padded with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


class Codebooks:
    """The entries of all parts, as integers; small however many vectors there are."""

    def __init__(self, first: np.ndarray, parts: int):
        self.entries = [np.array(e) for e in np.split(first, parts, axis=1)]

    def assign(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, squared distances), one column per part."""
        found = [nearest(x, e) for x, e in zip(np.split(rows, len(self.entries), axis=1), self.entries)]
        return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)

    def digest(self) -> str:
        written = ",".join(str(int(v)) for entries in self.entries for v in entries.reshape(-1))
        return hashlib.sha256(written.encode()).hexdigest()


def _refined(coded: DataFrame, books: Codebooks, width: int) -> Codebooks:
    """The codebooks after one round: every used entry is the mean of its parts, rounded down."""
    parts, length = len(books.entries), width // len(books.entries)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], list] = {}
        for batch in batches:
            rows = _matrix(batch.column(0), width)
            codes, _ = books.assign(rows)
            for part in range(parts):
                block = rows[:, part * length:(part + 1) * length]
                if not _narrow(block):
                    block = block.astype(object)
                order = np.argsort(codes[:, part], kind="stable")
                used, start = np.unique(codes[order, part], return_index=True)
                added = np.add.reduceat(block[order], start, axis=0) if length else np.zeros((len(used), 0), dtype=np.int64)
                for entry, n, values in zip(used.tolist(), np.diff(np.append(start, len(order))).tolist(), added.tolist()):
                    old = total.get((part, entry))
                    total[part, entry] = [n, *values] if old is None else [a + b for a, b in zip(old, [n, *values])]
        if total:
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([p for p, _ in total], pa.int32()), "entry": pa.array([e for _, e in total], pa.int32()),
                "sums": pa.array([[Decimal(v) for v in s] for s in total.values()], pa.list_(pa.decimal128(38, 0)))})

    told = coded.select("_x").mapInArrow(sums, "part int, entry int, sums array<decimal(38,0)>")
    added = told.select("part", "entry", F.posexplode("sums").alias("at", "value")).groupBy("part", "entry", "at").agg(
        F.sum("value").cast("string").alias("value"))
    # One list of integers per entry: the codebooks once more, and their counts.
    whole = added.groupBy("part", "entry").agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("sums"))
    fresh = copy.deepcopy(books)
    for row in whole.collect():
        n, *values = [int(s["value"]) for s in row["sums"]]
        fresh.entries[row["part"]][row["entry"]] = [v // n for v in values]
    return fresh


def compress(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks | None]:
    """((vec_id, label, codes, error) of every vector that can be coded, codebooks); no codebooks without rows."""
    if not 1 <= entries <= 256:
        raise ValueError("a code is one byte, so a codebook has 1 to 256 entries")
    kept = integers(vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("embedding")))
    coded = checkpoint(kept.select("vec_id", "label", "_x"))
    longest = coded.agg(F.max(F.size("_x"))).first()[0]
    if longest is None:
        return coded.select("vec_id", "label", F.array().cast("array<int>").alias("codes"), F.lit(None).cast("long").alias("error")), None
    width = -(-longest // parts) * parts
    first = coded.orderBy(F.col("vec_id").asc_nulls_last(), "_x").limit(entries).select("_x").collect()
    books = Codebooks(np.array([list(r["_x"]) + [0] * (width - len(r["_x"])) for r in first], dtype=np.int64), parts)
    for _ in range(rounds):
        books = _refined(coded, books, width)

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, far = books.assign(_matrix(batch.column(2), width))
            error = [v if v <= LARGEST else None for v in map(int, far.astype(object).sum(axis=1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(codes.astype(np.int32).tolist(), pa.list_(pa.int32())), pa.array(error, pa.int64())],
                names=["vec_id", "label", "codes", "error"])

    kinds = {f.name: f.dataType.simpleString() for f in coded.schema}
    return coded.mapInArrow(final, f"vec_id {kinds['vec_id']}, label {kinds['label']}, codes array<int>, error long"), books


def code_hex():
    """The codes of a row as two hex digits each."""
    return F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``, the sum of the errors of all rows with the same label."""
    done = checkpoint(coded)
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    missing = F.max(F.col("error").isNull())
    told = done.groupBy("label").agg(F.when(~missing & (total <= LARGEST), total).cast("long").alias("label_error"))
    told = checkpoint(told.select(F.col("label").alias("_label"), "label_error"))
    if told.count() <= BROADCAST_LABELS:
        return done.join(F.broadcast(told), F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
    salted = told.withColumn("_of", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(LABEL_SALTS - 1).cast("long"))))
    dealt = done.withColumn("_salt", F.pmod(F.xxhash64("vec_id", "codes"), F.lit(LABEL_SALTS)))
    same = F.col("label").eqNullSafe(F.col("_label")) & (F.col("_salt") == F.col("_of"))
    return dealt.join(salted, same).drop("_label", "_salt", "_of")
