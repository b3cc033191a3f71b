"""SimHash near-duplicates: fingerprints, tiled exact comparison, components.

A fingerprint has a bit set where over half of the hashes of all word shingles
have it set. Distinct fingerprints are laid out in tiles in the order of their
population counts: of the whole word first, then of its halves and quarters. Two
fingerprints differ in at least as many bits as their counts differ, so a pair of
tiles is skipped when the ranges of the counts are further apart than the radius,
and inside a pair of tiles so are blocks of ``BLOCK`` fingerprints, for which the
counts of halves, quarters and bytes are looked at too. What is left is compared
exactly, with exclusive or and bit counts on numpy arrays.

Copies share a fingerprint and are compared once. A compared pair of tiles gives
a forest, every fingerprint linked to the first of its local group, and never
all pairs of a group, so a large group of near copies stays linear. Components
come from joins and aggregates over those links. The comparison is exact and so
still grows with the square of the distinct fingerprints, times the share of the
blocks that cannot be skipped.

Defined cases: a missing text or one without words has fingerprint zero and is
linked like any other; repeated rows and rows that share an id are kept; a group
whose ids are all missing has a missing component; no rows, no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.llm.batches import small_batches
from paddock.operators.graph import connected_components
from paddock.operators.hot import null_safe_join
from paddock.session import checkpoint

SHINGLE, SEED, RADIUS = 4, 42, 4
# Fingerprints of one block of a tile, the unit that is skipped or compared.
BLOCK = 256
# Least and most fingerprints of a tile; between them a tile is a share of all.
TILE_MIN, TILE_MAX, TILE_SHARE = 4_096, 131_072, 32
# Shingles hashed before their bits are added up, which bounds the memory of a long text.
HASHES = 1 << 16

_BIT = np.arange(64, dtype=np.uint64)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of one UTF-8 text."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    stop = np.cumsum(size + 1) - 1
    start = stop - size
    width = min(shingle, len(words))
    start, stop = start[:len(words) - width + 1], stop[width - 1:]
    counts = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(start), HASHES):
        pairs = zip(start[at:at + HASHES].tolist(), stop[at:at + HASHES].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in pairs], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int((np.uint64(1) << _BIT[2 * counts > len(start)]).sum(dtype=np.uint64))


def with_fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, name: str = "_print") -> DataFrame:
    """``docs`` with the fingerprint of every whole text, as a signed long."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        found = [fingerprint(t.encode(), shingle) if t is not None else 0 for t in texts]
        return pd.Series(np.array(found, dtype=np.uint64).view(np.int64))

    return docs.withColumn(name, of(F.col(text).cast("string")))


def _lanes(values: np.ndarray) -> np.ndarray:
    """Population counts of the word, its halves, quarters and bytes: 15 columns."""
    byte = np.bitwise_count(values.view(np.uint8).reshape(-1, 8)).astype(np.int16)
    quarter = byte[:, 0::2] + byte[:, 1::2]
    half = quarter[:, 0::2] + quarter[:, 1::2]
    return np.concatenate([half.sum(axis=1, dtype=np.int16)[:, None], half, quarter, byte], axis=1)


# Columns of one level of the lanes; the gaps of a level add up to a lower bound of the distance.
_LEVELS = (slice(0, 1), slice(1, 3), slice(3, 7), slice(7, 15))


def _boxes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest lane counts of every block."""
    lanes, at = _lanes(values), np.arange(0, len(values), BLOCK)
    return np.minimum.reduceat(lanes, at, axis=0), np.maximum.reduceat(lanes, at, axis=0)


class _Groups:
    """Groups of the fingerprints of one pair of tiles."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, first: int, last: int) -> np.ndarray:
        root = self.parent[first:last]
        while True:
            further = self.parent[root]
            if np.array_equal(further, root):
                self.parent[first:last] = root
                return root
            root = further

    def _root(self, i: int) -> int:
        while self.parent[i] != i:
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self._root(i), self._root(j)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def tile_links(left: np.ndarray, right: np.ndarray, same: bool, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, first of its group) for the groups linked inside one pair of tiles."""
    values = left if same else np.concatenate([left, right])
    shift = 0 if same else len(left)
    groups = _Groups(len(values))
    (alo, ahi), (blo, bhi) = _boxes(left), _boxes(right)
    for s in range(len(alo)):
        gap = np.maximum(np.maximum(alo[s] - bhi, blo - ahi[s]), 0)
        near = np.ones(len(blo), dtype=bool)
        for level in _LEVELS:
            near &= gap[:, level].sum(axis=1) <= radius
        if same:
            near[:s] = False
        a0, a1 = s * BLOCK, min((s + 1) * BLOCK, len(left))
        rows = left[a0:a1, None]
        for t in np.flatnonzero(near).tolist():
            b0, b1 = t * BLOCK, min((t + 1) * BLOCK, len(right))
            hit = np.bitwise_count(rows ^ right[None, b0:b1]) <= radius
            if hit.any():
                _merge(groups, hit, a0, a1, b0 + shift, b1 + shift)
    root = groups.roots(0, len(values))
    linked = np.flatnonzero(root != np.arange(len(values)))
    return values[linked], values[root[linked]]


def _merge(groups: _Groups, hit: np.ndarray, a0: int, a1: int, b0: int, b1: int) -> None:
    """Join what ``hit`` links; every pass takes one link per row that joins two groups."""
    while True:
        apart = hit & (groups.roots(a0, a1)[:, None] != groups.roots(b0, b1)[None, :])
        rows = np.flatnonzero(apart.any(axis=1))
        if not len(rows):
            return
        for i, j in zip(rows.tolist(), apart[rows].argmax(axis=1).tolist()):
            groups.join(a0 + i, b0 + j)


def _tiles(prints: DataFrame, size: int) -> DataFrame:
    """(tile, fingerprints, lo, hi): runs of at most ``size`` fingerprints in the order of their counts."""
    bits, lower, left, right = F.col("_print"), 0xFFFFFFFF, 0xFFFF, 0xFFFF00000000
    order = [F.bit_count(bits), F.bit_count(bits.bitwiseAND(F.lit(lower))), F.bit_count(bits.bitwiseAND(F.lit(left))),
             F.bit_count(bits.bitwiseAND(F.lit(right))), bits]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        rows = 0
        for batch in batches:
            held.append(batch["_print"].to_numpy(dtype=np.int64).view(np.uint64))
            rows += len(batch)
            while rows >= size:
                whole = np.concatenate(held)
                yield _tile(whole[:size])
                held, rows = [whole[size:]], rows - size
        if rows:
            yield _tile(np.concatenate(held))

    cutting = prints.select("_print").repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(
        cut, "prints binary, lo int, hi int")
    return checkpoint(cutting.withColumn("tile", F.monotonically_increasing_id()))


def _tile(values: np.ndarray) -> pd.DataFrame:
    ones = np.bitwise_count(values)
    return pd.DataFrame({"prints": [values.tobytes()], "lo": [int(ones.min())], "hi": [int(ones.max())]})


def link_prints(prints: DataFrame, radius: int = RADIUS, tile: int | None = None) -> DataFrame:
    """(src, dst) over distinct ``_print`` values: forests that connect all pairs within the radius."""
    small_batches(prints.sparkSession)
    size = tile or min(max(prints.count() // TILE_SHARE, TILE_MIN), TILE_MAX)
    tiles = _tiles(prints, size)
    one = tiles.select(F.col("tile").alias("i"), F.explode(F.sequence("lo", "hi")).alias("ones"))
    two = tiles.select(F.col("tile").alias("j"), F.explode(F.sequence(F.col("lo") - radius, F.col("hi") + radius)).alias("ones"))
    pairs = one.join(two, "ones").where("i <= j").select("i", "j").distinct()
    # Every other pair is turned round, so no tile stands on one side of all its pairs.
    odd = F.pmod(F.xxhash64("i", "j"), F.lit(2)) == 1
    pairs = pairs.select(F.when(odd, F.col("j")).otherwise(F.col("i")).alias("i"), F.when(odd, F.col("i")).otherwise(F.col("j")).alias("j"))
    full = pairs.join(tiles.select(F.col("tile").alias("i"), F.col("prints").alias("a")), "i").join(
        tiles.select(F.col("tile").alias("j"), F.col("prints").alias("b")), "j")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i, j, a, b in zip(batch["i"], batch["j"], batch["a"], batch["b"]):
                src, dst = tile_links(np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64), i == j, radius)
                yield pd.DataFrame({"src": src.view(np.int64), "dst": dst.view(np.int64)})

    return full.mapInPandas(compare, "src long, dst long")


def _printed(docs: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    return checkpoint(with_fingerprints(docs.select(doc_id, text), text, shingle).select(doc_id, "_print"))


def _rooted(printed: DataFrame, doc_id: str, radius: int) -> DataFrame:
    """(_print, _first, _root) per distinct fingerprint: its smallest id, and the fingerprint that names its component."""
    prints = checkpoint(printed.groupBy("_print").agg(F.min(doc_id).alias("_first")))
    linked = connected_components(link_prints(prints, radius))
    return prints.join(linked, prints["_print"] == linked["id"], "left").select(
        "_print", "_first", F.coalesce("component", "_print").alias("_root"))


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
               radius: int = RADIUS) -> DataFrame:
    """(doc_id, _print, component_id) per row; the component is the smallest id reachable."""
    printed = _printed(docs, doc_id, text, shingle)
    rooted = _rooted(printed, doc_id, radius)
    least = rooted.groupBy("_root").agg(F.min("_first").alias("component_id"))
    labels = rooted.select("_print", "_root").join(least, "_root").select("_print", "component_id")
    return printed.join(labels, "_print").select(doc_id, "_print", "component_id")


def print_hex(name: str = "_print"):
    return F.lower(F.lpad(F.hex(name), 16, "0"))


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                     radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of every component, that of its smallest id; other columns stay.

    A component is known by its root fingerprint and not by an id, so components
    without ids, or that share their smallest id, keep one row each.
    """
    rooted = _rooted(_printed(docs, doc_id, text, shingle), doc_id, radius)
    least = F.struct(F.col("_first").isNull().alias("missing"), F.col("_first").alias("first"), F.col("_print").alias("print"))
    kept = rooted.groupBy("_root").agg(F.min(least).alias("_least")).select(
        F.col("_least.first").alias(doc_id), F.col("_least.print").alias("_print"))
    printed = with_fingerprints(docs, text, shingle)
    chosen = null_safe_join(printed, kept, [doc_id, "_print"], "left_semi")
    return chosen.dropDuplicates([doc_id, "_print"]).select(*docs.columns)
