"""Benchmark decontamination over a positional inverted index.

The items of a benchmark are cut into windows of consecutive words. A first pass
over the corpus counts the terms that occur in windows; every window then names
its two rarest terms. A second pass stores the postings (document, term,
position) of those terms, which is the index. The postings of the rarest term,
moved back by its offset in the window, are the possible starts; they are
intersected with the postings of the next rarest term, moved back by its own
offset. What is left is compared word by word with the text, so terms may be
carried as 64-bit hashes without changing a result.

Which terms are counted and stored, and which texts have a candidate and are read
again, is told by bitmaps of ``BUCKETS`` bits, whose size does not depend on the
benchmark or the corpus; a bit that is set for nothing costs a row and changes no
result. The windows are broadcast to the postings only when a count shows at most
``BROADCAST_WINDOWS`` of them, and both are shuffled by term beyond that.

Between the passes a document is a 64-bit hash of its id and text. Documents that
share one share their candidates, and each is compared with its own text.

Defined cases: a missing text has no words, an item without words has no window;
rows of equal id and text get equal results, rows of equal id and other text
their own; a missing item id is written as an empty string; repeated items count
once; without items or documents the result has no hits or no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.llm.batches import small_batches
from paddock.llm.exprs import sha256_hex
from paddock.session import checkpoint

WINDOW = 10
# Bits of the bitmap of terms: half a megabyte.
BUCKETS = 1 << 22
# Windows of some 50 bytes each that may be broadcast.
BROADCAST_WINDOWS = 200_000
# Bytes of text whose words are hashed at once.
STEP = 1 << 20

_WORD = np.ones(256, dtype=bool)
_WORD[:0x80] = False
_WORD[[*b"0123456789", *b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", *b"abcdefghijklmnopqrstuvwxyz"]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xC2B2AE3D27D4EB4F)


def _places(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and byte after the last of every word; none crosses a bound."""
    inside = _WORD[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cut = bounds[(bounds > 0) & (bounds < len(data))]
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every lower-cased word: a polynomial of its bytes, mixed."""
    out = np.empty(len(start), dtype=np.uint64)
    at = 0
    while at < len(start):
        end = max(at + 1, int(np.searchsorted(stop, start[at] + STEP, "right")))
        begin, close = start[at:end] - start[at], int(stop[end - 1] - start[at])
        longest = int((stop[at:end] - start[at:end]).max())
        power = np.cumprod(np.full(longest + 1, _BASE, dtype=np.uint64), dtype=np.uint64)
        place = np.arange(close) - np.repeat(begin, np.diff(np.append(begin, close)))
        part = _LOWER[data[start[at]:stop[end - 1]]].astype(np.uint64)
        # Bytes after a word belong to no word and count as nothing.
        part[place >= np.repeat(stop[at:end] - start[at:end], np.diff(np.append(begin, close)))] = 0
        part *= power[np.minimum(place, longest)]
        out[at:end] = np.add.reduceat(part, begin)
        at = end
    out ^= out >> np.uint64(32)
    out *= _MIX
    out ^= out >> np.uint64(29)
    return out


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, position, hash) of every word of a column of texts."""
    data, bounds = _buffer(texts)
    start, stop = _places(data, bounds)
    row = np.searchsorted(bounds, start, "right") - 1
    first = np.searchsorted(start, bounds[:-1], "left")
    return row, np.arange(len(start)) - first[row], _hashes(data, start, stop)


def _buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = pa.concat_arrays([texts]) if texts.offset else texts
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.empty(0, dtype=np.uint8)
    base = int(offsets[0]) if len(offsets) else 0
    return data[base:int(offsets[-1])] if len(offsets) else data, offsets - base


def words(text: str) -> list[bytes]:
    """The lower-cased words of one text."""
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    low = _LOWER[data].tobytes()
    start, stop = _places(data, np.zeros(0, dtype=np.int64))
    return [low[a:b] for a, b in zip(start.tolist(), stop.tolist())]


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(42)).astype(np.int64)


def windows_of(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item_id, phrase, terms, n) of every window of every item."""
    small_batches(items.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            row, _, hashes = hashed_words(texts)
            for r, (item, text) in enumerate(zip(ids, texts.to_pylist())):
                found, terms = words(text or ""), hashes[row == r].view(np.int64).tolist()
                for at in range(0, len(found), STEP):
                    last = max(1, len(found) - size + 1) if found else 0
                    spans = [(k, min(size, len(found))) for k in range(at, min(at + STEP, last))]
                    yield pa.RecordBatch.from_pydict({
                        "item_id": [item] * len(spans),
                        "phrase": [b" ".join(found[k:k + n]).decode() for k, n in spans],
                        "terms": [terms[k:k + n] for k, n in spans],
                        "n": [n for _, n in spans],
                    }, schema=pa.schema([("item_id", pa.string()), ("phrase", pa.string()),
                                         ("terms", pa.list_(pa.int64())), ("n", pa.int32())]))

    named = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text").cast("string"))
    return named.mapInArrow(cut, "item_id string, phrase string, terms array<long>, n int")


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """Bits of the buckets of ``hash``. At most BUCKETS / 32768 rows of 4 KB come to the driver."""
    at = F.shiftrightunsigned("hash", 42) + 1
    rows = hashes.groupBy(F.bitmap_bucket_number(at).alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect()
    out = np.zeros(BUCKETS, dtype=bool)
    for r in rows:
        bits = np.unpackbits(np.frombuffer(bytes(r["bits"]), dtype=np.uint8), bitorder="little")
        out[(r["b"] - 1) * 32768:(r["b"] - 1) * 32768 + len(bits)] = bits.astype(bool)
    return out


def _counts(docs: DataFrame, known: np.ndarray) -> DataFrame:
    """(bucket, df_count) over the corpus: occurrences of the terms of the known buckets."""
    packed = docs.sparkSession.sparkContext.broadcast(np.packbits(known))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = np.unpackbits(packed.value).astype(bool)
        place = np.cumsum(here, dtype=np.int32) - 1
        found = np.zeros(int(here.sum()), dtype=np.int64)
        for batch in batches:
            at = _bucket(hashed_words(batch.column(0))[2])
            found += np.bincount(place[at[here[at]]], minlength=len(found))
        used = np.flatnonzero(found)
        yield pa.RecordBatch.from_pydict({"bucket": np.flatnonzero(here)[used], "seen": found[used]})

    return docs.select("text").mapInArrow(count, "bucket long, seen long").groupBy("bucket").agg(F.sum("seen").alias("seen"))


def anchors(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """``windows`` that may occur, with their two rarest terms (term, offset) and (term2, offset2)."""
    each = windows.select("wid", "n", F.posexplode("terms").alias("offset", "term")).withColumn(
        "bucket", F.shiftrightunsigned("term", 42))
    rated = each.join(counts, "bucket", "left").groupBy("wid", "n").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "offset", "term"))).alias("t"))
    # A term the corpus does not have rules its window out.
    return rated.where(F.col("t")[0]["seen"] > 0).select(
        "wid", "n", F.col("t")[0]["term"].alias("term"), F.col("t")[0]["offset"].alias("offset"),
        F.get("t", F.lit(1))["term"].alias("term2"), F.get("t", F.lit(1))["offset"].alias("offset2"))


def _index(docs: DataFrame, stored: np.ndarray) -> DataFrame:
    """(_hash, _key, n_words, terms, places) of every document: the postings of the stored buckets."""
    packed = docs.sparkSession.sparkContext.broadcast(np.packbits(stored))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = np.unpackbits(packed.value).astype(bool)
        for batch in batches:
            row, place, hashes = hashed_words(batch.column(2))
            total = np.bincount(row, minlength=batch.num_rows)
            kept = here[_bucket(hashes)]
            offsets = pa.array(np.append(0, np.cumsum(np.bincount(row[kept], minlength=batch.num_rows))), pa.int32())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(total, pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(hashes[kept].view(np.int64))),
                pa.ListArray.from_arrays(offsets, pa.array(place[kept], pa.int32())),
            ], names=["_hash", "_key", "n_words", "terms", "places"])

    return docs.select("_hash", "_key", "text").mapInArrow(
        post, "_hash long, _key string, n_words long, terms array<long>, places array<int>")


def _marked(docs: DataFrame, hashes: DataFrame) -> Column:
    """Whether the bit of a row's ``_hash`` is set by one of ``hashes``."""
    packed = docs.sparkSession.sparkContext.broadcast(np.packbits(_bitmap(hashes)))

    @F.pandas_udf("boolean")
    def of(column: pd.Series) -> pd.Series:
        at = _bucket(column.to_numpy(dtype=np.int64).view(np.uint64))
        return pd.Series((packed.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool))

    return of(F.col("_hash"))


def _candidates(index: DataFrame, chosen: DataFrame, slop: int) -> DataFrame:
    """(_hash, wid, start): adjusted postings of the rarest terms, intersected."""
    postings = index.where(F.size("terms") > 0).select(
        "_hash", "n_words", F.explode(F.arrays_zip("terms", "places")).alias("p")).select(
        "_hash", "n_words", F.col("p.terms").alias("term"), F.col("p.places").alias("place"))
    windows = F.broadcast(chosen) if chosen.count() <= BROADCAST_WINDOWS else chosen
    starts = postings.join(windows, "term").withColumn("start", F.col("place") - F.col("offset")).where(
        (F.col("start") >= -slop) & (F.col("start") + F.col("n") <= F.col("n_words") + slop))
    one = starts.where("term2 IS NULL").select("_hash", "wid", "start")
    two = starts.where("term2 IS NOT NULL").select("_hash", "wid", "start", "n", "term2", (F.col("start") + F.col("offset2")).alias("place2"))
    # Only terms that are the second of some window can be met.
    seconds = chosen.select("term2").where("term2 IS NOT NULL").distinct()
    if chosen.count() <= BROADCAST_WINDOWS:
        seconds = F.broadcast(seconds)
    next_term = postings.select("_hash", F.col("term").alias("term2"), F.col("place").alias("place2")).join(seconds, "term2", "left_semi")
    if slop:
        # Wherever the words may lie, and not only near the second term's own offset.
        next_term = next_term.withColumnRenamed("place2", "at")
        near = two.join(next_term, ["_hash", "term2"]).where(
            (F.col("at") >= F.col("start") - slop) & (F.col("at") < F.col("start") + F.col("n") + slop))
    else:
        near = two.join(next_term, ["_hash", "term2", "place2"], "left_semi")
    return one.unionByName(near.select("_hash", "wid", "start")).distinct()


def _key():
    """What stands for a document: its id and a hash of its text."""
    return F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("~")), F.lit(":"), F.hex(F.xxhash64(F.col("text").cast("string"))))


def _hash():
    return F.xxhash64("doc_id", F.col("text").cast("string"))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(_hash().alias("_hash"), _key().alias("_key"), F.col("text").cast("string").alias("text"))


def _found_in(text: str, wanted, slop: int) -> list[tuple[int, int, int, str]]:
    """(wid, start, stop, kind) of the candidates that hold; words are compared as such."""
    have, out = words(text), []
    for c in wanted:
        phrase = c["phrase"].encode().split(b" ")
        a, n = c["start"], len(phrase)
        if a >= 0 and have[a:a + n] == phrase:
            out.append((c["wid"], a, a + n, "phrase"))
        elif slop:
            lo, hi = max(0, a - slop), min(len(have), a + n + slop)
            if not Counter(phrase) - Counter(have[lo:hi]):
                out.append((c["wid"], lo, hi, "proximity"))
    return out


def matches(docs: DataFrame, items: DataFrame, size: int = WINDOW, slop: int = 0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, found, item windows).

    documents: (_key, n_words) per row of ``docs``. found: (_key, _hash, n_hit, spans)
    with the spans (wid, start, stop, kind) of a document: ``phrase`` where the
    words of a window follow each other, and with ``slop`` also ``proximity``
    where all of them lie within ``slop`` words around the place that the rarest
    one points to. Item windows: (item_id, wid).
    """
    small_batches(docs.sparkSession)
    cut = checkpoint(windows_of(items, size).distinct())
    windows = checkpoint(cut.groupBy("phrase").agg(F.first("terms").alias("terms"), F.first("n").alias("n"))
                         .withColumn("wid", F.monotonically_increasing_id()))
    owners = cut.join(windows.select("phrase", "wid"), "phrase").select("item_id", "wid").distinct()
    keyed = _keyed(docs)
    terms = windows.select(F.explode("terms").alias("hash"))
    chosen = checkpoint(anchors(windows, _counts(keyed, _bitmap(terms))))
    stored = _bitmap(chosen.select(F.explode(F.array_compact(F.array("term", "term2"))).alias("hash")))
    index = checkpoint(_index(keyed, stored))
    candidates = checkpoint(_candidates(index, chosen, slop))
    wanted = candidates.join(windows.select("wid", "phrase"), "wid").groupBy("_hash").agg(
        F.collect_list(F.struct("wid", "start", "phrase")).alias("wanted"))

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for digest, key, text, some in zip(batch["_hash"], batch["_key"], batch["text"], batch["wanted"]):
                held = _found_in(text, some, slop)
                hit = np.zeros(max((s[2] for s in held), default=0), dtype=bool)
                for _, a, b, _ in held:
                    hit[a:b] = True
                out.append((digest, key, int(hit.sum()), [dict(zip(("wid", "start", "stop", "kind"), s)) for s in held]))
            yield pd.DataFrame(out, columns=["_hash", "_key", "n_hit", "spans"])

    again = keyed.where(F.col("text").isNotNull()).where(_marked(docs, candidates.select(F.col("_hash").alias("hash"))))
    checked = again.join(wanted, "_hash").select("_hash", "_key", "text", "wanted").mapInPandas(
        verify, "_hash long, _key string, n_hit long, spans array<struct<wid:long,start:int,stop:int,kind:string>>")
    found = checkpoint(checked.where(F.size("spans") > 0).groupBy("_key").agg(
        F.first("_hash").alias("_hash"), F.first("n_hit").alias("n_hit"), F.first("spans").alias("spans")))
    return index.select("_key", "n_words"), found, owners


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) per row of ``docs``."""
    index, found, owners = matches(docs, items, size)
    named = found.select("_key", F.explode("spans").alias("s")).select("_key", F.col("s.wid").alias("wid")).distinct().join(
        owners, "wid").groupBy("_key").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    told = found.select("_key", "n_hit").join(named, "_key")
    joined = index.join(told, "_key", "left")
    items_col = F.coalesce("items", F.array().cast("array<string>"))
    doc_id = F.regexp_extract("_key", r"^(.*):[0-9A-F]+$", 1)
    kind = docs.schema["doc_id"].dataType
    return joined.select(
        F.when(doc_id != "~", doc_id).cast(kind).alias("doc_id"), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(items_col).cast("long").alias("n_items"), sha256_hex(F.array_join(items_col, ",")).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` without those in which a window of an item occurs; all columns stay."""
    _, found, _ = matches(docs, items, size)
    # The texts of marked rows alone are shuffled to be compared by key.
    hashed = docs.withColumns({"_hash": _hash(), "_key": _key()})
    doubtful = hashed.withColumn("_marked", _marked(docs, found.select(F.col("_hash").alias("hash"))))
    kept = doubtful.where("_marked").join(found.select("_key"), "_key", "left_anti")
    return doubtful.where(~F.col("_marked")).unionByName(kept).select(*docs.columns)
