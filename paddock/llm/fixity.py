"""Fixity audit of archived records: hash trees over ordered offset ranges.

A replica is a set of records (file, offset, length, digest). The records of a
file are grouped into offset ranges of a fixed size; a range hashes the records
that begin in it, in the order of their offsets, and every ``FANOUT`` ranges hash
into one node above, up to one root per file. Two replicas are compared from the
roots downwards and only the children of differing nodes are looked at, so what
is joined shrinks to the damaged branches.

Range numbers follow from the offsets alone, so no file is numbered in one task:
a file that holds a third of all records spreads over its ranges, and no group
has more rows than a range has records or a node children.

Defined cases: a record missing on one side is damage of kind ``missing`` or
``extra``; a repeated (file, offset) counts as one record if its digest repeats
and as different otherwise; missing payloads hash as empty ones; two empty
replicas agree; columns beyond those named are ignored. Records without a file
are records of one more file, the missing one. Records of a file without an offset
are one range of it, without bounds, and are reported as one repeated record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.operators.hot import null_safe_join
from paddock.session import checkpoint

# Bytes of one leaf range, and children of one node.
RANGE_BYTES = 1 << 18
FANOUT = 16


def record_bytes(url, body):
    """One archive record: a header of fixed lines, the payload, and the two line ends after it."""
    payload = F.encode(F.coalesce(body, F.lit("")), "UTF-8")
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Length: "), F.length(payload).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(F.encode(head, "UTF-8"), payload, F.encode(F.lit("\r\n\r\n"), "UTF-8"))


def _said(value):
    """A value in what is hashed, where a missing one has a place of its own."""
    return F.coalesce(value.cast("string"), F.lit("~"))


def leaves(records: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(file, level 0, node, start, stop, n, digest) of every offset range with records."""
    one = records.select("file", "offset", "length", "digest").distinct()
    return one.groupBy("file", F.floor(F.col("offset") / range_bytes).alias("node")).agg(
        F.min("offset").alias("start"), F.max(F.col("offset") + F.col("length")).alias("stop"),
        F.count(F.lit(1)).alias("n"),
        F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("offset", "length", "digest"))),
                                        lambda r: F.concat_ws(":", _said(r["offset"]), _said(r["length"]), _said(r["digest"]))), "\n"), 256).alias("digest"),
    ).withColumn("level", F.lit(0))


def _above(nodes: DataFrame, level: int) -> DataFrame:
    return nodes.groupBy("file", F.floor(F.col("node") / FANOUT).alias("node")).agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.sum("n").alias("n"),
        F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("node", "digest"))),
                                        lambda c: F.concat_ws(":", _said(c["node"]), c["digest"])), "\n"), 256).alias("digest"),
    ).withColumn("level", F.lit(level))


def tree(records: DataFrame, range_bytes: int = RANGE_BYTES, levels: int | None = None) -> list[DataFrame]:
    """Node frames from the leaves up to one root per file.

    The levels follow from the largest range number; ``levels`` sets them, so
    that two replicas of different length have roots on the same level.
    """
    nodes = checkpoint(leaves(records, range_bytes))
    if levels is None:
        levels = depth(nodes)
    out = [nodes]
    for level in range(1, levels):
        out.append(checkpoint(_above(out[-1], level)))
    return out


def depth(nodes: DataFrame) -> int:
    """Levels needed until every file has one node."""
    top = nodes.agg(F.max("node")).first()[0] or 0
    levels = 1
    while top > 0:
        top //= FANOUT
        levels += 1
    return levels


def _differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """(file, node) whose digests differ or that only one side has."""
    sides = left.select("file", "node", F.col("digest").alias("a"), F.lit(None).cast("string").alias("b")).unionByName(
        right.select("file", "node", F.lit(None).cast("string").alias("a"), F.col("digest").alias("b")))
    # Grouping matches missing keys with each other, which a join by equality does not.
    both = sides.groupBy("file", "node").agg(F.max("a").alias("a"), F.max("b").alias("b"))
    return both.where(~F.col("a").eqNullSafe(F.col("b"))).select("file", "node")


def audit(left: DataFrame, right: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(file, offset, length, kind, range_start, range_stop) of every record the replicas disagree on.

    ``kind`` is ``changed``, ``missing`` (only on the left) or ``extra``.
    """
    first, second = checkpoint(leaves(left, range_bytes)), checkpoint(leaves(right, range_bytes))
    levels = max(depth(first), depth(second))
    one, two = [first], [second]
    for level in range(1, levels):
        one.append(checkpoint(_above(one[-1], level)))
        two.append(checkpoint(_above(two[-1], level)))
    bad = checkpoint(_differing(one[-1], two[-1]))
    for level in range(levels - 2, -1, -1):
        def below(nodes):
            parents = bad.withColumnRenamed("node", "parent")
            return null_safe_join(nodes.withColumn("parent", F.floor(F.col("node") / FANOUT)), parents, ["file", "parent"], "left_semi")

        bad = checkpoint(_differing(below(one[level]), below(two[level])))
    return _records(left, right, bad, range_bytes)


def _records(left, right, bad, range_bytes):
    def inside(records, side):
        one = records.select("file", "offset", "length", "digest").distinct()
        placed = one.withColumn("node", F.floor(F.col("offset") / range_bytes))
        return null_safe_join(placed, bad, ["file", "node"], "left_semi").withColumn("side", F.lit(side))

    def of(side):
        return F.array_sort(F.collect_set(F.when(F.col("side") == side, F.struct("length", "digest")))).alias(side)

    both = inside(left, "a").unionByName(inside(right, "b")).groupBy("file", "node", "offset").agg(of("a"), of("b"))
    differ = both.where(~F.col("a").eqNullSafe(F.col("b")))
    kind = F.when(F.size("b") == 0, "missing").when(F.size("a") == 0, "extra").otherwise("changed")
    length = F.when(F.size("a") > 0, F.get("a", F.lit(0))["length"]).otherwise(F.get("b", F.lit(0))["length"])
    return differ.select(
        "file", "offset", length.alias("length"), kind.alias("kind"),
        (F.col("node") * range_bytes).alias("range_start"), ((F.col("node") + 1) * range_bytes).alias("range_stop"))
