"""Filter interaction audit: what each filter removes, alone and in every order.

Every document gets one failure bit per filter. The repeat filter is an existential
self-join: a left-semi join on the hash, the exact text and a smaller id marks the
repeats. Only texts whose hash occurs under different ids take part; their side of
smaller ids holds each distinct text once, with its smallest id, found with partial
sums in the map tasks. A hash that many rows share is dealt over salts by its counted
rows, and its few distinct texts are sent to every salt, so a group of copies of any
size spreads over as many tasks as it needs.

The ids of the repeats are united with the other failures, added up per document, and
from there on only combinations of bits are counted: at most 2 ** filters per part,
however many documents there are. What a filter removes at a step depends on the set of
filters before it and not on their order, so 2 ** (n - 1) sets per filter are summed
and every order looks its steps up.

Defined cases: a missing or empty text is empty, and a missing part is the empty string;
a row without an id is no repeat and makes none; rows that share an id are documents of
their own, and of equal rows neither is smaller; a document is good or toxic if any of its
label rows says so, and rows without an id have no labels; other columns are not looked at,
whatever their names; no rows, no result.
"""

from __future__ import annotations

from itertools import combinations, permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.llm.exprs import let, words_of
from paddock.session import checkpoint

# Rows of one hash that go to one salt.
SALT_ROWS = 4_096
# Hashes of small groups that are sent to every task, of some 30 bytes each; more of them are joined by a shuffle.
BROADCAST_HASHES = 500_000
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# The letters of the filters by bit, and the characters the fourth one looks for.
FILTERS = "ABCDE"
REPEAT = FILTERS.index("E")
SIGNS = "[#$%&*|]"


def failures(text: Column) -> Column:
    """The bits of the filters that look at one text only."""
    def judged(t):
        def counted(words):
            n, distinct = F.size(words), F.size(F.array_distinct(words))
            return F.when(n < 200, 1).otherwise(0) + F.when(100 * distinct.cast("long") < 50 * n.cast("long"), 2).otherwise(0)

        capitals = F.length(t) - F.length(F.translate(t, UPPER, ""))
        return (let(words_of(t), counted) + F.when(100 * capitals.cast("long") > 2 * F.length(t).cast("long"), 4).otherwise(0)
                + F.when(t.rlike(SIGNS), 8).otherwise(0))

    return let(text, judged)


def _alike(docs: DataFrame) -> DataFrame:
    """Rows whose hash occurs under different ids, with the smallest id of the hash and its number of salts."""
    counted = docs.where("id IS NOT NULL").groupBy("hash").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
    shared = checkpoint(counted.select("hash", "least", F.ceil(F.col("n") / SALT_ROWS).cast("int").alias("salts")))
    few = shared.where("salts = 1")
    # At most one large group to every SALT_ROWS rows; of the small ones only a counted number is sent around.
    some = F.broadcast(few) if few.count() <= BROADCAST_HASHES else few
    return docs.join(F.broadcast(shared.where("salts > 1")), "hash").unionByName(docs.join(some, "hash"))


def repeats(docs: DataFrame) -> DataFrame:
    """Rows of (id, hash, text, ...) whose text some row with a smaller id has too; rows without an id are left out."""
    alike = _alike(docs)
    later = alike.where("id > least").withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts")))
    first = alike.groupBy("hash", "text", "salts").agg(F.min("id").alias("first")).select(
        F.col("hash").alias("_hash"), F.col("text").alias("_text"), "first",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts").cast("long") - 1)).alias("_salt"))
    same = (F.col("hash") == F.col("_hash")) & (F.col("salt") == F.col("_salt")) & (F.col("text") == F.col("_text"))
    return later.join(first, same & (F.col("first") < F.col("id")), "left_semi")


def combinations_of(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    part: str = "source") -> DataFrame:
    """(part, bits, good, toxic, n): documents per part, combination of failures and labels."""
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    single = rows.select("id", "part", "hash", failures(F.col("text")).alias("bits"), F.lit(1).alias("n"))
    again = repeats(rows).select("id", "part", "hash", F.lit(1 << REPEAT).alias("bits"), F.lit(0).alias("n"))
    # Rows with one id, part and hash are told apart by their other bits, so a clash of hashes could only
    # pass a repeat on between rows that also share their id.
    marked = single.unionByName(again).groupBy("id", "part", "hash").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    return marked.join(known, "id", "left").groupBy(
        "part", "bits", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")).agg(
        F.sum("n").alias("n"))


def interactions(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from counted combinations."""
    bits = range(len(filters))
    places = [(one, sum(1 << b for b in before)) for one in bits
              for size in range(len(filters)) for before in combinations([b for b in bits if b != one], size)]
    each = F.explode(F.array(*[F.struct(F.lit(one).alias("filter"), F.lit(1 << one).alias("bit"), F.lit(before).alias("before"),
                                        F.lit(factorial(before.bit_count()) * factorial(len(filters) - 1 - before.bit_count()))
                                        .cast("long").alias("orders")) for one, before in places]))
    at = counts.select("part", "bits", "good", "toxic", "n", each.alias("p")).select("part", "bits", "good", "toxic", "n", "p.*")
    fails = F.col("bits").bitwiseAND(F.col("bit")) != 0
    gone = F.col("bits").bitwiseAND(F.col("before")) != 0

    def total(when: Column) -> Column:
        return F.sum(F.when(when, F.col("n")).otherwise(F.lit(0).cast("long")))

    sets = at.groupBy("part", "filter", "before", "orders").agg(
        total(~fails & ~gone).alias("kept"), total(fails & ~gone).alias("removed"), total(fails & gone).alias("redundant"),
        total(F.col("bits") == F.col("bit")).alias("unique_fails"), total(fails & ~gone & F.col("good")).alias("good_lost"),
        total(fails & ~gone & F.col("toxic")).alias("toxic_lost"))
    shares = sets.groupBy("part", "filter").agg(F.sum(F.col("removed") * F.col("orders")).alias("shapley"))
    # As many rows as there are orders and steps, whatever the input.
    steps = [("".join(filters[b] for b in order), step + 1, order[step], sum(1 << b for b in order[:step]))
             for order in permutations(bits) for step in bits]
    table = counts.sparkSession.createDataFrame(steps, "filter_order string, step int, filter int, before int")
    return sets.join(shares, ["part", "filter"]).join(F.broadcast(table), ["filter", "before"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The interactions of the five filters over whole ``docs``, per value of ``source``."""
    return interactions(combinations_of(docs, labels))
