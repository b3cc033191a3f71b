"""Graph jobs on edge frames (src, dst), one join and one aggregate per round.

Rounds are cut with checkpoints in the shared folder, so the plan stays short and
a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock.operators.hot import GROUP_ROWS
from paddock.operators.parts import FEW_ROWS, Parts, sent_if_few
from paddock.session import checkpoint, workspace, written

# Share of a rank passed along an edge, and the rest.
DAMPING = 0.85
BASE = 0.15
# Targets in one row of links.
ENDS = 1000
# Vertices that all tasks may know of, and the numbers that four bytes hold.
LAST_ROWS = 1_000_000
SHORT = 1 << 31


class _Links:
    """Distinct edges with the share of the source's rank each one carries.

    They are written once, as a table bucketed by source, so a round shuffles ranks
    and parts but no edges. A row holds up to about ``ENDS`` targets of a source, so
    a rank is looked up and shared out once for many edges. The edges of sources with more than ``group_rows`` of
    them, which one bucket would put into one task, are kept apart as they lie and
    meet the ranks of those few sources by a broadcast.
    """

    def __init__(self, edges: DataFrame, group_rows: int = GROUP_ROWS):
        self.spark = edges.sparkSession
        links = checkpoint(edges.select("src", "dst").distinct())
        degree = checkpoint(links.groupBy("src").agg(F.count(F.lit(1)).alias("n")))
        hubs = degree.where(F.col("n") > group_rows).select("src", (1.0 / F.col("n")).alias("share"))
        self.sources = degree.select(F.col("src").alias("id"))
        # At most one hub to every ``group_rows`` edges.
        self.hubs = None if hubs.isEmpty() else checkpoint(links.join(F.broadcast(hubs), "src"))
        self.hub_ids = hubs.select(F.col("src").alias("id"))
        parts, path = int(self.spark.conf.get("spark.sql.shuffle.partitions")), workspace(self.spark, "links")
        self.name = "links_" + path.rsplit("-", 1)[1]
        shares = degree.where(F.col("n") <= group_rows).select("src", (1.0 / F.col("n")).alias("share"), F.ceil(F.col("n") / ENDS).alias("pieces"))
        nth = F.when(F.col("dst").isNotNull(), F.pmod(F.xxhash64("dst"), F.col("pieces"))).alias("nth")
        # A missing target, one to a source at most, would be lost in a list.
        ends = F.when(F.col("nth").isNull(), F.array(F.lit(None).cast(links.schema["dst"].dataType))).otherwise(F.col("ends"))
        rows = links.join(shares, "src").repartition(parts, "src").groupBy("src", "share", nth).agg(F.collect_list("dst").alias("ends"))
        rows.select("src", "share", ends.alias("ends")).write.bucketBy(parts, "src").sortBy("src").option("path", path).saveAsTable(self.name)

    def carried(self, ranks: DataFrame, value: str, small: bool = False) -> DataFrame:
        """(id, part) along every edge: the share of ``value`` that its source sends."""
        def along(links, sent, end):
            return links.join(sent, links["src"] == sent["id"]).select(
                (F.col(value) * F.col("share")).alias("part"), end.alias("id")).select("id", "part")

        found = along(self.spark.table(self.name), F.broadcast(ranks) if small else ranks, F.explode("ends"))
        if self.hubs is None:
            return found
        return found.unionByName(along(self.hubs, F.broadcast(ranks.join(F.broadcast(self.hub_ids), "id", "left_semi")), F.col("dst")))

    def close(self, result: DataFrame) -> DataFrame:
        """``result``, written, and the table gone from the catalog."""
        done = checkpoint(result)
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        return done


def page_rank(edges: DataFrame, rounds: int, vertices: DataFrame | None = None, every: int = 3,
              group_rows: int = GROUP_ROWS) -> DataFrame:
    """(id, rank) after a fixed number of rounds, starting from 1.0.

    Without ``vertices`` a node nobody links to drops out after the first round;
    with them every vertex keeps at least the base rank.
    """
    links = _Links(edges, group_rows)
    nodes = links.sources if vertices is None else vertices.select("id")
    ranks = nodes.withColumn("rank", F.lit(1.0))
    for done in range(1, rounds + 1):
        sent = links.carried(ranks, "rank")
        if vertices is not None:
            sent = sent.unionByName(ranks.select("id", F.lit(0.0).alias("part")))
        ranks = sent.groupBy("id").agg((BASE + DAMPING * F.sum("part")).alias("rank"))
        if done % every == 0 and done < rounds:
            ranks = written(ranks)
    return links.close(ranks.select("id", "rank"))


def page_rank_until(edges: DataFrame, vertices: DataFrame, tolerance: float, max_rounds: int = 500, every: int = 4,
                    group_rows: int = GROUP_ROWS) -> DataFrame:
    """(id, rank), with no change above ``tolerance`` left to pass on.

    What is passed on is the change of a rank. While most ranks move, whole rounds
    are made, ``every`` of them at a time. Then a vertex keeps the changes that
    reach it and sends their sum when it is above the tolerance, so a round touches
    the vertices whose rank still moves, and their neighbours. Ranks and kept
    changes are parts to which every round adds what it has changed. Kept changes
    are part of the result.
    """
    links = _Links(edges, group_rows)
    now = vertices.select("id").distinct().withColumn("rank", F.lit(1.0))
    moves, done = F.abs("change") > tolerance, 0
    while True:
        for _ in range(every):
            sent = links.carried(now, "rank").select("id", "part", F.lit(None).cast("double").alias("old")).unionByName(
                now.select("id", F.lit(0.0).alias("part"), F.col("rank").alias("old")))
            now = sent.groupBy("id").agg((BASE + DAMPING * F.sum("part")).alias("rank"), F.max("old").alias("old")).where("old IS NOT NULL")
        now, done = written(now.withColumn("change", F.col("rank") - F.col("old"))), done + every
        seen = now.agg(F.count(F.lit(1)).alias("n"), F.count_if(moves).alias("senders")).first()
        if not seen["senders"]:
            return links.close(now.select("id", "rank"))
        if seen["senders"] * 2 <= seen["n"]:
            break
        if done >= max_rounds:
            raise RuntimeError(f"{seen['senders']} ranks still move after {done} rounds")

    def summed(df):
        return df.groupBy("id").agg(F.sum("change").alias("change"))

    ranks = Parts(summed, now.select("id", F.col("old").alias("change")))
    kept = Parts(lambda df: summed(df).where("change <> 0"), now.where(~moves).select("id", "change"))
    active, senders = now.where(moves).select("id", "change"), seen["senders"]
    for _ in range(done, max_rounds):
        ranks.add(active)
        got = written(links.carried(active, "change", senders <= FEW_ROWS).groupBy("id").agg(
            (DAMPING * F.sum("part")).alias("change")))
        # An edge may lead out of the given vertices; what it carries is lost, as in a whole round.
        told, _ = sent_if_few(got.select("id"))
        before = kept.union().unionByName(now.select("id", F.lit(0.0).alias("change"))).join(told, "id", "left_semi").select(
            "id", F.col("change").alias("old"), F.lit(0.0).alias("change"), F.lit(1).alias("known"))
        here = before.unionByName(got.select("id", F.lit(0.0).alias("old"), "change", F.lit(0).alias("known"))).groupBy("id").agg(
            F.sum("old").alias("old"), F.sum("change").alias("new"), F.max("known").alias("known")).where("known = 1")
        here = written(here.select("id", "old", (F.col("old") + F.col("new")).alias("change")))
        active = here.where(moves).select("id", "change")
        kept.add(here.select("id", F.when(moves, -F.col("old")).otherwise(F.col("change") - F.col("old")).alias("change")))
        senders = active.count()
        if not senders:
            total = ranks.union().unionByName(kept.union()).groupBy("id").agg(F.sum("change").alias("rank"))
            return links.close(total)
    raise RuntimeError(f"{senders} ranks still move after {max_rounds} rounds")


def connected_components(edges: DataFrame, vertices: DataFrame | None = None) -> DataFrame:
    """(id, component) with the smallest vertex id of the component.

    Alternating stars: first every vertex links its larger neighbours to the
    smallest vertex around it, then its smaller ones. Components turn into stars
    around their smallest vertex in a number of rounds that grows with the
    logarithm of the vertices, also for long chains. Edges are never multiplied.
    """
    low, high = F.least("src", "dst"), F.greatest("src", "dst")
    links = checkpoint(edges.where("src <> dst").select(low.alias("low"), high.alias("high")).distinct())
    before, now = None, _edge_sum(links)
    while now != before and now[0]:
        links = checkpoint(_small_star(_large_star(links)))
        before, now = now, _edge_sum(links)
    members = links.select(F.col("high").alias("id"), F.col("low").alias("component"))
    nodes = members.select(F.col("component").alias("id"))
    if vertices is not None:
        nodes = nodes.unionByName(vertices.select("id")).join(members, "id", "left_anti")
    return members.unionByName(nodes.distinct().withColumn("component", F.col("id")))


def _large_star(links):
    """Every larger neighbour of a vertex goes to the smallest vertex around it."""
    around = links.unionByName(links.select(F.col("high").alias("low"), F.col("low").alias("high")))
    least = around.groupBy("low").agg(F.least(F.min("high"), F.col("low")).alias("least"))
    return links.join(least, "low").select(F.col("least").alias("low"), "high").distinct()


def _small_star(links):
    """A vertex and its smaller neighbours go to the smallest of them."""
    least = links.groupBy("high").agg(F.min("low").alias("least"))
    moved = links.join(least, "high").where("low <> least").select(F.col("least").alias("low"), F.col("low").alias("high"))
    return moved.unionByName(least.select(F.col("least").alias("low"), "high")).distinct()


def _edge_sum(links):
    """Number and hash sum of the edges, to see whether a round has changed any."""
    row = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def triangle_counts(edges: DataFrame, vertices: DataFrame | None = None) -> DataFrame:
    """(id, triangles) for every vertex.

    Edges point from the lower to the higher degree, so no vertex has more than
    sqrt(2 * edges) outgoing edges, hubs included. Along every edge go the later
    neighbours of its source, as one list, and those its target points to as well
    close a triangle. Two edges from one vertex never become a row of their own.
    Nothing is sent to targets that point to none, if those are few enough to be
    known to all tasks, and ids that fit into four bytes are sent as such.
    """
    low, high = F.least("src", "dst"), F.greatest("src", "dst")
    links = written(edges.where("src <> dst").select(low.alias("a"), high.alias("b")).distinct())
    kind = links.schema["a"].dataType
    links = _short(links)
    ends = links.select(F.explode(F.array("a", "b")).alias("id"))
    degree = written(ends.groupBy("id").agg(F.count(F.lit(1)).alias("d")))
    ranked = links.join(degree.select(F.col("id").alias("a"), F.col("d").alias("da")), "a").join(
        degree.select(F.col("id").alias("b"), F.col("d").alias("db")), "b")
    one, other = F.struct(F.col("da").alias("d"), F.col("a").alias("id")), F.struct(F.col("db").alias("d"), F.col("b").alias("id"))
    directed = ranked.select(F.least(one, other).alias("s"), F.greatest(one, other).alias("t"))
    nearest = F.transform(F.sort_array(F.collect_list("t")), lambda e: e["id"])
    out = written(directed.groupBy(F.col("s.id").alias("s")).agg(nearest.alias("ends")))
    along = out.where(F.size("ends") > 1).select("s", "ends", F.posexplode("ends").alias("at", "a"))
    last = degree.join(out.select(F.col("s").alias("id")), "id", "left_anti").select(F.col("id").alias("a"))
    last, number = sent_if_few(written(last), LAST_ROWS)
    if number <= LAST_ROWS:
        along = along.join(last, "a", "left_anti")
    sent = along.where(F.col("at") + 1 < F.size("ends")).select("s", "a", F.expr("slice(ends, at + 2, size(ends) - at - 1)").alias("later"))
    closed = sent.join(out.select(F.col("s").alias("a"), "ends"), "a").select("s", "a", F.array_intersect("later", "ends").alias("third"))
    corner = F.struct(F.col("s").alias("id"), F.size("third").alias("n"))
    second = F.struct(F.col("a").alias("id"), F.size("third").alias("n"))
    thirds = F.transform("third", lambda b: F.struct(b.alias("id"), F.lit(1).alias("n")))
    found = closed.where(F.size("third") > 0).select(F.explode(F.concat(F.array(corner, second), thirds)).alias("c"))
    counts = found.groupBy(F.col("c.id").alias("id")).agg(F.sum("c.n").alias("triangles")).withColumn("id", F.col("id").cast(kind))
    nodes = degree.select(F.col("id").cast(kind)) if vertices is None else vertices.select("id")
    return nodes.join(counts, "id", "left").select("id", F.coalesce("triangles", F.lit(0)).cast("long").alias("triangles"))


def _short(links: DataFrame) -> DataFrame:
    """Links from ``a`` to a larger ``b``, with ids of four bytes if all of them fit."""
    if links.schema["a"].dataType != T.LongType() or links.schema["b"].dataType != T.LongType():
        return links
    row = links.agg(F.min("a").alias("low"), F.max("b").alias("high")).first()
    if row["low"] is None or row["low"] < -SHORT or row["high"] >= SHORT:
        return links
    return links.select(F.col("a").cast("int"), F.col("b").cast("int"))


def aggregate_neighbours(edges: DataFrame, vertices: DataFrame, value: str) -> DataFrame:
    """(id, n, total, mean) of the value over the sources whose value exceeds the target's."""
    sources = vertices.select(F.col("id").alias("src"), F.col(value).alias("from_value"))
    targets = vertices.select(F.col("id").alias("dst"), F.col(value).alias("to_value"))
    sent = edges.join(sources, "src").join(targets, "dst").where(F.col("from_value") > F.col("to_value"))
    return sent.groupBy(F.col("dst").alias("id")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("from_value").alias("total"), F.avg("from_value").alias("mean"))


def subgraph(edges: DataFrame, kept: DataFrame) -> DataFrame:
    """Edges with both ends among the kept vertices."""
    return edges.join(kept.select(F.col("id").alias("src")), "src", "left_semi").join(
        kept.select(F.col("id").alias("dst")), "dst", "left_semi").select("src", "dst")
