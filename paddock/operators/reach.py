"""Reachability and distances on edge frames: shortest paths, strong components, transitive closure.

Vertices with one edge in and one edge out only pass on. Stretches of them are
shortened by pointer doubling first, in a number of rounds that grows with the
logarithm of their length, so long chains and rings cost no more rounds than
short ones. All loops write what a round has changed, as parts that are merged
now and then.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import inf, nextafter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.operators.parts import Parts, sent_if_few
from paddock.session import written


@dataclass
class Stretches:
    """Passing vertices as (id, up, down, far, low) and the edges that are left with a weight.

    ``up`` and ``down`` are the nearest vertices that are no passing ones, ``far``
    the distance from ``up``. A ring of passing vertices alone has no such
    vertices: its rows are in ``rings``, with the smallest id ``low`` of the ring.
    """

    passing: DataFrame
    rings: DataFrame
    links: DataFrame


def shorten(links: DataFrame, keep: DataFrame | None = None) -> Stretches:
    """Shorten the stretches of (src, dst, weight), one row per pair; vertices of ``keep`` (id) stay."""
    ends = links.select(F.col("src").alias("id"), F.lit(1).alias("o"), F.lit(0).alias("i")).unionByName(
        links.select(F.col("dst").alias("id"), F.lit(0).alias("o"), F.lit(1).alias("i")))
    inner = ends.groupBy("id").agg(F.sum("o").alias("o"), F.sum("i").alias("i")).where("o = 1 AND i = 1").select("id")
    if keep is not None:
        inner = inner.join(keep, "id", "left_anti")
    into = links.where("src <> dst").select(F.col("dst").alias("id"), F.col("src").alias("up"), F.col("weight").alias("far"))
    out = links.where("src <> dst").select(F.col("src").alias("id"), F.col("dst").alias("down"))
    inner = written(inner.join(into, "id").join(out, "id").withColumn("low", F.col("id")))
    rows, passing = inner.count(), inner
    if not rows:
        return Stretches(inner, inner, links)
    for _ in range(rows.bit_length() + 1):
        above = passing.select(F.col("id").alias("up"), F.col("up").alias("up2"), F.col("far").alias("far2"), F.col("low").alias("low2"))
        below = passing.select(F.col("id").alias("down"), F.col("down").alias("down2"))
        longer = passing.join(above, "up", "left").join(below, "down", "left")
        longer = written(longer.select(
            "id", F.coalesce("up2", "up").alias("up"), F.coalesce("down2", "down").alias("down"),
            (F.col("far") + F.coalesce("far2", F.lit(0.0))).alias("far"), F.least("low", F.coalesce("low2", "low")).alias("low"),
            F.col("up2").isNotNull().alias("moved")))
        passing = longer.drop("moved")
        if longer.where("moved").isEmpty():
            break
    mark = inner.select(F.col("id").alias("up"))
    rings, passing = passing.join(mark, "up", "left_semi"), passing.join(mark, "up", "left_anti")
    # The last vertex of a stretch gives the edge that stands for all of it.
    last = inner.select("id", "down").join(inner.select(F.col("id").alias("down")), "down", "left_anti")
    ending = last.join(links.select(F.col("src").alias("id"), F.col("dst").alias("down"), "weight"), ["id", "down"])
    whole = passing.select("id", "up", "far").join(ending, "id").select(
        F.col("up").alias("src"), F.col("down").alias("dst"), (F.col("far") + F.col("weight")).alias("weight"))
    ids = inner.select("id")
    rest = links.join(ids.withColumnRenamed("id", "src"), "src", "left_anti").join(ids.withColumnRenamed("id", "dst"), "dst", "left_anti")
    left = rest.select("src", "dst", "weight").unionByName(whole).groupBy("src", "dst").agg(F.min("weight").alias("weight"))
    return Stretches(written(passing), written(rings), written(left))


def shortest_paths(edges: DataFrame, source: int, width: float | None = None) -> DataFrame:
    """(id, distance) of all vertices reachable from ``source`` over (src, dst, weight >= 0).

    Distances are settled in buckets of ``width``, the mean weight unless given.
    Inside a bucket only vertices that have just got nearer send along the edges
    up to that width; longer edges, which lead to later buckets, are followed once
    when the bucket is settled. Edges without a weight are left out.
    """
    links = written(edges.where("weight < double('infinity')").groupBy("src", "dst").agg(F.min(F.col("weight").cast("double")).alias("weight")))
    kind = links.schema["src"].dataType.simpleString()
    seen = links.agg(F.min("weight"), F.avg("weight")).first()
    if seen[0] is not None and seen[0] < 0:
        raise ValueError("weights must not be negative")
    width = width or seen[1] or 1.0
    origin = edges.sparkSession.range(1).select(F.lit(source).cast(kind).alias("id"), F.lit(0.0).alias("distance"))
    short = shorten(links, origin.select("id"))
    light, heavy = short.links.where(F.col("weight") <= width), short.links.where(F.col("weight") > width)

    def nearest(df):
        return df.groupBy("id").agg(F.min("distance").alias("distance"))

    found, waiting = Parts(nearest, origin), Parts(nearest, origin)

    def follow(now: DataFrame, along: DataFrame) -> DataFrame:
        """What gets nearer by the edges ``along`` from ``now``, written."""
        senders, _ = sent_if_few(now)
        offers = written(along.join(senders, along["src"] == senders["id"]).groupBy(F.col("dst").alias("id")).agg(
            F.min(F.col("distance") + F.col("weight")).alias("distance")))
        told, _ = sent_if_few(offers.select("id"))
        known = nearest(found.union().join(told, "id", "left_semi")).withColumnRenamed("distance", "old")
        fresh = written(offers.join(known, "id", "left").where("old IS NULL OR distance < old").select("id", "distance"))
        found.add(fresh)
        return fresh

    while True:
        least = waiting.union().agg(F.min("distance")).first()[0]
        if least is None:
            break
        limit = max((least // width + 1) * width, nextafter(least, inf))
        now = written(nearest(waiting.union().where(F.col("distance") < limit)))
        waiting = Parts(nearest, written(waiting.whole().where(F.col("distance") >= limit)))
        settled = Parts(nearest, now)
        while True:
            fresh = follow(now, light)
            now = fresh.where(F.col("distance") < limit)
            waiting.add(fresh.where(F.col("distance") >= limit))
            if now.isEmpty():
                break
            settled.add(now)
        waiting.add(follow(written(settled.whole()), heavy))
    whole = written(found.whole())
    along = short.passing.join(whole.withColumnRenamed("id", "up"), "up").select("id", (F.col("distance") + F.col("far")).alias("distance"))
    return whole.unionByName(along)


def strong_components(edges: DataFrame) -> DataFrame:
    """(id, component) of every vertex of (src, dst): the smallest id among those it reaches and is reached from.

    After shortening, every vertex takes the smallest id that reaches it; the ones
    that reach that id back are its component. They go, as do edges between
    vertices with different ids, and what is left is looked at again.
    """
    all_links = written(edges.select("src", "dst").distinct())
    ids = all_links.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    short = shorten(all_links.where("src <> dst").withColumn("weight", F.lit(1.0)))
    kept = short.links.select("src", "dst").where("src <> dst")
    done = Parts(lambda df: df, written(short.rings.select("id", F.col("low").alias("component"))))
    links = _trimmed(written(kept))
    while not links.isEmpty():
        back = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
        ends = links.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
        label = written(_spread_least(links, ends.select("id", F.col("id").alias("least"))))
        same = links.join(label.select(F.col("id").alias("src"), F.col("least").alias("a")), "src").join(
            label.select(F.col("id").alias("dst"), F.col("least").alias("b")), "dst").where("a = b").select("src", "dst", F.col("a").alias("least"))
        same = written(same)
        # Back from every vertex that carries its own id, over edges inside its label.
        back = same.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
        members = written(_spread_least(back, label.where("id = least")))
        done.add(members.select("id", F.col("least").alias("component")))
        gone = members.select("id")
        left = same.join(gone.withColumnRenamed("id", "src"), "src", "left_anti").join(gone.withColumnRenamed("id", "dst"), "dst", "left_anti")
        links = _trimmed(written(left.select("src", "dst")))
    known = ids.join(done.union(), "id", "left").select("id", F.coalesce("component", "id").alias("component"))
    known = written(known)
    # A passing vertex belongs to its ends if they are in one component.
    ends = short.passing.select("id", "up", "down").join(known.select(F.col("id").alias("up"), F.col("component").alias("a")), "up").join(
        known.select(F.col("id").alias("down"), F.col("component").alias("b")), "down").where("a = b").select("id", F.col("a").alias("other"))
    joined = known.join(ends, "id", "left").select("id", F.coalesce("other", "component").alias("component"))
    least = joined.groupBy("component").agg(F.min("id").alias("least"))
    return written(joined.join(least, "component").select("id", F.col("least").alias("component")))


def _trimmed(links: DataFrame) -> DataFrame:
    """Edges without those from vertices nothing leads to, or to vertices that lead nowhere; both are no part of a ring."""
    rows = links.count()
    while rows:
        onward = links.select(F.col("src").alias("dst")).distinct()
        into = links.select(F.col("dst").alias("src")).distinct()
        less = written(links.join(onward, "dst", "left_semi").join(into, "src", "left_semi").select("src", "dst"))
        now = less.count()
        if now == rows:
            break
        links, rows = less, now
    return links


def _spread_least(links: DataFrame, start: DataFrame) -> DataFrame:
    """(id, least): the smallest value of ``start`` (id, least) that reaches a vertex; only changed vertices send."""
    def smallest(df):
        return df.groupBy("id").agg(F.min("least").alias("least"))

    now = written(start)
    known = Parts(smallest, now)
    while True:
        senders, rows = sent_if_few(now)
        if not rows:
            return known.whole()
        offers = written(links.select("src", "dst").join(senders, F.col("src") == F.col("id")).groupBy(F.col("dst").alias("id")).agg(
            F.min("least").alias("least")))
        told, _ = sent_if_few(offers.select("id"))
        old = smallest(known.union().join(told, "id", "left_semi")).withColumnRenamed("least", "old")
        now = written(offers.join(old, "id", "left").where("old IS NULL OR least < old").select("id", "least"))
        known.add(now)


def closure(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members, pairs): what reaches what, without listing the pairs inside a component.

    ``members`` are (id, component). ``pairs`` are (src, dst) over components, and
    (c, c) for a component whose vertices reach themselves. Paths between
    components are doubled: a round joins the new paths with all of them, so the
    rounds grow with the logarithm of the longest path.
    """
    links = written(edges.select("src", "dst").distinct())
    members = strong_components(links)
    of = links.join(members.select(F.col("id").alias("src"), F.col("component").alias("a")), "src").join(
        members.select(F.col("id").alias("dst"), F.col("component").alias("b")), "dst")
    steps = written(of.select(F.col("a").alias("src"), F.col("b").alias("dst")).distinct())
    loops = steps.where("src = dst")
    paths = Parts(lambda df: df, steps.where("src <> dst"))
    fresh = paths.union()
    while not fresh.isEmpty():
        known = paths.union()
        first = fresh.select("src", F.col("dst").alias("via")).join(known.select(F.col("src").alias("via"), "dst"), "via")
        second = known.select("src", F.col("dst").alias("via")).join(fresh.select(F.col("src").alias("via"), "dst"), "via")
        longer = first.unionByName(second).select("src", "dst").distinct()
        fresh = written(longer.join(known, ["src", "dst"], "left_anti"))
        paths.add(fresh)
    return members, paths.union().unionByName(loops)


def transitive_closure(edges: DataFrame) -> DataFrame:
    """All (src, dst) joined by a path: the closure written out, as many rows as there are pairs."""
    members, pairs = closure(edges)
    # Without rings every vertex is its own component, and the pairs are not dealt again.
    if members.where("id <> component").isEmpty():
        return pairs
    sources = members.select(F.col("id").alias("from"), F.col("component").alias("src"))
    targets = members.select(F.col("id").alias("to"), F.col("component").alias("dst"))
    return pairs.join(sources, "src").join(targets, "dst").select(F.col("from").alias("src"), F.col("to").alias("dst"))
