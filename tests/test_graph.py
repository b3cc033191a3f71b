import random

import pytest
from pyspark.sql import functions as F

from paddock.operators import graph, parts, reach


@pytest.fixture(scope="module")
def pairs():
    rng = random.Random(11)
    hub = [(0, i) for i in range(1, 12)] + [(i, 0) for i in range(1, 5)]
    return sorted(set(hub + [(rng.randint(0, 20), rng.randint(0, 20)) for _ in range(40)] + [(30, 31), (31, 32)]))


@pytest.fixture(scope="module")
def edges(spark, pairs):
    return spark.createDataFrame(pairs + pairs[:5], "src long, dst long")


def simple_rank(pairs, rounds, keep):
    out = {}
    for s, d in set(pairs):
        out.setdefault(s, []).append(d)
    nodes = {v for p in pairs for v in p} if keep else set(out)
    ranks = dict.fromkeys(nodes, 1.0)
    for _ in range(rounds):
        got = dict.fromkeys(nodes, 0.0) if keep else {}
        for s, targets in out.items():
            for d in targets:
                if s in ranks:
                    got[d] = got.get(d, 0.0) + ranks[s] / len(targets)
        ranks = {v: 0.15 + 0.85 * x for v, x in got.items()}
    return ranks


@pytest.mark.parametrize("keep", [False, True])
def test_page_rank(edges, pairs, keep):
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    got = {r.id: r["rank"] for r in graph.page_rank(edges, 5, ends if keep else None, every=2).collect()}
    want = simple_rank(pairs, 5, keep)
    assert got.keys() == want.keys() and all(abs(got[v] - want[v]) < 1e-9 for v in want)


def test_page_rank_until(edges, pairs):
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    got = {r.id: r["rank"] for r in graph.page_rank_until(edges, ends, 1e-6).collect()}
    want = simple_rank(pairs, 200, True)
    assert all(abs(got[v] - want[v]) < 1e-4 for v in want)


def test_transitive_closure(edges, pairs):
    want = set(pairs)
    while True:
        more = {(a, d) for a, b in want for c, d in pairs if b == c} - want
        if not more:
            break
        want |= more
    rows = reach.transitive_closure(edges).collect()
    assert len(rows) == len(want) and {tuple(r) for r in rows} == want


def test_connected_components(spark, edges, pairs):
    chain = [(100 + i, 101 + i) for i in range(40)]
    lone = spark.createDataFrame([(500,)], "id long")
    got = {r.id: r.component for r in graph.connected_components(
        edges.unionByName(spark.createDataFrame(chain, "src long, dst long")), lone).collect()}
    parent = {v: v for p in pairs + chain for v in p} | {500: 500}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in pairs + chain:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    assert got == {v: root(v) for v in parent}


def test_triangles(edges, pairs):
    links = {frozenset(p) for p in pairs if p[0] != p[1]}
    nodes = {v for p in links for v in p}
    want = {v: sum(1 for a in nodes for b in nodes if a < b and frozenset((v, a)) in links and frozenset((v, b)) in links
                   and frozenset((a, b)) in links) for v in nodes}
    assert {r.id: r.triangles for r in graph.triangle_counts(edges).collect()} == want


def test_shortest_paths(spark, pairs):
    weighted = [(s, d, float((s * 7 + d * 3) % 10 + 1)) for s, d in pairs]
    df = spark.createDataFrame(weighted + [(s, d, w + 5) for s, d, w in weighted[:7]], "src long, dst long, weight double")
    want = {0: 0.0}
    for _ in range(50):
        for s, d, w in weighted:
            if s in want and want[s] + w < want.get(d, float("inf")):
                want[d] = want[s] + w
    assert {r.id: r.distance for r in reach.shortest_paths(df, 0).collect()} == want


def test_neighbours_and_subgraph(spark, edges, pairs):
    vertices = spark.createDataFrame([(v, float(v % 6)) for v in range(40)], "id long, age double")
    got = {r.id: (r.n, r.mean) for r in graph.aggregate_neighbours(edges.distinct(), vertices, "age").collect()}
    want = {}
    for s, d in pairs:
        if s % 6 > d % 6:
            want.setdefault(d, []).append(float(s % 6))
    assert got == {d: (len(x), sum(x) / len(x)) for d, x in want.items()}
    kept = vertices.where("age > 2")
    assert {tuple(r) for r in graph.subgraph(edges, kept).collect()} == {p for p in pairs if p[0] % 6 > 2 and p[1] % 6 > 2}


def test_components_of_a_long_chain_take_few_rounds(spark, monkeypatch):
    written = []
    real = graph.checkpoint
    monkeypatch.setattr(graph, "checkpoint", lambda df: written.append(1) or real(df))
    n = 2000
    edges = spark.range(n).select(F.pmod(F.col("id") * 7919, F.lit(n + 1)).alias("src"), F.pmod((F.col("id") + 1) * 7919, F.lit(n + 1)).alias("dst"))
    labels = graph.connected_components(edges)
    assert {r["component"] for r in labels.collect()} == {0} and labels.count() == n + 1
    assert len(written) <= 16


def test_components_with_loops_hubs_and_lone_vertices(spark):
    edges = [(5, 5), (1, 2), (2, 1), (2, 3), (8, 7)] + [(100, i) for i in range(101, 400)]
    labels = graph.connected_components(spark.createDataFrame(edges, "src long, dst long"), spark.createDataFrame([(5,), (9,), (3,)], "id long"))
    got = {r["id"]: r["component"] for r in labels.collect()}
    assert got == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 5: 5, 9: 9, **{i: 100 for i in range(100, 400)}}


@pytest.mark.parametrize("rows", [3, 1000])
def test_hubs_get_no_bucket_of_their_own(spark, edges, pairs, rows):
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    got = {r.id: r["rank"] for r in graph.page_rank(edges, 4, ends, group_rows=rows).collect()}
    want = simple_rank(pairs, 4, True)
    assert got.keys() == want.keys() and all(abs(got[v] - want[v]) < 1e-9 for v in want)
    assert not spark.sql("SHOW TABLES LIKE 'links_*'").count()


def test_fewer_and_fewer_ranks_are_passed_on(spark, monkeypatch):
    some = [(i, i // 2) for i in range(1, 400)] + [(0, 399), (5, 1000)]
    passed = []
    real = graph._Links.carried
    monkeypatch.setattr(graph._Links, "carried", lambda self, ranks, value, *a: (
        passed.append(ranks.count() if value == "change" else 400), real(self, ranks, value, *a))[1])
    got = {r.id: r["rank"] for r in graph.page_rank_until(spark.createDataFrame(some, "src long, dst long"), spark.range(400), 0.02, every=2).collect()}
    # Vertex 1000 is none of the given ones and passes nothing on.
    want = simple_rank(some, 200, True)
    assert len(got) == 400 and all(abs(got[v] - want[v]) < 0.2 for v in got)
    few = [n for n in passed if n != 400]
    assert few and max(few) <= 200 and few[-1] < 20


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    made = []
    for module in (reach, parts):
        real = module.written
        monkeypatch.setattr(module, "written", lambda df, real=real: made.append(1) or real(df))
    n = 1000
    chain = spark.range(n).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"), (F.col("id") % 3).cast("double").alias("weight"))
    found = {r.id: r.distance for r in reach.shortest_paths(chain, 0).collect()}
    assert found == {i: float(sum(k % 3 for k in range(i))) for i in range(n + 1)}
    assert len(made) < 45


def test_paths_around_rings_hubs_and_stretches(spark):
    rng = random.Random(8)
    links = [(i, (i + 1) % 50, rng.randrange(9) / 2) for i in range(50)] + [(0, 100 + i, 1.0) for i in range(30)]
    links += [(100 + i, 200 + i, 0.0) for i in range(30)] + [(200 + i, 60, float(i)) for i in range(30)] + [(300, 301, 1.0), (301, 300, 1.0)]
    links += [(60, 61, float("inf")), (60, 62, None), (61, 0, 1.0), (7, 7, 1.0)]
    want, more = {0: 0.0}, True
    while more:
        more = False
        for s, d, w in links:
            if s in want and w is not None and w != float("inf") and want[s] + w < want.get(d, float("inf")):
                want[d], more = want[s] + w, True
    df = spark.createDataFrame(links, "src long, dst long, weight double")
    for width in (None, 100.0):
        assert {r.id: r.distance for r in reach.shortest_paths(df, 0, width).collect()} == want
    assert {tuple(r) for r in reach.shortest_paths(df.limit(0), 4).collect()} == {(4, 0.0)}


def _reached(links):
    onward, out = {}, {}
    for s, d in links:
        onward.setdefault(s, set()).add(d)
    for v in {x for p in links for x in p}:
        seen, todo = set(), list(onward.get(v, ()))
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += onward.get(x, ())
        out[v] = seen
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_strong_components_and_closure(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(40), rng.randrange(40)) for _ in range(45)] + [(50, 51), (51, 52), (52, 50), (60, 60), (61, 62)]
    links += [(70 + i, 71 + i) for i in range(9)] + [(79, 70), (75, 61), (52, 70)]
    reached = _reached(links)
    df = spark.createDataFrame(links, "src long, dst long")
    want = {v: min([v] + [x for x in reached[v] if v in reached[x]]) for v in reached}
    assert {r.id: r.component for r in reach.strong_components(df).collect()} == want
    rows = reach.transitive_closure(df).collect()
    assert {tuple(r) for r in rows} == {(v, x) for v in reached for x in reached[v]} and len(rows) == sum(map(len, reached.values()))


def test_a_large_ring_is_one_component(spark):
    n = 100_000
    ring = spark.range(n).select(F.col("id").alias("src"), ((F.col("id") + 1) % n).alias("dst"))
    members, pairs = reach.closure(ring)
    assert members.count() == n and members.where("component <> 0").isEmpty()
    assert [tuple(r) for r in pairs.collect()] == [(0, 0)]


def test_closure_without_edges(spark):
    none = spark.createDataFrame([], "src long, dst long")
    assert reach.transitive_closure(none).count() == 0 and reach.strong_components(none).count() == 0


def test_triangles_send_lists_and_no_pairs_of_edges(spark):
    pairs = [(a, b) for a in range(20) for b in range(20)] + [(100, i) for i in range(200, 400)] + [(None, 3)]
    counts = graph.triangle_counts(spark.createDataFrame(pairs, "src long, dst long"))
    assert {r.id: r.triangles for r in counts.collect()} == {**dict.fromkeys(range(20), 19 * 18 // 2), **dict.fromkeys([100, *range(200, 400)], 0)}
    # Two edges of one vertex would meet the edge between their ends in a join by both.
    assert "array_intersect" in counts._jdf.queryExecution().optimizedPlan().toString()


def test_triangles_send_nothing_to_last_vertices_and_short_ids(spark, monkeypatch):
    pairs = [(a, b) for a in range(6) for b in range(6)] + [(100, i) for i in range(6)] + [(200, 100), (None, 3)]
    want = {**dict.fromkeys(range(6), 15), 100: 15, 200: 0}

    def counted(shift):
        found = graph.triangle_counts(spark.createDataFrame(pairs, "src long, dst long").selectExpr(f"src + {shift} AS src", f"dst + {shift} AS dst"))
        assert found.schema["id"].dataType.simpleString() == "bigint"
        assert {r.id - shift: r.triangles for r in found.collect()} == want
        return found._jdf.queryExecution().optimizedPlan().toString()

    plan = counted(0)
    assert "LeftAnti" in plan and "cast(id" in plan
    # Ids at both ends of four bytes, and just beyond them.
    assert "cast(id" in counted(2 ** 31 - 201) and "cast(id" in counted(-2 ** 31)
    assert "cast(id" not in counted(2 ** 31 - 200) and "cast(id" not in counted(-2 ** 31 - 1)
    monkeypatch.setattr(graph, "LAST_ROWS", 0)
    assert "LeftAnti" not in counted(0)


def test_pairs_without_rings_are_not_dealt_again(spark):
    chain = spark.createDataFrame([(1, 2), (2, 3), (4, 3)], "src long, dst long")
    found = reach.transitive_closure(chain)
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, found.collect())) == [(1, 2), (1, 3), (2, 3), (4, 3)]


def test_rank_rows_hold_many_targets_and_not_all(spark, monkeypatch):
    pairs = [(1, i) for i in range(2, 300)] + [(i, 1) for i in range(2, 20)] + [(1, 2), (5, 5)]
    edges = spark.createDataFrame([*pairs, (1, None)], "src long, dst long")
    pairs.append((1, None))
    once = {r.id: r.rank for r in graph.page_rank(edges, 3).collect()}
    assert None in once
    links = graph._Links(edges)
    rows = spark.table(links.name).collect()
    links.close(spark.range(1))
    assert len(rows) == 20 and {(r.src, e) for r in rows for e in r.ends} == set(pairs)
    monkeypatch.setattr(graph, "ENDS", 20)
    links = graph._Links(edges)
    rows = spark.table(links.name).collect()
    links.close(spark.range(1))
    assert sum(r.src == 1 for r in rows) > 10 and len([e for r in rows for e in r.ends]) == len(set(pairs))
    again = {r.id: r.rank for r in graph.page_rank(edges, 3).collect()}
    assert again.keys() == once.keys() and all(abs(again[i] - once[i]) < 1e-9 for i in once)
