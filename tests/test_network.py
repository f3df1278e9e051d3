"""Graph metrics against all paths, removals and serial moves."""

import heapq
import itertools
import random
import time

import numpy as np
import pytest

from tessera.operators import graph, network


def paths(edges, s, t):
    """Least weighted length and all shortest simple paths, by trying all."""
    nodes = {x for e in edges for x in e[:2]}
    w = {(a, b): c for a, b, c in edges}
    best, found = None, []
    for n in range(len(nodes) - 1):
        for mid in itertools.permutations(nodes - {s, t}, n):
            p = (s, *mid, t)
            if all(e in w for e in zip(p, p[1:])):
                c = sum(w[e] for e in zip(p, p[1:]))
                if best is None or c < best:
                    best, found = c, []
                if c == best:
                    found.append(p)
    return best, found


SMALL = [(1, 2, 1.0), (2, 3, 1.0), (1, 3, 2.0), (3, 4, 1.0), (4, 1, 5.0), (2, 5, 3.0), (5, 4, 1.0), (6, 1, 1.0)]


@pytest.mark.parametrize("way", [{"cells": 1}, {"held_edges": 0, "sources": 4}])
def test_centrality_equals_all_paths(spark, way):
    df = spark.createDataFrame(SMALL, "src long, dst long, weight double")
    got = {r["node"]: r for r in network.path_centrality(df, **way).collect()}
    nodes = range(1, 7)
    for v in nodes:
        through = 0.0
        for s, t in itertools.permutations([x for x in nodes if x != v], 2):
            _, p = paths(SMALL, s, t)
            through += sum(v in x for x in p) / len(p) if p else 0
        assert got[v]["betweenness"] == pytest.approx(through / 20)
        reach = [paths(SMALL, s, v)[0] for s in nodes if s != v]
        reach = [x for x in reach if x is not None]
        assert got[v]["closeness"] == pytest.approx(len(reach) / sum(reach) * len(reach) / 5 if reach else 0.0)


def random_edges(n, m, seed, groups=1):
    rng = random.Random(seed)
    out = {}
    while len(out) < m:
        a = rng.randrange(n)
        b = rng.randrange(n) if rng.random() < 0.05 else (a // (n // groups) * (n // groups) + rng.randrange(n // groups)) % n
        if a != b:
            out[a, b] = float(rng.randint(1, 9))
    return [(a, b, w) for (a, b), w in out.items()]


def test_both_ways_agree_above_any_limit(spark):
    """500 edges and more nodes, in arrays and by joins."""
    df = spark.createDataFrame(random_edges(520, 500, 3), "src long, dst long, weight double")
    a = {r["node"]: (r["betweenness"], r["closeness"]) for r in network.path_centrality(df).collect()}
    b = {r["node"]: (r["betweenness"], r["closeness"]) for r in network.path_centrality(df, held_edges=0, sources=2000).collect()}
    assert set(a) == set(b) and all(a[v] == pytest.approx(b[v]) for v in a) and max(x for x, _ in a.values()) > 0


def brandes(edges):
    """Betweenness sums and closeness by one search a source, in plain Python."""
    nodes = sorted({x for e in edges for x in e[:2]})
    out = {v: [] for v in nodes}
    for a, b, w in edges:
        out[a].append((b, w))
    through, far, reached = dict.fromkeys(nodes, 0.0), dict.fromkeys(nodes, 0.0), dict.fromkeys(nodes, 0)
    for s in nodes:
        dist, paths, before, order, heap = {s: 0.0}, {s: 1.0}, {s: []}, [], [(0.0, s)]
        done = set()
        while heap:
            d, v = heapq.heappop(heap)
            if v in done:
                continue
            done.add(v)
            order.append(v)
            for u, w in out[v]:
                if d + w < dist.get(u, np.inf):
                    dist[u], paths[u], before[u] = d + w, paths[v], [v]
                    heapq.heappush(heap, (d + w, u))
                elif d + w == dist[u]:
                    paths[u] += paths[v]
                    before[u].append(v)
        share = dict.fromkeys(nodes, 0.0)
        for v in reversed(order):
            for u in before[v]:
                share[u] += paths[u] / paths[v] * (1 + share[v])
            if v != s:
                through[v] += share[v]
                far[v] += dist[v]
                reached[v] += 1
    n = len(nodes)
    return {v: (through[v] / ((n - 1) * (n - 2)), reached[v] ** 2 / far[v] / (n - 1) if far[v] else 0.0) for v in nodes}


@pytest.mark.parametrize("weight", [lambda k: k % 9 + 1, lambda k: k % 90 + 30, lambda k: k % 9 * 4000 + 9000, lambda k: (k % 9 + 1) / 8, lambda k: 4.0 ** (k % 12 - 6)])
def test_distances_of_every_width(spark, weight):
    """Whole lengths that fit one or two bytes or neither, fractions, and lengths far apart; two hubs with many edges in."""
    edges = [(a, b, float(weight(k))) for k, (a, b, _) in enumerate([*random_edges(150, 400, 8), *[(a, b, 0) for a in range(2, 150, 2) for b in (150, 151)], (150, 0, 0)])]
    got = {r["node"]: (r["betweenness"], r["closeness"]) for r in network.path_centrality(spark.createDataFrame(edges, "src long, dst long, weight double"), cells=5000).collect()}
    want = brandes(edges)
    assert set(got) == set(want) and all(got[v] == pytest.approx(want[v]) for v in want)


def test_paths_of_thousands_of_nodes_end_soon(spark):
    """A source takes each edge of its shortest paths once up and once down, not in every round: some 10 s, where rounds took minutes."""
    n = 6000
    df = spark.range(n * 10).selectExpr("id % 6000 AS src", "(id % 6000 * 7 + id div 6000) % 6000 AS dst", "CAST(pmod(hash(id), 20) + 3 AS double) AS weight").where("src <> dst")
    start = time.monotonic()
    rows = network.path_centrality(df).collect()
    assert len(rows) == n and min(r["closeness"] for r in rows) > 0 and time.monotonic() - start < 60


def test_influencers_make_their_metrics_once(spark):
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for pdf in batches:
            made.add(len(pdf))
            yield pdf

    metrics = spark.range(1, 31).selectExpr("id AS node", *[f"id / 30 AS {n}" for n in graph.BLEND])
    rows = graph.influencers(metrics.mapInPandas(count, metrics.schema), list(graph.BLEND), 20).collect()
    assert [(r["node"], r["influence_score"]) for r in rows] == [(k, round(k / 30 * 100, 2)) for k in range(30, 10, -1)]
    assert made.value == 30


def test_power_rounds(spark):
    edges = random_edges(40, 200, 9)
    df = spark.createDataFrame(edges, "src long, dst long, weight double")
    names = sorted({x for e in edges for x in e[:2]})
    at, n = {v: i for i, v in enumerate(names)}, len(names)
    a = np.zeros((n, n))
    for s, t, w in edges:
        a[at[t], at[s]] = w
    x = np.ones(n)
    for _ in range(2000):
        x = x + a @ x
        x /= np.linalg.norm(x)
    got = {r["node"]: r["eigenvector"] for r in network.eigenvector(df).collect()}
    assert [got[v] for v in names] == pytest.approx(x, abs=1e-4)
    p = a / np.where(a.sum(axis=0) > 0, a.sum(axis=0), 1)
    r = np.ones(n) / n
    for _ in range(500):
        r = 0.15 / n + 0.85 * (p @ r + r[a.sum(axis=0) == 0].sum() / n)
    got = {r["node"]: r["pagerank"] for r in graph.pagerank(df).collect()}
    assert [got[v] for v in names] == pytest.approx(r, abs=1e-5)


def parts(nodes, edges):
    """Number of components, by merging."""
    own = {v: v for v in nodes}

    def root(v):
        while own[v] != v:
            v = own[v]
        return v

    for a, b in edges:
        own[root(a)] = root(b)
    return len({root(v) for v in nodes})


def one_cycle(edges, e, f):
    """Whether two edges lie on a common simple cycle, by trying the paths between the ends of one that use the other."""
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)

    def walk(v, seen, used):
        if v == e[1]:
            return used
        return any(walk(u, seen | {u}, used or {v, u} == set(f)) for u in near[v] if u not in seen and {v, u} != set(e))

    return walk(e[0], {e[0]}, False)


@pytest.mark.parametrize("n,m,seed", [(14, 15, 3)])
def test_blocks_equal_removals(spark, n, m, seed):
    edges = random_edges(n, m, seed)
    u = sorted({(min(a, b), max(a, b)) for a, b, _ in edges})
    nodes = {x for e in u for x in e}
    df = spark.createDataFrame([*edges, (0, 0, 1.0)], "src long, dst long, weight double")
    got = {(r["a"], r["b"]): (r["block"], r["bridge"]) for r in network.blocks(df).collect()}
    whole = parts(nodes, u)
    assert sorted(got) == u
    for e in u:
        assert got[e][1] == (parts(nodes, [x for x in u if x != e]) > whole)
    if n < 15:
        for e, f in itertools.combinations(u, 2):
            assert (got[e][0] == got[f][0]) == one_cycle(u, e, f)
    points = {r["node"]: (r["bridge_ends"], r["articulation"]) for r in network.cut_nodes(df).collect()}
    for v in nodes:
        rest = nodes - {v}
        assert points[v][1] == (parts(rest, [x for x in u if v not in x]) > whole), v
        assert points[v][0] == sum(got[e][1] for e in u if v in e)


def test_blocks_of_a_long_path_and_nothing(spark):
    path = [(k, k + 1, 1.0) for k in range(8)] + [(100, 101, 1.0), (101, 102, 1.0), (102, 100, 1.0)]
    df = spark.createDataFrame(path, "src long, dst long, weight double")
    rows = network.blocks(df).collect()
    assert sum(r["bridge"] for r in rows) == 8 and len({r["block"] for r in rows}) == 9
    assert network.blocks(df.limit(0)).count() == 0 and network.louvain(df.limit(0)).count() == 0 and network.path_centrality(df.limit(0)).count() == 0


def modularity(edges, own):
    total, inside, k = 0.0, 0.0, {}
    for a, b, w in edges:
        total += 2 * w
        inside += 2 * w * (own[a] == own[b])
        for v in (a, b):
            k[own[v]] = k.get(own[v], 0.0) + w
    return inside / total - sum((x / total) ** 2 for x in k.values())


def serial(edges):
    """Greedy moves in node order and contraction, until nothing moves."""
    whole = {v: v for e in edges for v in e[:2]}
    while True:
        near = {v: {} for e in edges for v in e[:2]}
        for a, b, w in edges:
            near[a][b] = near[a].get(b, 0.0) + w
            near[b][a] = near[b].get(a, 0.0) + w
        k = {v: sum(x.values()) for v, x in near.items()}
        total, own, weight, any_move = sum(k.values()), {v: v for v in near}, dict(k), False
        for _ in range(50):
            moved = False
            for v in sorted(near):
                weight[own[v]] -= k[v]
                gain = {own[v]: 0.0}
                for u, w in near[v].items():
                    if u != v:
                        gain[own[u]] = gain.get(own[u], 0.0) + w
                best = max(gain, key=lambda c: (gain[c] - k[v] * weight[c] / total, -c))
                moved |= best != own[v]
                own[v] = best
                weight[best] += k[v]
            any_move |= moved
            if not moved:
                break
        if not any_move:
            return whole
        whole = {v: own[c] for v, c in whole.items()}
        edges = [(own[a], own[b], w) for a, b, w in edges]


@pytest.mark.parametrize("n,m,groups,seed", [(200, 900, 10, 2)])
def test_louvain_is_as_modular_as_serial_moves(spark, n, m, groups, seed):
    edges = random_edges(n, m, seed, groups)
    rows = network.louvain(spark.createDataFrame(edges, "src long, dst long, weight double")).collect()
    own = {r["node"]: r["community"] for r in rows}
    assert set(own) == {x for e in edges for x in e[:2]} and all(own[c] == c for c in own.values())
    q = modularity(edges, own)
    assert rows[0]["modularity"] == pytest.approx(q)
    assert q >= 0.95 * modularity(edges, serial(edges)), (q, modularity(edges, serial(edges)))
