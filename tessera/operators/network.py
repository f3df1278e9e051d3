"""Metrics of whole graphs as rounds of joins: path centralities, bridges and blocks, communities by modularity.

Edges are DataFrames (src, dst, weight) as in ``graph``. Loops cut lineage with reliable checkpoints.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.numeric import ratio
from tessera.sources.staging import cut

from .graph import components, degrees, nodes_of, pagerank


def eigenvector(edges: DataFrame, most_rounds: int = 100, tolerance: float = 1e-6, every: int = 10) -> DataFrame:
    """(node, eigenvector): x + A^T x, scaled to length 1, until ``every`` rounds move the components by less than ``tolerance`` a node in all."""
    nodes = cut(nodes_of(edges))
    n = nodes.count()
    if not n:
        return nodes.withColumn("eigenvector", F.lit(0.0))
    w = cut(edges.select("src", "dst", F.col("weight").cast("double").alias("w")).union(nodes.select("node", "node", F.lit(1.0))))
    state = before = nodes.select("node", F.lit(n**-0.5).alias("x"))
    for k in range(1, most_rounds + 1):
        state = state.join(w, F.col("node") == F.col("src")).groupBy(F.col("dst").alias("node")).agg(F.sum(F.col("x") * F.col("w")).alias("x"))
        if k % every == 0:  # scaled then: the direction is the same
            state = cut(state)
            length = state.agg(F.sqrt(F.sum(F.col("x") * F.col("x")))).first()[0]
            state = state.select("node", (F.col("x") / length).alias("x"))
            if state.join(before.withColumnRenamed("x", "b"), "node").agg(F.sum(F.abs(F.col("x") - F.col("b")))).first()[0] < n * tolerance:
                break
            before = state
    return state.select("node", F.col("x").alias("eigenvector"))


def _blocks_of_rows(src: np.ndarray, w: np.ndarray, first: np.ndarray, degree: np.ndarray, rows: int = 4096) -> list[tuple]:
    """(from, to, sources, weights): nodes from..to have one edge in each from these sources, or one node has all of them. Nodes are in order of
    falling degree in, so the k-th edges of ``rows`` nodes that follow each other are those of the leading ones."""
    out = []
    for a in range(0, len(degree), rows):
        own = degree[a : a + rows]
        for k in range(own[0]):
            b = a + int(np.searchsorted(-own, -k))
            if b - a < 16:  # what hubs have left
                for r in range(a, b):
                    for at in np.split(np.arange(first[r] + k, first[r] + degree[r]), range(rows, degree[r] - k, rows)):
                        out.append((r, r + 1, src[at], w[at][:, None]))
                break
            at = first[a:b] + k
            out.append((a, b, src[at], w[at][:, None]))
    return out


def _distances(blocks: list[tuple], n: int, sources: np.ndarray, far) -> np.ndarray | None:
    """Shortest distances to each node (rows) from each source (columns) in the type of ``far``, which stands for no path; None if
    one does not fit below it."""
    dist = np.full((n, len(sources)), far)
    dist[sources, np.arange(len(sources))] = 0
    hold = np.empty((max(len(src) for _, _, src, _ in blocks), len(sources)), dist.dtype)

    def nearer(a, b, src, w):
        near = np.take(dist, src, axis=0, out=hold[: len(src)], mode="clip")
        near += w
        return near if len(src) == b - a else near.min(axis=0)

    while True:
        before = dist.copy()
        for block in blocks:
            own = dist[block[0] : block[1]]
            np.minimum(own, nearer(*block), out=own)
        if (before == dist).all():
            break
    if np.isfinite(far) and (dist == far).any():
        for a, b, src, w in blocks:
            if ((np.take(dist, src, axis=0) < far) & (dist[a:b] == far)).any():
                return None
    return dist


def _steps(dist: np.ndarray, src: np.ndarray, dst: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, list]:
    """Edges of one source's shortest paths, sorted into steps (from, to) no edge of which starts where another of the same step ends."""
    ends = dist[dst]
    if len(ends) and ends.max() / least <= 4096:  # each edge adds the least weight at least
        width = int(least) if dist.dtype.kind == "u" else least * (1 - 1e-6)
        step = ends // width if dist.dtype.kind == "u" else (ends // width).astype(np.uint16)
    else:  # the most edges that lead there
        most = np.zeros(len(dist), np.int64)
        while True:
            before = most.copy()
            np.maximum.at(most, dst, most[src] + 1)
            if (before == most).all():
                break
        step = most[dst]
    order = np.argsort(step, kind="stable")
    cuts = [0, *(np.flatnonzero(np.diff(step[order])) + 1).tolist(), len(order)]
    return src[order], dst[order], list(zip(cuts, cuts[1:]))


def _through(dist: np.ndarray, source: int, src: np.ndarray, dst: np.ndarray, w: np.ndarray, degree: np.ndarray, least: float) -> np.ndarray:
    """What one source's shortest paths add to each node's betweenness. Each edge on such a path is taken once up and once down."""
    near, ends = np.take(dist, src, mode="clip"), np.repeat(dist, degree)
    if dist.dtype.kind == "u":
        on = np.flatnonzero(near + w == ends)
    else:
        on = np.flatnonzero((near + w <= ends * (1 + 1e-12)) & (near < ends))
    src, dst, steps = _steps(dist, src[on], dst[on], least)
    paths, share = np.zeros(len(dist)), np.zeros(len(dist))
    paths[source] = 1
    for a, b in steps:
        np.add.at(paths, dst[a:b], paths[src[a:b]])
    part = np.divide(1, paths, out=np.zeros_like(paths), where=paths > 0)
    for a, b in reversed(steps):
        np.add.at(share, src[a:b], share[dst[a:b]] + part[dst[a:b]])
    through = paths * share
    through[source] = 0
    return through


def _kinds(w: np.ndarray) -> list:
    """Types that hold distances exactly, the narrowest first, each as its value for no path: sums with a weight stay in the type."""
    whole = len(w) and (w == np.floor(w)).all()
    return [k(np.iinfo(k).max - w.max()) for k in (np.uint8, np.uint16) if whole and 2 * w.max() < np.iinfo(k).max] + [np.float64(np.inf)]


def _in_arrays(edges: DataFrame, nodes: DataFrame, cells: int) -> DataFrame:
    """Every task holds the edges as arrays and takes its share of the sources, some at a time."""
    names = pd.Index(sorted(r["node"] for r in nodes.collect()))
    e, n = edges.toPandas(), len(names)
    dst = names.get_indexer(e["dst"])
    names = names[np.argsort(-np.bincount(dst, minlength=n), kind="stable")]  # the most edges in come first
    src, dst = names.get_indexer(e["src"]), names.get_indexer(e["dst"])
    order = np.lexsort((src, dst))
    arrays = edges.sparkSession.sparkContext.broadcast((src[order], dst[order], e["weight"].to_numpy(float)[order]))

    def run(batches):
        src, dst, w = arrays.value
        degree = np.bincount(dst, minlength=n)
        kinds, far, through, distance, reached = _kinds(w), None, np.zeros(n), np.zeros(n), np.zeros(n)
        for pdf in batches:
            ids = pdf["id"].to_numpy()
            while len(ids):
                if far is None:
                    far = kinds.pop(0)
                    own = w.astype(far.dtype)
                    blocks = _blocks_of_rows(src, own, np.cumsum(degree) - degree, degree)
                some = ids[: max(1, cells // (n * far.dtype.itemsize))]
                dist = _distances(blocks, n, some, far)
                if dist is None:  # too far for this type: the same sources in the next one
                    far = None
                    continue
                there = dist < far
                distance += np.where(there, dist, 0).sum(axis=1, dtype=float)
                reached += there.sum(axis=1) - np.bincount(some, minlength=n)
                for source, row in zip(some, np.ascontiguousarray(dist.T)):
                    through += _through(row, source, src, dst, own, degree, w.min())
                ids = ids[len(some) :]
        yield pd.DataFrame({"id": np.arange(n), "through": through, "distance": distance, "reached": reached})

    spark = edges.sparkSession
    sums = spark.range(n).mapInPandas(run, "id long, through double, distance double, reached double").groupBy("id").agg(*[F.sum(c).alias(c) for c in ("through", "distance", "reached")])
    return cut(sums).join(spark.createDataFrame(pd.DataFrame({"id": np.arange(n), "node": names}), f"id long, node {dict(edges.dtypes)['src']}"), "id").drop("id")


def _by_joins(edges: DataFrame, nodes: DataFrame, sources: int) -> DataFrame:
    """The same sums for edges that no task need hold: rows (source, node), for ``sources`` sources at a time."""
    out = None
    batches = max(1, -(-nodes.count() // sources))
    for k in range(batches):
        own = nodes.where(F.pmod(F.xxhash64("node"), F.lit(batches)) == k)
        dist = front = cut(own.select(F.col("node").alias("s"), "node", F.lit(0.0).alias("d")))
        while not front.isEmpty():  # rows that became nearer go on
            step = front.join(edges, F.col("node") == F.col("src")).groupBy("s", F.col("dst").alias("node")).agg(F.min(F.col("d") + F.col("weight")).alias("new"))
            front = cut(step.join(dist, ["s", "node"], "left").where("d is null or new < d").select("s", "node", F.col("new").alias("d")))
            dist = cut(dist.unionByName(front).groupBy("s", "node").agg(F.min("d").alias("d")))
        ends = dist.select("s", F.col("node").alias("dst"), F.col("d").alias("end"))
        dag = dist.join(edges, F.col("node") == F.col("src")).join(ends, ["s", "dst"]).where(F.col("d") + F.col("weight") <= F.col("end") * (1 + 1e-12))
        dag = cut(dag.select("s", "src", "dst"))

        def rounds(rows: DataFrame, frm: str, to: str) -> DataFrame:
            """Sums of x carried over the edges of shortest paths from end ``frm`` to end ``to``, over all numbers of edges."""
            parts = []
            while not rows.isEmpty():
                parts.append(rows)
                rows = cut(rows.join(dag.select("s", F.col(frm).alias("node"), F.col(to).alias("next")), ["s", "node"]).groupBy("s", F.col("next").alias("node")).agg(F.sum("x").alias("x")))
            return reduce(DataFrame.unionByName, parts).groupBy("s", "node").agg(F.sum("x").alias("x"))

        paths = cut(rounds(cut(own.select(F.col("node").alias("s"), "node", F.lit(1.0).alias("x"))), "src", "dst").withColumnRenamed("x", "paths"))
        start = paths.select("s", "node", (1 / F.col("paths")).alias("x"))
        share = rounds(cut(start), "dst", "src").join(start.withColumnRenamed("x", "own"), ["s", "node"]).select("s", "node", (F.col("x") - F.col("own")).alias("share"))
        away = F.col("s") != F.col("node")
        rows = dist.join(paths, ["s", "node"]).join(share, ["s", "node"]).where(away)
        part = cut(rows.groupBy("node").agg(F.sum(F.col("paths") * F.col("share")).alias("through"), F.sum("d").alias("distance"), F.count("*").cast("double").alias("reached")))
        out = part if out is None else out.unionByName(part)
    sums = out.groupBy("node").agg(*[F.sum(c).alias(c) for c in ("through", "distance", "reached")])
    return nodes.join(sums, "node", "left").fillna(0.0, ["through", "distance", "reached"])


def path_centrality(edges: DataFrame, held_edges: int = 2_000_000, cells: int = 6_000_000, sources: int = 256) -> DataFrame:
    """(node, betweenness, closeness) over all weighted shortest paths between all nodes, of graphs of any size.

    Betweenness: the share of shortest paths between two others that pass a node, summed, over (n - 1)(n - 2). Closeness: of the r nodes
    that reach a node, r / their total distance, times r / (n - 1). Weights are lengths; edges whose length is not above 0 are left out.
    All sources count, so the work is nodes times edges. Up to ``held_edges`` edges (counted first, 24 bytes each) go to every task, which
    takes a share of the sources, as many at a time as ``cells`` bytes hold distances of; whole lengths take a byte or two a distance where
    that holds them. More edges are joined, for ``sources`` sources at a time, and no task holds them.
    """
    edges = cut(edges.where("weight > 0 and src <> dst").groupBy("src", "dst").agg(F.min(F.col("weight").cast("double")).alias("weight")))
    nodes = cut(nodes_of(edges))
    n = nodes.count()
    if not n:
        return nodes.select("node", F.lit(0.0).alias("betweenness"), F.lit(0.0).alias("closeness"))
    sums = _in_arrays(edges, nodes, cells) if edges.count() <= held_edges else _by_joins(edges, nodes, sources)
    closeness = ratio(F.col("reached") * F.col("reached"), F.col("distance") * max(n - 1, 1))
    return sums.select("node", (F.col("through") / max((n - 1) * (n - 2), 1)).alias("betweenness"), closeness.alias("closeness"))


def centrality(edges: DataFrame, **settings) -> DataFrame:
    """(node, pagerank, in_degree, out_degree, betweenness, eigenvector, closeness) of every node, degrees over n - 1; any size."""
    edges = cut(edges)
    rows = degrees(edges).select("node", F.col("in_centrality").alias("in_degree"), F.col("out_centrality").alias("out_degree"))
    return rows.join(pagerank(edges), "node").join(path_centrality(edges, **settings), "node", "left").join(eigenvector(edges), "node")


def spanning_levels(both: DataFrame, roots: DataFrame) -> list[DataFrame]:
    """(node, parent) of each level of breadth-first trees from the roots, in both(src, dst), edges of both directions; parents are the
    smallest ones. Neighbours of a level are in it, before it or the next level."""
    levels = [cut(roots.select("node", F.lit(None).cast(dict(both.dtypes)["src"]).alias("parent")))]
    while True:
        found = levels[-1].select(F.col("node").alias("src")).join(both, "src").groupBy(F.col("dst").alias("node")).agg(F.min("src").alias("parent"))
        for seen in levels[-2:]:
            found = found.join(seen.select("node"), "node", "left_anti")
        found = cut(found)
        if found.isEmpty():
            return levels
        levels.append(found)


def _up(levels: list[DataFrame], own: DataFrame, sums: list) -> DataFrame:
    """own(node, ...) aggregated over each node's subtree, level by level from the leaves; ``sums`` are columns of aggregates."""
    columns = [c for c in own.columns if c != "node"]
    out, below = [], None
    for level in reversed(levels):
        rows = level.join(own, "node")
        if below is not None:
            rows = rows.unionByName(below.select(F.col("parent").alias("node"), F.lit(None).cast(dict(level.dtypes)["parent"]).alias("parent"), *columns))
            rows = rows.groupBy("node").agg(F.max("parent").alias("parent"), *sums)
        below = cut(rows.select("node", "parent", *columns))
        out.append(below)
    return reduce(DataFrame.unionByName, out)


def blocks(edges: DataFrame, salts: int = 64) -> DataFrame:
    """(a, b, block, bridge) of each undirected edge a < b: edges of one block lie on common cycles; a bridge is alone in its block.

    Tree edges of any spanning forest, named by their lower ends, are of one block where an edge outside the tree joins their subtrees
    or passes above them; subtrees are ranges of numbers in preorder. Sizes go up, numbers down and the least and greatest number that
    a subtree's outer edges reach go up the levels of breadth-first trees, so the rounds grow with the depth, not with the
    nodes; siblings are numbered in ``salts`` parts, so a hub is no single task. No edges give no rows; loops are left out.
    """
    u = cut(edges.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).where("a <> b").distinct())
    both = cut(u.select(F.col("a").alias("src"), F.col("b").alias("dst")).union(u.select("b", "a")))
    levels = spanning_levels(both, components(u.select(F.col("a").alias("src"), F.col("b").alias("dst"))).where("node = component").select("node"))
    every = cut(reduce(DataFrame.unionByName, [x.withColumn("level", F.lit(k)) for k, x in enumerate(levels)]))
    size = cut(_up(levels, every.select("node", F.lit(1).cast("long").alias("size")), [F.sum("size").alias("size")]))
    # what stands before a child among its siblings: whole parts before, then its own part up to it
    kin = size.where("parent is not null").withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(salts)))
    part = kin.groupBy("parent", "salt").agg(F.sum("size").alias("all"))
    part = part.withColumn("ahead", F.sum("all").over(Window.partitionBy("parent").orderBy("salt")) - F.col("all")).drop("all")
    within = F.sum("size").over(Window.partitionBy("parent", "salt").orderBy("node")) - F.col("size")
    ahead = cut(kin.withColumn("within", within).join(part, ["parent", "salt"]).select("node", (F.col("within") + F.col("ahead") + 1).alias("ahead")))
    numbered = [levels[0].select("node", F.lit(0).cast("long").alias("pre"))]
    for level in levels[1:]:
        above = numbered[-1].select(F.col("node").alias("parent"), F.col("pre").alias("top"))
        numbered.append(cut(level.join(above, "parent").join(ahead, "node").select("node", (F.col("top") + F.col("ahead")).alias("pre"))))
    tree = cut(size.join(reduce(DataFrame.unionByName, numbered), "node"))
    x = tree.select(F.col("node").alias("a"), F.col("parent").alias("pa"), F.col("pre").alias("na"), F.col("size").alias("sa"))
    y = tree.select(F.col("node").alias("b"), F.col("parent").alias("pb"), F.col("pre").alias("nb"), F.col("size").alias("sb"))
    ends = cut(u.join(x, "a").join(y, "b").withColumn("in_tree", F.coalesce(F.col("pa") == F.col("b"), F.lit(False)) | F.coalesce(F.col("pb") == F.col("a"), F.lit(False))))
    outer = ends.where("not in_tree")
    far = outer.select(F.col("a").alias("node"), F.col("nb").alias("n")).union(outer.select("b", "na")).union(tree.select("node", "pre"))
    reach = _up(levels, cut(far.groupBy("node").agg(F.min("n").alias("low"), F.max("n").alias("high"))), [F.min("low").alias("low"), F.max("high").alias("high")])
    tree = cut(tree.join(reach.select("node", "low", "high"), "node"))
    above = tree.where("parent is not null").select(F.col("node").alias("v"), F.col("pre").alias("v_pre"), F.col("size").alias("v_size"))
    passes = tree.join(above, F.col("parent") == F.col("v")).where("low < v_pre or high >= v_pre + v_size").select(F.col("node").alias("src"), F.col("v").alias("dst"))
    apart = outer.where("greatest(na, nb) >= if(na < nb, na + sa, nb + sb)").select(F.col("a").alias("src"), F.col("b").alias("dst"))
    label = components(cut(passes.union(apart)))
    named = tree.where("parent is not null").join(label, "node", "left").select("node", F.coalesce("component", "node").alias("block"), ((F.col("low") >= F.col("pre")) & (F.col("high") < F.col("pre") + F.col("size"))).alias("bridge"))
    # a tree edge is named by its child, another by its end of the greater number
    by = F.when(F.col("in_tree"), F.when(F.coalesce(F.col("pa") == F.col("b"), F.lit(False)), F.col("a")).otherwise(F.col("b"))).when(F.col("na") > F.col("nb"), F.col("a")).otherwise(F.col("b"))
    return ends.withColumn("node", by).join(named, "node").select("a", "b", "block", (F.col("bridge") & F.col("in_tree")).alias("bridge"))


def cut_nodes(edges: DataFrame) -> DataFrame:
    """(node, bridge_ends, blocks, articulation): bridges that end at a node, the blocks it is in, and whether its loss parts them."""
    e = blocks(edges)
    ends = e.select(F.col("a").alias("node"), "block", "bridge").union(e.select("b", "block", "bridge"))
    per = ends.groupBy("node", "block").agg(F.max(F.col("bridge").cast("long")).alias("bridge"))
    return per.groupBy("node").agg(F.sum("bridge").alias("bridge_ends"), F.count("*").alias("blocks"), (F.count("*") > 1).alias("articulation"))


def louvain(edges: DataFrame, levels: int = 10, rounds: int = 16, least_gain: float = 1e-4) -> DataFrame:
    """(node, community, modularity): communities by moves that raise modularity, then of communities as nodes, until nothing is gained.

    Weights of both directions are summed. In a round each node may join the neighbouring community that gains most (ties to the smaller
    name); a hash of node and round lets half of those that would gain move, as all at once would swap places. The best labels
    of a level's rounds are kept, communities become nodes and edges between them are summed, so each level is smaller. A community is
    named by its smallest node. The last column is the modularity of the whole result, the same in all rows.
    """
    both = edges.where("src <> dst").select("src", "dst", F.col("weight").cast("double").alias("w"))
    both = cut(both.union(both.select("dst", "src", "w")).groupBy("src", "dst").agg(F.sum("w").alias("w")))
    total = both.agg(F.sum("w")).first()[0]
    nodes = nodes_of(edges)
    result, best = cut(nodes.select("node", F.col("node").alias("community"))), 0.0
    if not total:
        return result.withColumn("modularity", F.lit(0.0))
    best = -both.groupBy("src").agg(F.sum("w").alias("k")).agg(F.sum(F.pow(F.col("k") / total, 2))).first()[0]  # every node alone
    for _ in range(levels):
        degree = cut(both.groupBy(F.col("src").alias("node")).agg(F.sum("w").alias("k"), F.sum(F.when(F.col("src") == F.col("dst"), F.col("w")).otherwise(0.0)).alias("loop")))
        labels = degree.select("node", F.col("node").alias("c"))
        kept, top = None, best
        for r in range(rounds):
            own = degree.join(labels, "node")
            sums = own.groupBy("c").agg(F.sum("k").alias("sum"))
            to = both.where("src <> dst").join(labels, F.col("dst") == F.col("node")).groupBy(F.col("src").alias("node"), "c").agg(F.sum("w").alias("w"))
            to = to.union(labels.select("node", "c", F.lit(0.0)))  # its own one, linked or not
            to = to.groupBy("node", "c").agg(F.sum("w").alias("w")).join(sums, "c").join(own.select("node", "k", "loop", F.col("c").alias("now")), "node")
            gain = F.col("w") - F.col("k") * (F.col("sum") - F.when(F.col("c") == F.col("now"), F.col("k")).otherwise(0.0)) / total
            here = F.max(F.when(F.col("c") == F.col("now"), F.struct(gain.alias("gain"), "w")))
            wish = cut(to.groupBy("node", "now", "k", "loop").agg(here.alias("here"), F.max(gain).alias("most"), F.min_by("c", F.struct((-gain).alias("g"), "c")).alias("c")))
            wants = (F.col("c") != F.col("now")) & (F.col("most") > F.col("here.gain") + 1e-9 * total)
            inside, squares, wanting = wish.agg(F.sum(F.col("here.w") + F.col("loop")), F.lit(0), F.count(F.when(wants, 1))).first()
            squares = wish.groupBy("now").agg(F.sum("k").alias("k")).agg(F.sum(F.col("k") * F.col("k"))).first()[0]
            q = inside / total - squares / total**2
            if kept is None or q > top:
                kept, top = wish.select("node", F.col("now").alias("c")), max(q, top)
            if not wanting or r == rounds - 1:
                break
            turn = F.pmod(F.xxhash64("node", F.lit(r)), F.lit(2)) == 0
            labels = cut(wish.select("node", F.when(wants & turn, F.col("c")).otherwise(F.col("now")).alias("c")))
        if top <= best + least_gain:
            break
        best = top
        result = cut(result.join(kept.select(F.col("node").alias("community"), "c"), "community").select("node", F.col("c").alias("community")))
        a, b = kept.select(F.col("node").alias("src"), F.col("c").alias("x")), kept.select(F.col("node").alias("dst"), F.col("c").alias("y"))
        both = cut(both.join(a, "src").join(b, "dst").groupBy(F.col("x").alias("src"), F.col("y").alias("dst")).agg(F.sum("w").alias("w")))
    names = result.groupBy("community").agg(F.min("node").alias("name"))
    return result.join(names, "community").select("node", F.col("name").alias("community"), F.lit(float(best)).alias("modularity"))
