"""Weighted directed graphs as edge DataFrames (src, dst, weight)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.numeric import ratio
from tessera.sources.staging import cut

#: What an interaction of each kind adds to its edge.
KIND_WEIGHTS = {"mention": 1, "reply": 1, "retweet": 2}
#: Shares of the metrics in an influencer's score.
BLEND = {"pagerank": 0.4, "in_degree": 0.2, "out_degree": 0.1, "betweenness": 0.2, "eigenvector": 0.1}


def build_edges(interactions: DataFrame, least: int = 3) -> DataFrame:
    """Sums the weights of (src, dst, kind), without self-loops, and keeps edges from ``least`` on."""
    w = F.coalesce(*[F.when(F.col("kind") == k, F.lit(v)) for k, v in KIND_WEIGHTS.items()], F.lit(0))
    g = interactions.where("src <> dst").groupBy("src", "dst").agg(F.sum(w).alias("weight"))
    return g.where(F.col("weight") >= least)


def nodes_of(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("src").alias("node")).union(edges.select("dst")).distinct()


def degrees(edges: DataFrame) -> DataFrame:
    """Edges and weights in and out of every node, strength, and degrees over n - 1."""
    both = edges.select(F.col("src").alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i"), "weight").union(edges.select("dst", F.lit(0), F.lit(1), "weight"))
    g = both.groupBy("node").agg(F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree"), F.sum("weight").alias("strength"))
    n = g.agg((F.count("*") - 1).alias("others"))  # one row
    g = g.join(F.broadcast(n))
    return g.select("node", "in_degree", "out_degree", "strength", ratio("in_degree", "others").alias("in_centrality"), ratio("out_degree", "others").alias("out_centrality"))


def pagerank(edges: DataFrame, damping: float = 0.85, tolerance: float = 1e-6, most_rounds: int = 100, every: int = 10) -> DataFrame:
    """Weighted PageRank; the mass of nodes without out-edges goes to all alike. Ends when ``every`` rounds move the ranks by less than
    ``tolerance`` a node in all, or after ``most_rounds``.

    Rounds leave out the mass that is lost in such nodes and the ranks are scaled to 1 in the end, which has the same limit; so a round is one
    join and one sum, whatever the graph.
    """
    nodes = cut(nodes_of(edges))
    n = nodes.count()
    if not n:
        return nodes.withColumn("pagerank", F.lit(0.0))
    out = edges.groupBy("src").agg(F.sum("weight").alias("total"))
    share = edges.join(out, "src").select("src", "dst", (F.col("weight") / F.col("total")).alias("p"))
    share = cut(share.union(nodes.select("node", "node", F.lit(0.0))))  # every node gets something, if nothing
    ranks = before = nodes.select("node", F.lit(1.0 / n).alias("r"))
    for k in range(1, most_rounds + 1):
        ranks = ranks.join(share, F.col("node") == F.col("src")).groupBy(F.col("dst").alias("node")).agg((F.lit((1 - damping) / n) + damping * F.sum(F.col("r") * F.col("p"))).alias("r"))
        if k % every == 0:
            ranks = cut(ranks)
            if ranks.join(before.withColumnRenamed("r", "b"), "node").agg(F.sum(F.abs(F.col("r") - F.col("b")))).first()[0] < n * tolerance:
                break
            before = ranks
    total = ranks.agg(F.sum("r").alias("total"))  # one row
    return ranks.join(F.broadcast(total)).select("node", (F.col("r") / F.col("total")).alias("pagerank"))


def components(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """(node, component): the smallest node that undirected edges reach."""
    both = cut(edges.select("src", "dst").union(edges.select("dst", "src")).distinct())
    labels = cut(nodes_of(edges).select("node", F.col("node").alias("component")))
    for _ in range(most_rounds):
        near = both.join(labels, F.col("dst") == F.col("node")).groupBy("src").agg(F.min("component").alias("c"))
        new = labels.join(near, F.col("node") == F.col("src"), "left").select("node", F.least("component", F.coalesce("c", "component")).alias("component"))
        # labels of labels halve the distance that is left
        new = new.alias("a").join(labels.alias("b"), F.col("a.component") == F.col("b.node"), "left").select("a.node", F.least("a.component", F.coalesce("b.component", "a.component")).alias("component"))
        new = cut(new)
        if new.join(labels, ["node", "component"], "left_anti").isEmpty():
            return new
        labels = new
    raise RuntimeError(f"components: labels still move after {most_rounds} rounds")


def reach(edges: DataFrame, source, depth: int = 3) -> DataFrame:
    """(node, level, path) of the nodes at most ``depth`` steps from a source, itself at level 0; of the shortest paths the least
    by its nodes. A path holds depth + 1 nodes at most."""
    start = F.lit(source).cast(dict(edges.dtypes)["src"])
    seen = edges.where((F.col("src") == source) | (F.col("dst") == source)).limit(1).select(start.alias("node"), F.lit(0).alias("level"), F.array(start).alias("path"))
    front = seen
    for k in range(1, depth + 1):
        step = front.join(edges, F.col("node") == F.col("src")).groupBy(F.col("dst").alias("node")).agg(F.min("path").alias("path"))
        front = cut(step.join(seen, "node", "left_anti").select("node", F.lit(k).alias("level"), F.concat("path", F.array("node")).alias("path")))
        seen = seen.union(front)
        if front.isEmpty():
            break
    return seen


def hub_paths(edges: DataFrame, source, depth: int = 3, least_in: int = 5, k: int = 5) -> DataFrame:
    """(target, path, length) of the k nearest reached nodes with more than ``least_in`` edges in; ties to the smaller node."""
    hubs = edges.groupBy(F.col("dst").alias("node")).agg(F.count("*").alias("n")).where(F.col("n") > least_in).select("node")
    rows = reach(edges, source, depth).join(hubs, "node").orderBy("level", "node").limit(k)
    return rows.select(F.col("node").alias("target"), "path", F.col("level").alias("length"))


def label_propagation(edges: DataFrame, rounds: int = 10) -> DataFrame:
    """(node, community) after a fixed number of rounds in which every node takes the label that weighs most among its
    neighbours in either direction and itself (weight 1); ties to the smaller label. Splits over all tasks, for any size."""
    both = edges.select("src", "dst", "weight").union(edges.select("dst", "src", "weight"))
    both = cut(both.groupBy("src", "dst").agg(F.sum(F.col("weight").cast("double")).alias("weight")))
    labels = nodes_of(edges).select("node", F.col("node").alias("community"))
    own = labels.select(F.col("node").alias("src"), F.col("node").alias("dst"), F.lit(1.0).alias("weight"))
    near = cut(both.union(own))
    for _ in range(rounds):
        votes = near.join(labels, F.col("dst") == F.col("node")).groupBy("src", "community").agg(F.sum("weight").alias("w"))
        labels = cut(votes.groupBy("src").agg(F.min_by("community", F.struct((-F.col("w")).alias("w"), "community")).alias("community")).select(F.col("src").alias("node"), "community"))
    return labels


def stats(edges: DataFrame) -> DataFrame:
    """One row: nodes, edges, density, average degree, components."""
    n = components(edges).agg(F.count("*").alias("nodes"), F.countDistinct("component").alias("components"))
    m = edges.agg(F.count("*").alias("edges"))
    rows = n.join(F.broadcast(m))
    return rows.select("nodes", "edges", "components", ratio("edges", F.col("nodes") * (F.col("nodes") - 1)).alias("density"), ratio(F.col("edges") * 2, "nodes").alias("average_degree"))


def clustering(edges: DataFrame) -> DataFrame:
    """(node, triangles, clustering) of the undirected graph. Each edge points to its end of higher degree, so hubs open few
    pairs and three-way joins stay near the number of edges."""
    u = edges.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).where("a <> b").distinct()
    deg = u.select(F.col("a").alias("node")).union(u.select("b")).groupBy("node").agg(F.count("*").alias("deg"))
    d = u.join(deg.select(F.col("node").alias("a"), F.col("deg").alias("da")), "a").join(deg.select(F.col("node").alias("b"), F.col("deg").alias("db")), "b")
    first = (F.col("da") < F.col("db")) | ((F.col("da") == F.col("db")) & (F.col("a") < F.col("b")))
    o = cut(d.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("x"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("y")))
    wedge = o.alias("p").join(o.alias("q"), F.col("p.x") == F.col("q.x")).where("p.y < q.y").select(F.col("p.x").alias("x"), F.col("p.y").alias("a"), F.col("q.y").alias("b"))
    tri = wedge.join(u, ["a", "b"])
    per = tri.select(F.explode(F.array("x", "a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("t"))
    rows = deg.join(per, "node", "left")
    t = F.coalesce("t", F.lit(0))
    return rows.select("node", t.alias("triangles"), ratio(t * 2, F.col("deg") * (F.col("deg") - 1)).alias("clustering"))


def dual(edges: DataFrame) -> DataFrame:
    """Every edge and its reverse."""
    return edges.select("src", "dst", "weight", F.lit("forward").alias("direction")).union(edges.select("dst", "src", "weight", F.lit("reverse")))


def merge_edges(mentions: DataFrame, keys: list[str], order: str, note: str, tags: str) -> DataFrame:
    """One row per edge: number of mentions, their notes numbered in order, the union of their tags."""
    w = Window.partitionBy(*keys).orderBy(order)
    rows = mentions.withColumn("k", F.row_number().over(w))
    said = F.when(F.col("k") == 1, F.col(note)).otherwise(F.concat(F.lit("[Mention "), "k", F.lit("] "), note))
    g = rows.withColumn("s", said).groupBy(*keys).agg(F.count("*").alias("mention_count"), F.transform(F.sort_array(F.collect_list(F.struct("k", "s"))), lambda x: x["s"]).alias("notes"), F.array_sort(F.collect_set(tags)).alias("tags"))
    return g.select(*keys, "mention_count", F.array_join("notes", " ").alias("summary"), F.array_join("tags", ",").alias("tags"))


def promote(mentions: DataFrame, nodes: DataFrame, key: str, score: str, tie: str) -> DataFrame:
    """The surest mention of each key that is no node yet."""
    rest = [c for c in mentions.columns if c != key]
    best = mentions.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(F.col(score), (-F.col(tie)).alias("t"))).alias("r")).select(key, "r.*")
    return best.join(nodes.select(key), key, "left_anti")


def ego(edges: DataFrame, node, k: int = 10) -> DataFrame:
    """Strongest partners of a node."""
    return edges.where(F.col("src") == node).select("dst", "weight").orderBy(F.desc("weight"), "dst").limit(k)


def entity_stats(edges: DataFrame) -> DataFrame:
    """Per node: degrees, most frequent partner, total weight; all nodes in one pass over both ends of each edge."""
    ends = edges.select(F.col("src").alias("node"), F.col("dst").alias("partner"), F.lit("out").alias("way"), "weight").union(edges.select("dst", "src", F.lit("in"), "weight"))
    per = ends.groupBy("node", "partner").agg(F.sum("weight").alias("w"), F.count(F.when(F.col("way") == "out", 1)).alias("o"), F.count(F.when(F.col("way") == "in", 1)).alias("i"))
    return per.groupBy("node").agg(F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree"), F.count("*").alias("partners"), F.min_by("partner", F.struct((-F.col("w")).alias("w"), "partner")).alias("top_partner"), F.sum("w").alias("total"))


def influencers(metrics: DataFrame, names: list[str], k: int) -> DataFrame:
    """Score of metrics, each as part of its maximum, by the shares of BLEND; metrics that are absent or null add nothing."""
    metrics = cut(metrics)  # read twice, made once
    top = metrics.agg(*[F.max(n).alias(f"_{n}") for n in names])  # one row
    score = sum((ratio(n, f"_{n}") * BLEND[n] for n in names[1:]), ratio(names[0], f"_{names[0]}") * BLEND[names[0]])
    return metrics.join(F.broadcast(top)).select("node", F.round(score * 100.0, 2).alias("influence_score")).orderBy(F.desc("influence_score"), "node").limit(k)
