"""Interaction graph bound to events: a user answers, mentions or shares others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import graph as G
from tessera.operators import network as N

from .registry import query, table

E0 = """people AS (SELECT max(user_id) + 1 AS users FROM events), i AS (SELECT user_id AS src, (user_id * 7 + CAST(props->>'$.k' AS BIGINT) % 10) % users AS dst, CASE event_type WHEN 'click' THEN 'reply' WHEN 'purchase' THEN 'retweet' ELSE 'mention' END AS kind FROM events, people),
 e AS (SELECT src, dst, sum(CASE kind WHEN 'retweet' THEN 2 ELSE 1 END)::BIGINT AS weight FROM i WHERE src <> dst GROUP BY 1, 2 HAVING sum(CASE kind WHEN 'retweet' THEN 2 ELSE 1 END) >= 3)"""
WITH = f"WITH RECURSIVE {E0}"


def edges(spark, d, least: int = 3) -> DataFrame:
    """Each user answers, mentions or shares up to ten others; the graph grows with the users."""
    k = F.get_json_object("props", "$.k").cast("long")
    kind = F.when(F.col("event_type") == "click", "reply").when(F.col("event_type") == "purchase", "retweet").otherwise("mention")
    e = table(spark, d, "events")
    users = e.agg((F.max("user_id") + 1).alias("users"))  # one row
    i = e.join(F.broadcast(users)).select(F.col("user_id").alias("src"), ((F.col("user_id") * 7 + k % 10) % F.col("users")).alias("dst"), kind.alias("kind"))
    return G.build_edges(i, least)


@query("GRF-01 GRF-09", f"{WITH} SELECT * FROM e")
def build_edges(spark, d):
    return edges(spark, d)


@query("GRF-02 GRF-03", WITH + """, b AS (SELECT src AS node, 1 AS o, 0 AS i, weight FROM e UNION ALL SELECT dst, 0, 1, weight FROM e), g AS (SELECT node, sum(o)::BIGINT AS out_degree, sum(i)::BIGINT AS in_degree, sum(weight)::BIGINT AS strength FROM b GROUP BY 1)
 SELECT *, in_degree::DOUBLE / (count(*) OVER () - 1) AS in_centrality, out_degree::DOUBLE / (count(*) OVER () - 1) AS out_centrality FROM g""")
def degree_stats(spark, d):
    return G.degrees(edges(spark, d))


@query("GRF-05", WITH + """, b AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e), r AS (SELECT src AS node, src AS c FROM b UNION SELECT b.dst, r.c FROM r JOIN b ON b.src = r.node) SELECT node, min(c) AS component FROM r GROUP BY 1""")
def wcc(spark, d):
    return G.components(edges(spark, d))


REACH = WITH + """, r AS (SELECT 1::BIGINT AS node, 0 AS level, [1::BIGINT] AS path WHERE EXISTS (SELECT 1 FROM e WHERE src = 1 OR dst = 1) UNION ALL SELECT e.dst, r.level + 1, list_append(path, e.dst) FROM r JOIN e ON e.src = r.node WHERE r.level < 3),
 s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY level, path) AS n FROM r) WHERE n = 1)"""


@query("GRF-06", REACH + " SELECT node, level, array_to_string(path, '>') AS path FROM s")
def bfs_reach(spark, d):
    return G.reach(edges(spark, d), 1).select("node", "level", F.array_join("path", ">").alias("path"))


@query("GRF-06", REACH + ", h AS (SELECT dst FROM e GROUP BY 1 HAVING count(*) > 5) SELECT node AS target, array_to_string(path, '>') AS path, level AS length FROM s WHERE node IN (SELECT dst FROM h) ORDER BY level, node LIMIT 5")
def hub_paths(spark, d):
    return G.hub_paths(edges(spark, d), 1).select("target", F.array_join("path", ">").alias("path"), "length")


@query("GRF-05", WITH + """, y AS (SELECT src, dst, sum(weight)::DOUBLE AS w FROM (SELECT src, dst, weight FROM e UNION ALL SELECT dst, src, weight FROM e) GROUP BY 1, 2), v AS (SELECT DISTINCT src AS node FROM y), z AS (SELECT * FROM y UNION ALL SELECT node, node, 1.0 FROM v),
 l AS (SELECT 0 AS k, node, node AS community FROM v UNION ALL SELECT k, node, community FROM (SELECT k + 1 AS k, src AS node, community, row_number() OVER (PARTITION BY src ORDER BY sum(w) DESC, community) AS n FROM z JOIN l ON l.node = z.dst WHERE k < 10 GROUP BY k, src, community) WHERE n = 1) SELECT node, community FROM l WHERE k = 10""")
def label_communities(spark, d):
    return G.label_propagation(edges(spark, d))


@query("GRF-08", WITH + """, b AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e), r AS (SELECT src AS node, src AS c FROM b UNION SELECT b.dst, r.c FROM r JOIN b ON b.src = r.node), w AS (SELECT node, min(c) AS component FROM r GROUP BY 1),
 s AS (SELECT (SELECT count(*) FROM w) AS nodes, (SELECT count(*) FROM e) AS edges, (SELECT count(DISTINCT component) FROM w) AS components) SELECT *, edges::DOUBLE / (nodes * (nodes - 1)) AS density, edges * 2::DOUBLE / nodes AS average_degree FROM s""")
def network_stats(spark, d):
    return G.stats(edges(spark, d))


@query("GRF-08", WITH + """, u AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM e), s AS (SELECT a AS x, b AS y FROM u UNION ALL SELECT b, a FROM u), dg AS (SELECT x AS node, count(*) AS deg FROM s GROUP BY 1), t AS (SELECT p.x AS node, count(*) AS t FROM s p JOIN s q ON q.x = p.x AND p.y < q.y JOIN u ON u.a = p.y AND u.b = q.y GROUP BY 1)
 SELECT dg.node, coalesce(t, 0) AS triangles, coalesce(coalesce(t, 0) * 2::DOUBLE / nullif(deg * (deg - 1), 0), 0.0) AS clustering FROM dg LEFT JOIN t ON t.node = dg.node""")
def clustering(spark, d):
    return G.clustering(edges(spark, d))


@query("GRF-10", f"{WITH} SELECT dst, weight FROM e WHERE src = 1 ORDER BY weight DESC, dst LIMIT 10")
def ego_top(spark, d):
    return G.ego(edges(spark, d), 1)


@query("GRF-11", f"{WITH} SELECT src, dst, weight, 'forward' AS direction FROM e UNION ALL SELECT dst, src, weight, 'reverse' FROM e")
def dual_edges(spark, d):
    return G.dual(edges(spark, d))


@query("GRF-12 SET-06", """WITH m AS (SELECT l_suppkey AS src, l_partkey % 20 AS dst, l_orderkey * 10 + l_linenumber AS ord, l_returnflag || l_linestatus AS note, l_returnflag AS tag, row_number() OVER (PARTITION BY l_suppkey, l_partkey % 20 ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity) AS k FROM lineitem)
 SELECT src, dst, count(*) AS mention_count, string_agg(CASE WHEN k = 1 THEN note ELSE '[Mention ' || k || '] ' || note END, ' ' ORDER BY k) AS summary, array_to_string(list_sort(list(DISTINCT tag)), ',') AS tags FROM m GROUP BY 1, 2""")
def edge_merge(spark, d):
    m = table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("src"), (F.col("l_partkey") % 20).alias("dst"), F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity").alias("ord"), F.concat("l_returnflag", "l_linestatus").alias("note"), F.col("l_returnflag").alias("tag"),
    )
    return G.merge_edges(m, ["src", "dst"], "ord", "note", "tag")


@query("GRF-13", """WITH m AS (SELECT l_partkey AS node, l_orderkey * 10 + l_linenumber AS id, l_discount AS score, l_returnflag AS flag FROM lineitem), b AS (SELECT *, row_number() OVER (PARTITION BY node ORDER BY score DESC, id, flag) AS r FROM (SELECT DISTINCT * FROM m)) SELECT node, score FROM b WHERE r = 1 AND node NOT IN (SELECT p_partkey FROM part WHERE p_size > 25)""")
def promote_nodes(spark, d):
    m = table(spark, d, "lineitem").select(F.col("l_partkey").alias("node"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_discount").alias("score"))
    return G.promote(m, table(spark, d, "part").where("p_size > 25").select(F.col("p_partkey").alias("node")), "node", "score", "id").select("node", "score")


@query("GRF-15", WITH + """, x AS (SELECT src AS node, dst AS partner, 1 AS o, 0 AS i, weight FROM e UNION ALL SELECT dst, src, 0, 1, weight FROM e), p AS (SELECT node, partner, sum(weight)::BIGINT AS w, sum(o)::BIGINT AS o, sum(i)::BIGINT AS i FROM x GROUP BY 1, 2)
 SELECT node, sum(o)::BIGINT AS out_degree, sum(i)::BIGINT AS in_degree, count(*) AS partners, first(partner ORDER BY w DESC, partner) AS top_partner, sum(w)::BIGINT AS total FROM p GROUP BY 1""")
def entity_graph_stats(spark, d):
    return G.entity_stats(edges(spark, d))


RANKS = WITH + """, v AS (SELECT src AS node FROM e UNION SELECT dst FROM e), c AS (SELECT count(*)::DOUBLE AS n FROM v), o AS (SELECT src, sum(weight)::DOUBLE AS t FROM e GROUP BY 1), p AS (SELECT e.src, e.dst, e.weight / o.t AS p FROM e JOIN o ON o.src = e.src UNION ALL SELECT node, node, 0.0 FROM v),
 r AS (SELECT 0 AS k, node, 1.0::DOUBLE / n AS r, 1.0::DOUBLE / n AS before, n AS moved, n FROM v, c UNION ALL SELECT k, node, r, CASE WHEN k % 10 = 0 THEN r ELSE before END, CASE WHEN k % 10 = 0 THEN sum(abs(r - before)) OVER () ELSE n END, n FROM
 (SELECT any_value(k) + 1 AS k, p.dst AS node, 0.15::DOUBLE / any_value(n) + 0.85::DOUBLE * sum(r.r * p.p) AS r, max(CASE WHEN r.node = p.dst THEN before END) AS before, any_value(n) AS n FROM r JOIN p ON p.src = r.node WHERE k < 100 AND moved >= n * 1e-6 GROUP BY p.dst))
 SELECT node, round(r / sum(r) OVER (), 9) AS pagerank FROM r WHERE k = (SELECT max(k) FROM r)"""


@query("GRF-03", RANKS)
def pagerank(spark, d):
    return G.pagerank(edges(spark, d)).select("node", F.round("pagerank", 9).alias("pagerank"))


@query("GRF-04 WIN-28")
def influencers(spark, d):
    return G.influencers(N.centrality(edges(spark, d)), list(G.BLEND), 20)


@query("GRF-03")
def centrality(spark, d):
    return N.centrality(edges(spark, d))


def _cut_nodes_sql(least: int) -> str:
    """By removal: an edge is a bridge if its ends part without it, a node an articulation if its neighbours part without it."""
    strong = E0.replace(">= 3)", f">= {least})")
    return f"""WITH RECURSIVE {strong}, u AS (SELECT row_number() OVER () AS id, a, b FROM (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM e)), s AS MATERIALIZED (SELECT id, a AS x, b AS y FROM u UNION ALL SELECT id, b, a FROM u),
 r AS (SELECT id, a AS node FROM u UNION SELECT r.id, s.y FROM r JOIN s ON s.x = r.node AND s.id <> r.id), g AS (SELECT u.* FROM u WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.id = u.id AND r.node = u.b)),
 q AS (SELECT x AS gone, min(y) AS node FROM s GROUP BY 1 UNION SELECT q.gone, s.y FROM q JOIN s ON s.x = q.node AND s.y <> q.gone), t AS (SELECT DISTINCT s.x AS node FROM s WHERE NOT EXISTS (SELECT 1 FROM q WHERE q.gone = s.x AND q.node = s.y))
 SELECT v.node, (SELECT count(*) FROM g WHERE g.a = v.node OR g.b = v.node) AS bridge_ends, v.node IN (SELECT node FROM t) AS articulation FROM (SELECT DISTINCT x AS node FROM s) v"""


@query("GRF-07", _cut_nodes_sql(3))
def bridges(spark, d):
    return N.cut_nodes(edges(spark, d)).drop("blocks")


@query("GRF-07", _cut_nodes_sql(12))
def strong_bridges(spark, d):
    """The same among ties of weight 12 and more, which hang together more loosely."""
    return N.cut_nodes(edges(spark, d, 12)).drop("blocks")


@query("GRF-05")
def communities(spark, d):
    return N.louvain(edges(spark, d))
