"""Entity mentions bound to parts, orders and documents; vectors to embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import company_name, core_name, initials, spelling
from tessera.operators import entity as E
from tessera.operators import vectors as V

from .registry import query, table

NAME = "initcap(p_name) || CASE p_partkey % 6 WHEN 0 THEN ', Inc.' WHEN 1 THEN ' Corporation' WHEN 2 THEN ' Holdings, Inc.' WHEN 3 THEN '  LLC' WHEN 4 THEN ' & Co' ELSE '' END"
DNAME = NAME.replace("initcap(p_name)", "array_to_string(list_transform(string_split(p_name, ' '), lambda x: upper(left(x, 1)) || substring(x, 2)), ' ')")


def named(spark, d) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", F.expr(NAME).alias("name"), "p_type", "p_brand", "p_size")


def strip_sql(x: str) -> str:
    from tessera.functions.text import SUFFIXES

    x = f"trim(lower({x}))"
    for s in SUFFIXES:
        x = f"regexp_replace({x}, '{s}', '')"
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


@query("STR-01 STR-04", f"SELECT p_partkey, {strip_sql(DNAME)} AS normal FROM part")
def name_normalise(spark, d):
    return named(spark, d).select("p_partkey", company_name("name").alias("normal"))


@query("STR-02 STR-03 STR-06", f"""WITH n AS (SELECT p_partkey, {DNAME} AS name FROM part), a AS (SELECT p_partkey, name, trim(regexp_replace(regexp_replace(regexp_replace(lower(name), '[.,;!?]', '', 'g'), '\\s+({'|'.join(E.SUFFIX_WORDS)})\\b', '', 'g'), '\\s+', ' ', 'g')) AS c FROM n)
 SELECT p_partkey, trim(regexp_replace(c, '^the\\s+', '')) AS core, trim(regexp_replace(regexp_replace(replace(lower(name), '&', 'and'), '[^a-z0-9\\s]', '', 'g'), '\\s+', ' ', 'g')) AS spelling, array_to_string(list_transform(string_split(trim(regexp_replace(name, '\\s+', ' ', 'g')), ' '), lambda x: upper(left(x, 1))), '') AS initials FROM a""")
def core_names(spark, d):
    return named(spark, d).select("p_partkey", core_name("name", E.SUFFIX_WORDS).alias("core"), spelling("name").alias("spelling"), initials("name").alias("initials"))


@query("STR-04", f"WITH n AS (SELECT p_partkey, upper(replace(replace({DNAME}, ',', ''), '.', '')) AS k FROM part) SELECT DISTINCT p_partkey, k || s AS variant FROM n, (VALUES (''), (' INC'), (' CORP'), (' LLC')) v(s)")
def name_variants(spark, d):
    k = F.upper(F.replace(F.replace("name", F.lit(","), F.lit("")), F.lit("."), F.lit("")))
    return named(spark, d).select("p_partkey", F.explode(F.array_distinct(F.array(*[F.concat(k, F.lit(s)) for s in ("", " INC", " CORP", " LLC")]))).alias("variant"))


@query("MLV-06", f"WITH n AS (SELECT p_brand, {DNAME} AS name, p_partkey FROM part) SELECT p_brand, name AS canonical_name FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY CASE WHEN lower(name) NOT IN ({', '.join(repr(g) for g in E.GENERIC)}) AND length(name) > 2 THEN length(name) ELSE -1 END DESC, p_partkey) AS r FROM n) WHERE r = 1")
def canonical_filing_name(spark, d):
    return E.canonical_name(named(spark, d), "p_brand", "name", "p_partkey")


MENT = "m AS (SELECT l_orderkey AS doc, l_partkey % 50 AS pos, CASE l_returnflag WHEN 'A' THEN 'bert' WHEN 'N' THEN 'biobert' ELSE 'finbert' END AS model, l_discount AS score FROM lineitem), u AS (SELECT doc, pos, model, max(score) AS score FROM m GROUP BY 1, 2, 3)"


def found_mentions(spark, d) -> DataFrame:
    model = F.when(F.col("l_returnflag") == "A", "bert").when(F.col("l_returnflag") == "N", "biobert").otherwise("finbert")
    m = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc"), (F.col("l_partkey") % 50).alias("pos"), model.alias("model"), F.col("l_discount").alias("score"))
    return m.groupBy("doc", "pos", "model").agg(F.max("score").alias("score"))


@query("MLV-08", f"WITH {MENT} SELECT doc, pos, max(score) AS score, first(model ORDER BY score DESC, model DESC) AS model, string_agg(model, ',' ORDER BY model) AS models, count(*) AS n_models FROM u GROUP BY 1, 2")
def position_merge(spark, d):
    return E.merge_positions(found_mentions(spark, d), ["doc", "pos"], "score", "model")


@query("MLV-07", f"WITH {MENT} SELECT pos, string_agg(DISTINCT model, '|' ORDER BY model) AS mentions, max(score) AS confidence, count(*) AS n FROM u GROUP BY 1")
def group_merge(spark, d):
    return E.merge_groups(found_mentions(spark, d), ["pos"], "model", "score")


@query("MLV-07", f"WITH {MENT} SELECT pos, model, count(DISTINCT doc) AS documents FROM u GROUP BY 1, 2 HAVING count(DISTINCT doc) > 1")
def cross_document(spark, d):
    return E.cross_document(found_mentions(spark, d), ["pos", "model"], "doc")


@query("MTH-17 MTH-18", f"WITH {MENT}, q AS (SELECT doc, pos, max(score) AS s, count(*) AS n FROM u GROUP BY 1, 2) SELECT doc, pos, least(s + CASE WHEN pos % 2 = 0 THEN 0.1::DOUBLE ELSE 0 END + least(n * 0.02::DOUBLE, 0.1), 1.0) AS quality, least(s + CASE WHEN n > 1 THEN (n - 1) * 0.1::DOUBLE ELSE 0 END, 1.0) AS consensus FROM q")
def quality_score(spark, d):
    q = found_mentions(spark, d).groupBy("doc", "pos").agg(F.max("score").alias("s"), F.count("*").alias("n"))
    return q.select("doc", "pos", E.quality(F.col("s"), F.col("pos") % 2 == 0, F.col("n")).alias("quality"), E.consensus_quality(F.col("s"), F.col("n")).alias("consensus"))


KINDS = "CASE p_partkey % 5 WHEN 0 THEN 'Date' WHEN 1 THEN 'Law' WHEN 2 THEN 'ORG' WHEN 3 THEN 'Drug' ELSE 'Thing' END"
TEXTS = "CASE p_partkey % 4 WHEN 0 THEN 'Section 3' WHEN 1 THEN 'Hart-Scott-Rodino Section 7' WHEN 2 THEN 'Litigation' ELSE p_name END"


@query("FIL-11 FIL-12 FIL-14", f"""WITH t AS (SELECT p_partkey, {KINDS} AS label, {TEXTS} AS text FROM part) SELECT p_partkey, CASE label WHEN 'ORG' THEN 'ORGANIZATION' WHEN 'Drug' THEN 'MEDICATION' ELSE upper(label) END AS kind FROM t
 WHERE NOT (label IN ('Date', 'Money') OR (label = 'Law' AND (regexp_matches(text, 'Securities Act of 1933|Exchange Act|Section ') OR lower(text) IN ('legal proceedings', 'litigation')) AND NOT contains(text, 'Hart-Scott-Rodino')))""")
def entity_filter(spark, d):
    rows = table(spark, d, "part").select("p_partkey", F.expr(KINDS).alias("label"), F.expr(TEXTS).alias("text"))
    return rows.where(~E.is_noise(F.col("label"), F.col("text"))).select("p_partkey", E.normal_type(F.col("label")).alias("kind"))


@query("FIL-12", f"WITH {MENT} SELECT doc, pos, model FROM u WHERE CASE model WHEN 'biobert' THEN CAST(pos % 3 AS STRING) <> '0' WHEN 'finbert' THEN (CASE WHEN pos % 4 = 0 THEN 'year' ELSE 'x' END) NOT IN ('company', 'year') ELSE pos % 5 <> 0 END AND score >= 0.05")
def model_filters(spark, d):
    m = found_mentions(spark, d)
    kind = F.when(F.col("model") == "bert", F.when(F.col("pos") % 5 == 0, "MISC").otherwise("x")).otherwise((F.col("pos") % 3).cast("string"))
    return m.where(E.passes(F.col("model"), F.when(F.col("pos") % 4 == 0, "Year").otherwise("x"), kind, F.col("score"), 0.05)).select("doc", "pos", "model")


@query("FIL-13", """WITH s AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN '10-K' WHEN 1 THEN '8-k' ELSE 'S-1' END AS ft, CASE WHEN p_partkey % 2 = 0 THEN 'Financial Statements' ELSE p_name END AS sec FROM part) SELECT p_partkey, unnest(CASE WHEN ft IN ('10-K', '10-Q') AND regexp_matches(lower(sec), 'financial|statement') THEN ['finbert'] WHEN ft = '8-k' THEN ['biobert', 'bert_base', 'roberta', 'finbert'] ELSE ['bert_base', 'roberta', 'biobert'] END) AS model FROM s""")
def section_routing(spark, d):
    k = F.col("p_partkey")
    rows = table(spark, d, "part").select(k, F.when(k % 3 == 0, "10-K").when(k % 3 == 1, "8-k").otherwise("S-1").alias("ft"), F.when(k % 2 == 0, "Financial Statements").otherwise(F.col("p_name")).alias("sec"))
    return rows.select("p_partkey", F.explode(E.route(F.col("ft"), F.col("sec"))).alias("model"))


@query("AGG-24 MTH-18", """WITH s AS (SELECT l_suppkey, avg(l_discount * 1000)::DOUBLE AS d, 1 AS one FROM lineitem GROUP BY 1), x AS (SELECT l_suppkey, (l_suppkey % 41 + 60)::DOUBLE AS c, (l_suppkey % 37 + 63)::DOUBLE AS p, (l_suppkey % 29 + 70)::DOUBLE AS r, (l_suppkey % 11 * 10)::DOUBLE AS dl, (l_suppkey % 7 + 90)::DOUBLE AS se, (l_suppkey % 13)::DOUBLE AS h FROM s),
 y AS (SELECT l_suppkey, c * 0.15::DOUBLE + p * 0.30::DOUBLE + r * 0.25::DOUBLE + dl * 0.20::DOUBLE + se * 0.05::DOUBLE + (100.0 - h) * 0.05::DOUBLE AS score FROM x) SELECT *, CASE WHEN score >= 90 THEN 'A' WHEN score >= 80 THEN 'B' WHEN score >= 70 THEN 'C' WHEN score >= 60 THEN 'D' ELSE 'F' END AS grade FROM y""")
def pipeline_grades(spark, d):
    k = F.col("l_suppkey")
    s = table(spark, d, "lineitem").select("l_suppkey").distinct()
    score, grade = E.pipeline_score(*[(x).cast("double") for x in (k % 41 + 60, k % 37 + 63, k % 29 + 70, k % 11 * 10, k % 7 + 90, k % 13)])
    return s.select("l_suppkey", score.alias("score"), grade.alias("grade"))


def misspelled(n: DataFrame) -> DataFrame:
    """Names as others write them: a letter doubled, dropped or changed, or as they are."""
    k = F.col("p_partkey") % 4
    at = (F.col("p_partkey") % F.length("name") + 1).cast("int")
    head, rest = F.substring("name", F.lit(1), at - 1), F.substring("name", at + 1, F.length("name"))
    letter = F.substring("name", at, F.lit(1))
    return n.select(F.when(k == 0, F.concat(head, letter, letter, rest)).when(k == 1, F.concat(head, rest)).when(k == 2, F.concat(head, F.lit("q"), rest)).otherwise(F.col("name")).alias("name"))


@query("JON-07 STR-05")
def fuzzy_resolve(spark, d):
    n = named(spark, d)
    return E.fuzzy_best(misspelled(n).distinct(), n.select("name", F.col("p_partkey").alias("entity")), "name", "entity")


@query("UPS-03 GRF-14")
def resolve_cascade(spark, d):
    n = named(spark, d)
    known = n.select("name", F.col("p_partkey").alias("entity"))
    return E.resolve(misspelled(n).union(table(spark, d, "supplier").select(F.col("s_name"))), known, known, "name", "entity")


@query("MLV-05 STR-06")
def greedy_groups(spark, d):
    return E.greedy_groups(named(spark, d).withColumn("score", (F.col("p_size") / 50.0)), ["p_type"], "name", "score")


DOT = "list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) / (sqrt(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(a.embedding AS DOUBLE[]))) * sqrt(list_dot_product(CAST(b.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))))"


@query("MLV-01 JON-09", f"SELECT query, vec_id, similarity, place::INT AS place FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY similarity DESC, vec_id) AS place FROM (SELECT b.vec_id AS query, a.vec_id, round({DOT}, 6) AS similarity FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE b.vec_id % 50 = 0)) WHERE place <= 5")
def cosine_topk(spark, d):
    e = table(spark, d, "embeddings")
    return V.cosine_top(e, e.where("vec_id % 50 = 0"), "vec_id", "embedding", 5)


@query("MLV-02", f"WITH n AS (SELECT a.vec_id, min(b.vec_id) AS found FROM embeddings a JOIN embeddings b ON b.vec_id < a.vec_id AND {DOT} >= 0.8 GROUP BY 1) SELECT e.vec_id, coalesce(found, e.vec_id) AS keyword, found IS NOT NULL AS reused FROM embeddings e LEFT JOIN n ON n.vec_id = e.vec_id")
def keyword_reuse(spark, d):
    return V.reuse(table(spark, d, "embeddings"), "vec_id", "embedding")


@query("MLV-03")
def kmeans_topics(spark, d):
    return E.kmeans_topics(table(spark, d, "embeddings"), "vec_id", "embedding")


TOPICS = {"alpha": ["tion", "ment"], "beta": ["heit", "und "], "gamma": ["para"]}
HITS = " UNION ALL ".join("SELECT source, '%s' AS topic, %s AS h FROM documents" % (n, " + ".join(f"contains(lower(text), '{w}')::INT" for w in ws)) for n, ws in TOPICS.items())


@query("MLV-04", f"WITH h AS ({HITS}), g AS (SELECT source, topic, sum(h)::BIGINT AS votes FROM h GROUP BY 1, 2) SELECT source, CASE WHEN votes = 0 THEN 'Other' ELSE topic END AS topic, votes FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY votes DESC, topic) AS r FROM g) WHERE r = 1")
def cluster_vote_labels(spark, d):
    return E.vote_labels(table(spark, d, "documents"), "source", "text", TOPICS)
