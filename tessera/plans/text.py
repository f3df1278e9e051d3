"""Filings and pages: documents with a generated head whose words the rules look for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import money
from tessera.operators import filings as T

from .registry import query, table

HEAD = """'FILED AS OF DATE: 2023' || lpad(CAST(doc_id % 12 + 1 AS STRING), 2, '0') || '15 SIC code ' || CAST(2830 + doc_id % 20 AS STRING) || '. Item 1A. Risk Factors ' || CASE doc_id % 4
 WHEN 0 THEN 'We have a going concern note; debt may default and a supply chain shortage is a risk.' WHEN 1 THEN 'Clinical trial, drug therapy and FDA approval risk; competitor pricing and market share decline.'
 WHEN 2 THEN 'Litigation over a patent; total revenue: $' || CAST(doc_id % 900 + 1 AS STRING) || ' million and net income: $5. Up 12%.' ELSE 'Growth opportunity in technology and innovation since 2019.' END
 || ' U.S. Patent No. 9,' || lpad(CAST(doc_id % 1000 AS STRING), 3, '0') || ',123. Smith et al., 2019. Item 2. ' || text"""
VIEW = f"filings AS (SELECT doc_id, source AS industry, doc_id % 40 AS company, doc_id % 5 AS period, {HEAD} AS text FROM documents)"


def filings(spark, d) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.col("source").alias("industry"), F.expr("doc_id % 40").alias("company"), F.expr("doc_id % 5").alias("period"), F.expr(HEAD).alias("text"))


def hits(t: str, ws: list[str]) -> str:
    return "(" + " + ".join(f"contains({t}, '{w}')::INT" for w in ws) + ")"


def occ(t: str, w: str) -> str:
    return f"least((length({t}) - length(replace({t}, '{w}', ''))) // {len(w)} * 5, 30)"


RISK = " UNION ALL ".join(f"SELECT doc_id, industry, company, period, '{c}' AS category, least({hits('t', T.CRITICAL)} * 20 + {' + '.join(occ('t', w) for w in ws)} + {hits('t', T.NEGATIVE)} * 3, 100)::DOUBLE AS score FROM l" for c, ws in T.CATEGORIES.items())
SCORES = f"WITH {VIEW}, l AS (SELECT *, lower(text) AS t FROM filings), r AS ({RISK})"


@query("MTH-13 STR-08", SCORES + " SELECT doc_id, category, score FROM r")
def risk_scores(spark, d):
    return T.risk_scores(filings(spark, d), ["doc_id"], "text")


PATTERNS = [("financial", "debt", 10.0, 1.5), ("financial", "Shortage", 20.0, 1.0), ("regulatory", "FDA", 30.0, 1.2), ("legal", "patent", 15.0, 2.0), ("legal", "Litigation", 25.0, 1.1)]
PVALUES = ", ".join(f"('{c}', '{k}', {b}::DOUBLE, {w}::DOUBLE)" for c, k, b, w in PATTERNS)


@query("MTH-14", f"""WITH {VIEW}, l AS (SELECT *, lower(text) AS t FROM filings), p(category, keyword, base_score, weight) AS (VALUES {PVALUES}), s AS (SELECT doc_id, category, CAST(sum(CAST(base_score * weight AS DECIMAL(18,4))) AS DOUBLE) AS s FROM l JOIN p ON contains(t, lower(keyword)) GROUP BY 1, 2)
 SELECT l.doc_id, c.category, least(greatest(coalesce(s, 0.0), CASE WHEN contains(t, 'bankruptcy') THEN 95.0 WHEN contains(t, 'going concern') THEN 90.0 WHEN contains(t, 'substantial doubt') THEN 85.0 ELSE 0.0 END), 100.0)::DOUBLE AS score FROM l CROSS JOIN (SELECT DISTINCT category FROM p) c LEFT JOIN s ON s.doc_id = l.doc_id AND s.category = c.category""")
def absolute_score(spark, d):
    patterns = spark.createDataFrame(PATTERNS, "category string, keyword string, base_score double, weight double")
    return T.pattern_scores(filings(spark, d), patterns, "doc_id", "text")


@query("WIN-23", SCORES + """ SELECT doc_id, category, CASE WHEN count(*) OVER (PARTITION BY industry, category) = 1 THEN 50.0::DOUBLE ELSE (rank() OVER (PARTITION BY industry, category ORDER BY score) - 1)::DOUBLE / count(*) OVER (PARTITION BY industry, category) * 100.0::DOUBLE END AS percentile FROM r""")
def relative_percentile(spark, d):
    s = T.risk_scores(filings(spark, d), ["doc_id", "industry"], "text")
    return T.relative_percentile(s, ["industry", "category"], "score").select("doc_id", "category", "percentile")


@query("WIN-22", SCORES + " SELECT doc_id, category, coalesce(score - lag(score) OVER (PARTITION BY company, category ORDER BY doc_id), 0.0) AS momentum FROM r")
def score_momentum(spark, d):
    s = T.risk_scores(filings(spark, d), ["doc_id", "company"], "text")
    return T.momentum(s, ["company", "category"], ["doc_id"], "score").select("doc_id", "category", "momentum")


@query("AGG-25 AGG-31", SCORES + " SELECT category, count(*) FILTER (WHERE score > 70) AS high, count(*) FILTER (WHERE score > 30) AS noted, max(score) AS top FROM r GROUP BY 1")
def risk_summary(spark, d):
    s = T.risk_scores(filings(spark, d), ["doc_id"], "text")
    return s.groupBy("category").agg(F.count(F.when(F.col("score") > 70, 1)).alias("high"), F.count(F.when(F.col("score") > 30, 1)).alias("noted"), F.max("score").alias("top"))


@query("MTH-15 STR-31", f"""WITH {VIEW}, l AS (SELECT doc_id, lower(text) AS t FROM filings) SELECT doc_id, CASE WHEN length(t) < 100 THEN 0.3::DOUBLE WHEN length(t) < 500 THEN 0.6 WHEN {hits('t', ['risk', 'uncertain', 'may', 'could', 'potential'])} > 5 THEN 0.9 WHEN {hits('t', ['risk', 'uncertain', 'may', 'could', 'potential'])} > 2 THEN 0.7 ELSE 0.5 END AS confidence,
 array_to_string(list_filter([CASE WHEN contains(t, 'debt') THEN 'debt obligations' END, CASE WHEN contains(t, 'liquidity') THEN 'liquidity concerns' END, CASE WHEN contains(t, 'cash flow negative') THEN 'negative cash flow' END, CASE WHEN contains(t, 'fda') THEN 'regulatory risk' END, CASE WHEN contains(t, 'clinical trial') THEN 'clinical trial risk' END, CASE WHEN {hits('t', ['mitigate', 'reduce', 'manage', 'hedge', 'insurance'])} > 0 THEN 'mitigated' END], lambda x: x IS NOT NULL), ',') AS factors FROM l""")
def risk_factors(spark, d):
    return filings(spark, d).select("doc_id", T.confidence("text").alias("confidence"), F.array_join(T.risk_factors("text"), ",").alias("factors"))


STRIDE = "c AS (SELECT doc_id, unnest(range(0, length(text), 1800)) AS start, text FROM filings), k AS (SELECT doc_id, (start // 1800)::INT AS chunk, start::INT AS start, substring(text, CAST(start + 1 AS BIGINT), 2000) AS text FROM c)"


@query("STR-19", f"WITH {VIEW}, {STRIDE} SELECT doc_id, chunk, start, md5(text) AS digest FROM k")
def stride_chunks(spark, d):
    return T.stride_chunks(filings(spark, d), "doc_id", "text").select("doc_id", "chunk", "start", F.md5(F.col("text").cast("binary")).alias("digest"))


@query("MTH-16", f"""WITH {VIEW}, {STRIDE}, l AS (SELECT *, lower(text) AS t FROM k), s AS (SELECT doc_id, chunk, CASE WHEN {hits('t', T.CRITICAL)} > 0 THEN least({hits('t', T.CRITICAL)} * 25, 100) ELSE least({hits('t', ['risk', 'uncertain', 'adverse', 'decline', 'loss'])} * 10, 50) END AS s FROM l),
 g AS (SELECT doc_id, CAST(sum(s) AS DOUBLE) / count(*) AS mean, max(s) AS top, arg_max(s, chunk) AS last, arg_min(s, chunk) AS first FROM s GROUP BY 1) SELECT doc_id, CASE WHEN mean >= 60 THEN 'consensus_risk' WHEN mean >= 10 THEN 'emerging_risk' ELSE 'low_risk' END AS tier, top AS max_score, mean * 0.33::DOUBLE + top * 0.34::DOUBLE + (last - first) * 0.33::DOUBLE AS score FROM g""")
def chunk_risk_v2(spark, d):
    return T.chunk_risk(T.stride_chunks(filings(spark, d), "doc_id", "text"), "doc_id", "chunk", "text")


def themes_sql() -> str:
    parts = []
    for theme, ws in T.THEMES.items():
        lists = ", ".join(f"CASE WHEN contains(t, '{w}') THEN regexp_extract_all(t, '.{{0,100}}{w}.{{0,100}}') ELSE [] END" for w in ws)
        parts.append(f"SELECT doc_id, industry, company, period, '{theme}' AS theme, flatten([{lists}]) AS m FROM l")
    return f"WITH {VIEW}, l AS (SELECT *, lower(text) AS t FROM filings), x AS ({' UNION ALL '.join(parts)}), w AS (SELECT *, array_to_string(m, ' ') AS w FROM x WHERE len(m) > 0), tm AS (SELECT doc_id, industry, company, period, theme, len(m) AS mention_count, CASE WHEN {hits('w', T.TONE_DOWN)} > {hits('w', T.TONE_UP)} THEN -0.5::DOUBLE WHEN {hits('w', T.TONE_UP)} > {hits('w', T.TONE_DOWN)} THEN 0.5 ELSE 0.0 END AS sentiment FROM w)"


THEMES = themes_sql()


def mentions(spark, d) -> DataFrame:
    return T.theme_mentions(filings(spark, d), ["doc_id", "industry", "company", "period"], "text")


@query("STR-11", THEMES + " SELECT doc_id, theme, mention_count, sentiment FROM tm")
def theme_mentions(spark, d):
    return mentions(spark, d).select("doc_id", "theme", "mention_count", "sentiment")


ENV = THEMES + """, tot AS (SELECT industry, count(DISTINCT company) AS a FROM tm GROUP BY 1), g AS (SELECT industry, theme, count(DISTINCT company) AS companies, sum(mention_count)::BIGINT AS mentions, count(*) AS rows, CAST(sum(CAST(sentiment AS DECIMAL(18,4))) AS DOUBLE) AS tone FROM tm GROUP BY 1, 2),
 env AS (SELECT g.industry, theme, companies, mentions, companies::DOUBLE / a AS coverage, CASE WHEN companies::DOUBLE / a > 0.6 THEN 'consensus' WHEN companies::DOUBLE / a > 0.1 THEN 'emerging' ELSE 'unique' END AS tier, tone / mentions AS sentiment_per_mention, tone / rows AS mean_sentiment FROM g JOIN tot ON tot.industry = g.industry)"""


@query("AGG-26 AGG-33", ENV + " SELECT * FROM env")
def environment(spark, d):
    return T.environment(mentions(spark, d), "industry", "company")


@query("AGG-27", ENV + """, p AS (SELECT industry, company, count(DISTINCT theme) AS n FROM tm GROUP BY 1, 2), s AS (SELECT industry, round(coalesce(stddev_pop(n) / nullif(avg(n), 0), 0.0), 6) AS dispersion FROM p GROUP BY 1) SELECT s.industry, dispersion, coalesce(c, 0.0) AS consensus_strength FROM s LEFT JOIN (SELECT industry, round(avg(coverage), 6) AS c FROM env WHERE tier = 'consensus' GROUP BY 1) x ON x.industry = s.industry""")
def dispersion(spark, d):
    return T.dispersion(mentions(spark, d), "industry", "company")


@query("AGG-29", ENV + """, f AS (SELECT industry, theme, mentions, 'market' AS family FROM env WHERE regexp_matches(theme, 'compet|inflat|economic') AND mentions > 5 UNION ALL SELECT industry, theme, mentions, 'regulatory' FROM env WHERE regexp_matches(theme, 'regul') AND mentions > 3 UNION ALL SELECT industry, theme, mentions, 'technology' FROM env WHERE regexp_matches(theme, 'techno') AND mentions > 3)
 SELECT industry, family, theme, mentions, r::INT AS place FROM (SELECT *, row_number() OVER (PARTITION BY industry, family ORDER BY mentions DESC, theme) AS r FROM f) WHERE r <= 5""")
def theme_families(spark, d):
    env = T.environment(mentions(spark, d), "industry", "company")
    return T.theme_families(env, ["industry"], {"market": ("compet|inflat|economic", 5), "regulatory": ("regul", 3), "technology": ("techno", 3)}).select("industry", "family", "theme", "mentions", "place")


@query("WIN-25 JSN-02", THEMES + """, s AS (SELECT industry, period, list_sort(list(DISTINCT theme)) AS now FROM tm GROUP BY 1, 2), b AS (SELECT *, lag(now) OVER (PARTITION BY industry ORDER BY period) AS before FROM s)
 SELECT industry, period, array_to_string(list_sort(list_filter(now, lambda x: before IS NULL OR NOT list_contains(before, x)))[1:5], ',') AS new, array_to_string(list_sort(list_filter(coalesce(before, []), lambda x: NOT list_contains(now, x)))[1:5], ',') AS retired, CASE WHEN before IS NULL THEN 'stable' WHEN len(now) > len(before) * 1.2 THEN 'increasing' WHEN len(now) < len(before) * 0.8 THEN 'decreasing' ELSE 'stable' END AS momentum FROM b""")
def risk_changes(spark, d):
    return T.changes(mentions(spark, d), ["industry"], "period")


@query("AGG-12", ENV + " SELECT theme, count(*) AS industries, sum(mentions)::BIGINT AS mentions FROM env GROUP BY 1 ORDER BY mentions DESC, theme LIMIT 10")
def cross_industry(spark, d):
    env = T.environment(mentions(spark, d), "industry", "company")
    return env.groupBy("theme").agg(F.count("*").alias("industries"), F.sum("mentions").alias("mentions")).orderBy(F.desc("mentions"), "theme").limit(10)


ENT = " UNION ALL ".join(f"SELECT doc_id, '{k}' AS kind, unnest(regexp_extract_all(text, '{p}')) AS entity FROM filings" for k, p in T.FILING_ENTITIES.items())


@query("STR-09", f"WITH {VIEW}, e AS ({ENT}) SELECT doc_id, kind, entity, count(*) AS n FROM e GROUP BY 1, 2, 3")
def regex_entities(spark, d):
    return T.entities(filings(spark, d), ["doc_id"], "text", T.FILING_ENTITIES)


@query("STR-10", f"""WITH {VIEW}, m AS (SELECT doc_id, unnest(regexp_extract_all(text, '\\$[0-9,]+(?: million)?')) AS entity FROM filings) SELECT doc_id, entity, TRY_CAST(replace(regexp_extract(entity, '([0-9][0-9,]*)', 1), ',', '') AS DOUBLE) * CASE WHEN contains(entity, 'million') THEN 1e6 ELSE 1.0 END AS value FROM m WHERE regexp_matches(entity, '[0-9]')""")
def money_values(spark, d):
    m = filings(spark, d).select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"\$[0-9,]+(?: million)?"), 0)).alias("entity")).where(F.col("entity").rlike("[0-9]"))
    return m.select("doc_id", "entity", money("entity").alias("value"))


PENT = " UNION ALL ".join(f"SELECT doc_id, '{k}' AS kind, unnest(regexp_extract_all(text, '{p}')) AS entity FROM posts" for k, p in T.POST_ENTITIES.items())
POST_TEXT = "CASE doc_id % 3 WHEN 0 THEN 'Phase III for ABC-12 $XYZ up 5% #news @you at $12.5M with Pfizer ' WHEN 1 THEN 'FDA approval by biotech, FDA-cleared Zetamab and therapy Nova Plus under Fast Track Designation ' ELSE '' END || text"


@query("STR-13", f"WITH posts AS (SELECT doc_id, {POST_TEXT} AS text FROM documents), e AS ({PENT}) SELECT doc_id, kind, entity, count(*) AS n FROM e GROUP BY 1, 2, 3")
def post_entities(spark, d):
    return T.entities(table(spark, d, "documents").select("doc_id", F.expr(POST_TEXT).alias("text")), ["doc_id"], "text", T.POST_ENTITIES)


@query("STR-14 STR-33", f"""WITH posts AS (SELECT doc_id, {POST_TEXT} AS text FROM documents) SELECT doc_id, array_to_string(list_filter([CASE WHEN regexp_matches(text, '{T.POST_ENTITIES['phase']}') THEN 'clinical_trials' END, CASE WHEN regexp_matches(text, '{T.POST_ENTITIES['fda']}') THEN 'regulatory' END, CASE WHEN regexp_matches(text, '{T.POST_ENTITIES['drug']}') THEN 'drug_development' END,
 CASE WHEN regexp_matches(text, '{T.POST_ENTITIES['ticker']}') OR regexp_matches(text, '{T.POST_ENTITIES['percent']}') THEN 'financial' END, CASE WHEN {hits('lower(text)', ['biotech', 'pharma', 'clinical'])} > 0 THEN 'biotech' END], lambda x: x IS NOT NULL), ',') AS topics FROM posts""")
def topic_flags(spark, d):
    return table(spark, d, "documents").select("doc_id", F.expr(POST_TEXT).alias("text")).select("doc_id", F.array_join(T.topics("text"), ",").alias("topics"))


@query("STR-28 SRC-12", f"""WITH {VIEW}, l AS (SELECT doc_id, text, lower(text) AS t FROM filings) SELECT doc_id, TRY_CAST(replace(regexp_extract(t, '{T.HIGHLIGHTS['revenue']}', 1), ',', '') AS DOUBLE) * CASE regexp_extract(t, '{T.HIGHLIGHTS['revenue']}', 2) WHEN 'million' THEN 1e6 WHEN 'billion' THEN 1e9 ELSE 1.0 END AS revenue,
 TRY_CAST(replace(regexp_extract(t, '{T.HIGHLIGHTS['net_income']}', 1), ',', '') AS DOUBLE) * CASE regexp_extract(t, '{T.HIGHLIGHTS['net_income']}', 2) WHEN 'million' THEN 1e6 WHEN 'billion' THEN 1e9 ELSE 1.0 END AS net_income, CAST(try_strptime(regexp_extract(text, 'FILED AS OF DATE:\\s*([0-9]{{8}})', 1), '%Y%m%d') AS DATE) AS filed FROM l""")
def financial_highlights(spark, d):
    return filings(spark, d).select("doc_id", *T.highlights("text"), *T.header_fields("text")).select("doc_id", "revenue", "net_income", "filed")


@query("STR-15", f"""WITH {VIEW}, r AS (SELECT doc_id, regexp_extract(text, '(?is)Item\\s+1A\\.\\s*Risk\\s+Factors(.*)$', 1) AS rest FROM filings), s AS (SELECT doc_id, rest, regexp_extract(rest, '(?is)^(.*?)Item\\s+[0-9]+[A-Z]?[.\\s]', 1) AS upto, regexp_matches(rest, '(?i)Item\\s+[0-9]+[A-Z]?[.\\s]') AS found FROM r) SELECT doc_id, trim(CASE WHEN found THEN upto ELSE left(rest, 50000) END) AS section FROM s""")
def section_extract(spark, d):
    return filings(spark, d).select("doc_id", T.section("text", [r"Item\s+1A\.\s*Risk\s+Factors"]).alias("section"))


@query("STR-17", f"""WITH {VIEW}, l AS (SELECT doc_id, lower(text) AS t, regexp_extract(text, 'SIC[^0-9]*([0-9]{{4}})', 1) AS code FROM filings) SELECT doc_id, CASE {' '.join(f"WHEN code = '{k}' THEN '{v}'" for k, v in T.SIC.items())} WHEN {hits('t', ['biotechnology', 'pharmaceutical', 'drug', 'therapy', 'clinical', 'fda', 'patent', 'molecule'])} > 3 THEN
 CASE WHEN {hits('t', ['mrna', 'messenger rna'])} > 0 THEN 'biotech_mrna' WHEN {hits('t', ['antibody', 'monoclonal'])} > 0 THEN 'biotech_antibody' WHEN {hits('t', ['gene therapy', 'gene editing'])} > 0 THEN 'biotech_gene' ELSE 'biotech_general' END ELSE 'healthcare_general' END AS category FROM l""")
def industry_category(spark, d):
    return filings(spark, d).select("doc_id", T.industry("text").alias("category"))


CITED = """text || CASE doc_id % 3 WHEN 0 THEN ' U.S. Pat. Nos. 5,123,456; 6,234,567 and U.S. Patent Application Publication No. 2010/0123456.' WHEN 1 THEN ' Smith and Jones, 2001; Nature Reviews 2019;562:203-210; Lee and Kim et al. (2011).' ELSE '' END"""


@query("STR-20", f"""WITH {VIEW}, c AS (SELECT doc_id, {CITED} AS t FROM filings), n AS (SELECT doc_id, t, list_concat(list_concat(flatten(list_transform(regexp_extract_all(t, '{T.PATENT_LIST}', 1), lambda m: regexp_extract_all(m, '{T.PATENT_NUMBER}', 1))), regexp_extract_all(t, '{T.PATENT_APPLICATION}', 1)), regexp_extract_all(t, '{T.PATENT_SINGLE}', 1)) AS n,
 {' || '.join(f"regexp_extract_all(t, '{p}', 1)" for p in T.PAPERS)} AS p FROM c) SELECT doc_id, array_to_string(list_sort(list_distinct(list_transform(list_filter(list_transform(n, lambda x: regexp_replace(x, '[^0-9]', '', 'g')), lambda x: length(x) >= 6), lambda x: 'US' || x))), ',') AS patents,
 array_to_string(list_sort(list_distinct(list_filter(list_transform(p, lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))), lambda x: length(x) >= 8 AND {hits('lower(x)', T.NOT_PAPERS)} = 0))), ',') AS papers FROM n""")
def citations(spark, d):
    rows = filings(spark, d).select("doc_id", F.expr(CITED).alias("t"))
    return rows.select("doc_id", F.array_join(F.array_sort(T.patent_citations("t")), ",").alias("patents"), F.array_join(F.array_sort(T.paper_citations("t")), ",").alias("papers"))


@query("STR-34", f"WITH {VIEW}, c AS (SELECT doc_id, 'Item ' || CAST(doc_id % 9 + 1 AS STRING) || '.01 and ITEM 2.02 ' || text AS t FROM filings) SELECT doc_id, array_to_string(list_filter([{', '.join(repr(i) for i in T.ITEMS)}], lambda x: contains(t, 'Item ' || x) OR contains(upper(t), 'ITEM ' || x)), ',') AS items FROM c")
def report_items(spark, d):
    return filings(spark, d).select("doc_id", F.expr("'Item ' || CAST(doc_id % 9 + 1 AS STRING) || '.01 and ITEM 2.02 ' || text").alias("t")).select("doc_id", F.array_join(T.report_items("t"), ",").alias("items"))


@query("SRC-11", """WITH u AS (SELECT page_id, url, regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') AS p FROM pages), w AS (SELECT page_id, url, string_split(replace(replace(list_last(string_split(p, '/')), '-', ' '), '_', ' '), ' ') AS ws FROM u)
 SELECT page_id, array_to_string(list_transform(ws, lambda x: upper(left(x, 1)) || lower(substring(x, 2))), ' ') AS title, CAST(NULL AS DATE) AS published FROM w""")
def url_title_date(spark, d):
    return table(spark, d, "pages").select("page_id", T.url_title("url").alias("title"), T.url_date("url").alias("published"))


@query("STR-22 STR-16", r"""SELECT doc_id, len(list_filter(regexp_split_to_array(trim(text), '\s+'), lambda x: length(x) > 0))::INT AS word_count, len(string_split(text, '.'))::INT AS sentence_count, length(text)::INT AS char_count FROM documents""")
def text_metrics(spark, d):
    return table(spark, d, "documents").select("doc_id", *T.text_metrics("text"))


HIDDEN = "|".join(["<!--.*?-->", *[f"<{t}\\b.*?</{t}>" for t in ("script", "style", "nav", "header", "footer", "aside")]])
BARE = "trim(regexp_replace(regexp_replace(regexp_replace({x}, '<[^>]*>', ' ', 'gs'), '&[a-z#0-9]+;', ' ', 'g'), '\\s+', ' ', 'g'))"


@query("SRC-10", f"""WITH h AS (SELECT page_id, regexp_replace(html, '(?is){HIDDEN}', ' ', 'g') AS h FROM pages), p AS (SELECT page_id, h, list_filter(list_transform(regexp_extract_all(h, '(?is)<p\\b[^>]*>(.*?)</p>', 1), lambda x: {BARE.format(x='x')}), lambda x: length(x) > 50) AS ps FROM h)
 SELECT page_id, array_to_string(list_filter(CASE WHEN len(ps) > 0 THEN ps ELSE list_filter([{BARE.format(x='h')}], lambda x: length(x) > 20) END, lambda x: NOT regexp_matches(lower(x), '^(cookie|subscribe|share this|all rights reserved)')), chr(10)) AS text FROM p""")
def page_text(spark, d):
    return table(spark, d, "pages").select("page_id", T.page_text("html").alias("text"))


@query("STR-18 STR-30")
def sentence_chunks(spark, d):
    return T.sentence_chunks(filings(spark, d), "doc_id", "text").select("doc_id", "chunk", "start", "end", F.length("text").alias("length"))


@query("STR-30 STR-16", """WITH m AS (SELECT doc_id, list_filter(string_split(regexp_replace(coalesce(text, ''), '(?m)^([A-ZÀ-Þ])', chr(1) || '\\1', 'g'), chr(1)), lambda x: length(trim(x)) > 0) AS p FROM documents), c AS (SELECT doc_id, flatten(list_transform(p, lambda x: list_transform(range(0, length(x), 8000), lambda s: substring(x, s + 1, 8000)))) AS c FROM m)
 SELECT doc_id, CAST(i - 1 AS INT) AS chunk, CAST(length(c[i]) AS INT) AS length FROM (SELECT doc_id, c, unnest(range(1, len(c) + 1)) AS i FROM c)""")
def heading_chunks(spark, d):
    return T.heading_chunks(table(spark, d, "documents").select("doc_id", "text"), "doc_id", "text", "[A-ZÀ-Þ]").select("doc_id", "chunk", F.length("text").alias("length"))


@query("JSN-01 JSN-03 STR-21", """SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k, (props->>'$.a.b') IS NOT NULL AS nested, props->>'$.k' AS fallback FROM events""")
def json_fields(spark, d):
    wrapped = F.concat(F.lit("Answer: "), F.replace("props", F.lit("}"), F.lit(",}")), F.lit(" end"))
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), F.get_json_object("props", "$.a.b").isNotNull().alias("nested"), wrapped.alias("w")).select("event_id", "k", "nested", T.json_with_fallback("w", "k").alias("fallback"))


@query("STR-29", """SELECT o_orderkey, array_to_string(['Office action', o_orderstatus, CASE WHEN o_totalprice > 300000 THEN 'final' END, strftime(o_orderdate, '%Y-%m-%d')], ' - ') AS description FROM orders""")
def action_descriptions(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.concat_ws(" - ", F.lit("Office action"), "o_orderstatus", F.when(F.col("o_totalprice") > 300000, "final"), F.date_format("o_orderdate", "yyyy-MM-dd")).alias("description"))
