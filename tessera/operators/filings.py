"""Text of filings: risk scores, themes, entities, sections, chunks, citations, pages."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.numeric import exact_avg, ratio
from tessera.functions.text import any_keyword, collapse, keyword_hits, labels, occurrences, title_case_path

#: Words of each risk category.
CATEGORIES = {
    "financial": ["liquidity", "cash flow", "debt", "covenant", "default"],
    "regulatory": ["fda", "regulatory", "approval", "compliance", "investigation"],
    "operational": ["supply chain", "manufacturing", "personnel", "cybersecurity"],
    "market": ["competition", "market share", "pricing", "demand"],
    "legal": ["litigation", "lawsuit", "patent", "intellectual property"],
    "strategic": ["pipeline", "development", "partnership", "acquisition"],
}
#: Phrases that weigh most, words that weigh a little.
CRITICAL = ["going concern", "substantial doubt", "may not be able", "bankruptcy", "default", "breach", "violation"]
NEGATIVE = ["not", "no", "unable", "fail", "loss", "decline"]
#: Words of each theme of a market environment, and of its tone.
THEMES = {
    "supply_chain": ["supply chain", "supplier", "logistics", "shortage"],
    "inflation": ["inflation", "price increase", "cost pressure", "pricing"],
    "competition": ["competitor", "market share", "competitive", "rivalry"],
    "regulation": ["regulation", "regulatory", "compliance", "government"],
    "technology": ["technology", "innovation", "disruption", "digital"],
    "macro_economic": ["economic", "recession", "interest rate", "gdp"],
    "geopolitical": ["geopolitical", "trade war", "sanctions", "tariff"],
    "pandemic": ["pandemic", "covid", "coronavirus", "outbreak"],
    "climate": ["climate", "sustainability", "esg", "carbon"],
}
TONE_DOWN = ["risk", "threat", "concern", "challenge", "difficult"]
TONE_UP = ["opportunity", "improve", "benefit", "advantage", "growth"]
#: Industry codes and their categories.
SIC = {"2834": "pharma_small_molecule", "2835": "pharma_in_vitro", "2836": "biotech_therapeutics", "3826": "medical_devices", "3841": "surgical_instruments", "3845": "medical_electronics"}
#: Item numbers of current reports.
ITEMS = ["1.01", "1.02", "2.01", "2.02", "2.03", "3.01", "3.02", "4.01", "5.01", "5.02", "5.03", "7.01", "8.01", "9.01"]
#: What is read from a statement, by the words before the number.
HIGHLIGHTS = {
    "revenue": r"revenues?\s*[:=]\s*\$?([0-9,]+(?:\.[0-9]+)?)\s*(million|billion)?",
    "net_income": r"net\s+income\s*[:=]\s*\$?([0-9,]+(?:\.[0-9]+)?)\s*(million|billion)?",
    "total_assets": r"total\s+assets\s*[:=]\s*\$?([0-9,]+(?:\.[0-9]+)?)\s*(million|billion)?",
    "cash": r"cash\s+and\s+cash\s+equivalents\s*[:=]\s*\$?([0-9,]+(?:\.[0-9]+)?)\s*(million|billion)?",
    "r_and_d": r"research\s+and\s+development\s*[:=]\s*\$?([0-9,]+(?:\.[0-9]+)?)\s*(million|billion)?",
}
#: Patterns of entities in filings and in posts.
FILING_ENTITIES = {"money": r"\$[0-9,]+(?:\.[0-9]+)?(?:\s*(?:billion|million|thousand))?", "percentage": r"[0-9]+(?:\.[0-9]+)?%", "year": r"(?:19|20)[0-9][0-9]"}
POST_ENTITIES = {
    "phase": r"[Pp]hase (?:I{1,3}|IV|[1-4])[ab]?",
    "fda": r"FDA (?:approval|clearance|approved|cleared)|FDA-(?:approved|cleared)|Fast Track Designation|Breakthrough Therapy Designation",
    "drug": r"(?i:drug|therapy|treatment|compound)(?: [A-Z][A-Za-z0-9]+)+|[A-Z]{2,}-[0-9]+|\b[A-Z][a-z]+mab\b",
    "company": r"Moderna|Pfizer|BioNTech|Novavax|Gilead|Regeneron|Vertex|Biogen|Amgen|Genentech",
    "ticker": r"\$[A-Z]+",
    "price": r"\$[0-9]+\.?[0-9]*[KMB]?",
    "percent": r"[+-]?[0-9]+(?:\.[0-9]+)?%",
    "hashtag": r"#[A-Za-z0-9_]+",
    "mention": r"@[A-Za-z0-9_]+",
}
#: Patterns of cited patents (lists after Nos., application publications, single numbers) and papers.
PATENT_LIST = r"(?i)U\.S\..*?Pat(?:ent)?.*?Nos?\.?\s*([0-9,;\s]+)"
PATENT_NUMBER = r"([0-9]{1,2},[0-9]{3},[0-9]{3})"
PATENT_APPLICATION = r"(?i)U\.S\..*?Patent.*?Application.*?Publication.*?No\.?\s*([0-9/]+)"
PATENT_SINGLE = r"(?i)Patent\s+No\.\s*([0-9]{1,3}(?:,[0-9]{3})*)"
PAPERS = [
    r"([A-Z][a-z]+(?:\s+(?:and|&)\s+[A-Z][a-z]+)*\s+et\s+al\.?,?\s*[0-9]{4})",
    r"([A-Z][a-z]+(?:\s+(?:and|&)\s+[A-Z][a-z]+)*\s+et\s+al\.?\s*\([0-9]{4}\))",
    r"([A-Z][a-z]+\s+and\s+[A-Z][a-z]+,?\s+[0-9]{4})",
    r"([A-Z][a-z]+(?:\s+[A-Z][a-z]+)*\s+[0-9]{4};[0-9]+:[0-9]+(?:-[0-9]+)?)",
]
NOT_PAPERS = ["example", "table", "figure", "section", "chapter", "claim", "embodiment", "step", "stage", "phase"]


def lower(text) -> Column:
    return F.lower(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def keyword_points(t: Column, words: list[str], each: int = 5, most: int = 30) -> Column:
    """Points of words in a lower-cased text: ``each`` an occurrence, at most ``most`` a word. Only words that occur are counted."""
    return reduce(lambda a, b: a + b, [F.when(F.contains(t, F.lit(w)), F.least(occurrences(t, w) * each, F.lit(most))).otherwise(0) for w in words])


def risk_scores(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """One row per document and category, 0 to 100: 20 a critical phrase, 5 an occurrence of a category's word (30 a word at
    most), 3 a negative word. The text is lowered and searched for phrases once, not once a category."""
    t = F.col("_t")
    rows = rows.select(*keys, lower(text).alias("_t"))
    rows = rows.select(*keys, "_t", (keyword_hits(t, CRITICAL) * 20 + keyword_hits(t, NEGATIVE) * 3).alias("_all"))
    found = F.array(*[F.struct(F.lit(c).alias("category"), F.least(F.col("_all") + keyword_points(t, w), F.lit(100)).cast("double").alias("score")) for c, w in CATEGORIES.items()])
    return rows.select(*keys, found.alias("_r")).select(*keys, F.explode_outer("_r").alias("r")).select(*keys, "r.category", "r.score")


def pattern_scores(rows: DataFrame, patterns: DataFrame, key: str, text: str) -> DataFrame:
    """Score of a weighted pattern table (category, keyword, base_score, weight), with floors for grave phrases; at most 100.

    The keyword table is the small side of a nested-loop join; Spark broadcasts it below its threshold.
    """
    t = rows.select(key, lower(text).alias("t"))
    sums = t.join(patterns, F.contains("t", F.lower("keyword"))).groupBy(key, "category").agg(F.sum((F.col("base_score") * F.col("weight")).cast("decimal(18,4)")).cast("double").alias("s"))
    all_ = t.select(key, F.greatest(*[F.when(F.contains("t", F.lit(p)), v).otherwise(0.0) for p, v in (("going concern", 90.0), ("substantial doubt", 85.0), ("bankruptcy", 95.0))]).alias("floor")).join(patterns.select("category").distinct())
    out = all_.join(sums, [key, "category"], "left")
    return out.select(key, "category", F.least(F.greatest(F.coalesce("s", F.lit(0.0)), "floor"), F.lit(100.0)).alias("score"))


def relative_percentile(scores: DataFrame, peers: list[str], score: str) -> DataFrame:
    """Peers with a lower score as percent of all peers and itself; 50 without peers."""
    w = Window.partitionBy(*peers)
    below = F.rank().over(w.orderBy(score)) - 1
    others = F.count("*").over(w) - 1
    return scores.withColumn("percentile", F.when(others == 0, 50.0).otherwise(below / (others + 1) * 100.0))


def momentum(scores: DataFrame, keys: list[str], order: list[str], score: str) -> DataFrame:
    return scores.withColumn("momentum", F.coalesce(F.col(score) - F.lag(score).over(Window.partitionBy(*keys).orderBy(*order)), F.lit(0.0)))


def confidence(text) -> Column:
    t = lower(text)
    n = keyword_hits(t, ["risk", "uncertain", "may", "could", "potential"])
    return F.when(F.length(t) < 100, 0.3).when(F.length(t) < 500, 0.6).when(n > 5, 0.9).when(n > 2, 0.7).otherwise(0.5)


def chunk_risk(chunks: DataFrame, key: str, pos: str, text: str, weights=(0.33, 0.34, 0.33), consensus: float = 0.6, emerging: float = 0.1) -> DataFrame:
    """Risk of a document from its chunks: tier of the mean, and mean, maximum and last less first in one score."""
    t = lower(text)
    grave, words = keyword_hits(t, CRITICAL), keyword_hits(t, ["risk", "uncertain", "adverse", "decline", "loss"])
    s = F.when(grave > 0, F.least(grave * 25, F.lit(100))).otherwise(F.least(words * 10, F.lit(50)))
    g = chunks.select(key, pos, s.alias("s")).groupBy(key).agg(exact_avg("s").alias("mean"), F.max("s").alias("top"), F.max_by("s", pos).alias("last"), F.min_by("s", pos).alias("first"))
    tier = F.when(F.col("mean") >= consensus * 100, "consensus_risk").when(F.col("mean") >= emerging * 100, "emerging_risk").otherwise("low_risk")
    return g.select(key, tier.alias("tier"), F.col("top").alias("max_score"), (F.col("mean") * weights[0] + F.col("top") * weights[1] + (F.col("last") - F.col("first")) * weights[2]).alias("score"))


def around(t: Column, word: str, n: int = 100) -> Column:
    """All stretches of a word with up to n characters of its line on either side, as the pattern .{0,n}word.{0,n} finds them.

    What is further than n characters and a word from the word is first cut out (a line break stands for it, which no stretch
    crosses; a word more, as words may overlap), so the pattern never walks along the rest of the text.
    """
    far = n + len(word)
    near = F.transform(F.split(t, word), lambda x: F.when(F.length(x) > 2 * far, F.concat(F.left(x, F.lit(far)), F.lit("\n"), F.right(x, F.lit(far)))).otherwise(x))
    found = F.regexp_extract_all(F.array_join(near, word), F.lit(f".{{0,{n}}}{word}.{{0,{n}}}"), 0)
    return F.when(F.contains(t, F.lit(word)), found).otherwise(F.array().cast("array<string>"))


def theme_mentions(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Per document and theme: how many stretches of up to 100 characters around a word, and their tone."""
    rows = rows.select(*keys, lower(text).alias("_t"))
    parts = [F.struct(F.lit(theme).alias("theme"), F.flatten(F.array(*[around(F.col("_t"), w) for w in words])).alias("m")) for theme, words in THEMES.items()]
    held = F.filter(F.array(*parts), lambda x: F.size(x["m"]) > 0)
    # outer, as the planner would else make the array a second time to ask whether it is empty
    out = rows.select(*keys, held.alias("_x")).select(*keys, F.explode_outer("_x").alias("x")).where("x IS NOT NULL")
    out = out.select(*keys, F.col("x.theme").alias("theme"), F.size("x.m").cast("long").alias("mention_count"), F.array_join("x.m", " ").alias("_w"))
    down, up = keyword_hits("_w", TONE_DOWN), keyword_hits("_w", TONE_UP)
    return out.select(*keys, "theme", "mention_count", F.when(down > up, -0.5).when(up > down, 0.5).otherwise(0.0).alias("sentiment"))


def environment(mentions: DataFrame, industry: str, company: str) -> DataFrame:
    """Per industry and theme: companies, coverage and its tier, mentions, mean tone of rows and tone per mention."""
    total = mentions.groupBy(industry).agg(F.countDistinct(company).alias("all_companies"))
    g = mentions.groupBy(industry, "theme").agg(F.countDistinct(company).alias("companies"), F.sum("mention_count").alias("mentions"), F.count("*").alias("rows"), F.sum(F.col("sentiment").cast("decimal(18,4)")).cast("double").alias("tone"))
    g = g.join(total, industry).withColumn("coverage", F.col("companies") / F.col("all_companies"))
    tier = F.when(F.col("coverage") > 0.6, "consensus").when(F.col("coverage") > 0.1, "emerging").otherwise("unique")
    return g.select(industry, "theme", "companies", "mentions", "coverage", tier.alias("tier"), ratio("tone", "mentions").alias("sentiment_per_mention"), ratio("tone", "rows").alias("mean_sentiment"))


def dispersion(mentions: DataFrame, industry: str, company: str) -> DataFrame:
    """How unevenly companies name themes (deviation over mean), and mean coverage of the consensus themes (0 without)."""
    per = mentions.groupBy(industry, company).agg(F.countDistinct("theme").alias("n"))
    spread = per.groupBy(industry).agg(F.round(F.coalesce(F.try_divide(F.stddev_pop("n"), F.avg("n")), F.lit(0.0)), 6).alias("dispersion"))
    agreed = environment(mentions, industry, company).where("tier = 'consensus'").groupBy(industry).agg(F.round(F.avg("coverage"), 6).alias("s"))
    return spread.join(agreed, industry, "left").select(industry, "dispersion", F.coalesce("s", F.lit(0.0)).alias("consensus_strength"))


def changes(themes: DataFrame, keys: list[str], period: str, k: int = 5) -> DataFrame:
    """New and retired themes against the period before (the first k by name), and whether their number moves."""
    sets = themes.groupBy(*keys, period).agg(F.array_sort(F.collect_set("theme")).alias("now"))
    before = F.lag("now").over(Window.partitionBy(*keys).orderBy(period))
    rows = sets.withColumn("before", before)
    n, m = F.size("now"), F.size("before")
    trend = F.when(F.col("before").isNull(), "stable").when(n > m * 1.2, "increasing").when(n < m * 0.8, "decreasing").otherwise("stable")
    none = F.array().cast("array<string>")
    cut = lambda c: F.array_join(F.slice(F.array_sort(c), 1, k), ",")
    return rows.select(*keys, period, cut(F.array_except("now", F.coalesce("before", none))).alias("new"), cut(F.array_except(F.coalesce("before", none), F.col("now"))).alias("retired"), trend.alias("momentum"))


def theme_families(env: DataFrame, keys: list[str], families: dict[str, tuple[str, int]], k: int = 5) -> DataFrame:
    """Themes whose name holds a family's words and whose mentions exceed its floor, the k most frequent of each."""
    found = F.array_compact(F.array(*[F.when(F.col("theme").rlike(words) & (F.col("mentions") > least), F.lit(name)) for name, (words, least) in families.items()]))
    rows = env.select(*keys, "theme", "mentions", F.explode(found).alias("family"))
    w = Window.partitionBy(*keys, "family").orderBy(F.desc("mentions"), "theme")
    return rows.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def entities(rows: DataFrame, keys: list[str], text: str, patterns: dict[str, str]) -> DataFrame:
    """(keys, kind, entity, n): every match of each pattern, counted."""
    found = F.array(*[F.struct(F.lit(k).alias("kind"), F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(p), 0).alias("m")) for k, p in patterns.items()])
    x = rows.select(*keys, F.explode(found).alias("x")).select(*keys, "x.kind", F.explode("x.m").alias("entity"))
    return x.groupBy(*keys, "kind", "entity").agg(F.count("*").alias("n"))


def entity_context(rows: DataFrame, key: str, text: str, pattern: str, around: int = 100) -> DataFrame:
    """First match of a pattern with what stands around it."""
    at = F.regexp_instr(F.col(text), F.lit(pattern))
    hit = F.regexp_substr(F.col(text), F.lit(pattern))
    begin = F.greatest(at - around, F.lit(1))
    return rows.where(at > 0).select(key, hit.alias("entity"), F.substring(F.col(text), begin, at + F.length(hit) + around - begin).alias("context"))


def topics(text) -> Column:
    """Topics that a post's entities give rise to."""
    has = lambda *names: reduce(lambda a, b: a | b, [F.coalesce(F.col(text), F.lit("")).rlike(POST_ENTITIES[n]) for n in names])
    return labels({"clinical_trials": has("phase"), "regulatory": has("fda"), "drug_development": has("drug"), "financial": has("ticker", "percent"), "biotech": any_keyword(text, ["biotech", "pharma", "clinical"])})


def organisation_kind(name: Column, biotech_context: Column, financial_context: Column) -> Column:
    bio = any_keyword(name, ["pharma", "biotech", "therapeutics"]) | (biotech_context & ~financial_context)
    return F.when(bio, "biotech").when(any_keyword(name, ["bank", "capital", "ventures", "partners"]), "financial").otherwise("other")


def highlights(text) -> list[Column]:
    t = lower(text)
    out = []
    for name, p in HIGHLIGHTS.items():
        n = F.regexp_replace(F.regexp_extract(t, p, 1), ",", "").try_cast("double")
        unit = F.regexp_extract(t, p, 2)
        out.append((n * F.when(unit == "million", 1e6).when(unit == "billion", 1e9).otherwise(1.0)).alias(name))
    return out


def report_items(text) -> Column:
    t, up = F.coalesce(F.col(text), F.lit("")), F.upper(F.coalesce(F.col(text), F.lit("")))
    return F.array_compact(F.array(*[F.when(F.contains(t, F.lit(f"Item {i}")) | F.contains(up, F.lit(f"ITEM {i}")), F.lit(i)) for i in ITEMS]))


def risk_factors(text) -> Column:
    t = lower(text)
    has = lambda w: F.contains(t, F.lit(w))
    return labels({"debt obligations": has("debt"), "liquidity concerns": has("liquidity"), "negative cash flow": has("cash flow negative"), "regulatory risk": has("fda"), "clinical trial risk": has("clinical trial"), "mitigated": any_keyword(t, ["mitigate", "reduce", "manage", "hedge", "insurance"])})


def header_fields(text) -> list[Column]:
    """Filing date and period from a header, null where absent or malformed."""
    t = F.coalesce(F.col(text), F.lit(""))
    day = lambda label: F.try_to_date(F.regexp_extract(t, label + r":\s*([0-9]{8})", 1), "yyyyMMdd")
    return [day("FILED AS OF DATE").alias("filed"), day("CONFORMED PERIOD OF REPORT").alias("period_end")]


def section(text, starts: list[str], most: int = 50_000) -> Column:
    """From the end of the first starting pattern found to the next Item heading, or ``most`` characters; null if none."""
    t = F.coalesce(F.col(text), F.lit(""))
    parts = []
    for p in starts:
        rest = F.regexp_extract(t, r"(?is)" + p + r"(.*)$", 1)
        stop = F.regexp_instr(rest, F.lit(r"(?i)Item\s+[0-9]+[A-Z]?[.\s]"))
        parts.append(F.when(t.rlike("(?i)" + p), F.trim(F.when(stop > 0, F.substring(rest, F.lit(1), stop - 1)).otherwise(F.substring(rest, 1, most)))))
    return F.coalesce(*parts)


def industry(text) -> Column:
    """Category by SIC code, else by words."""
    t = lower(text)
    code = F.regexp_extract(F.col(text), r"SIC[^0-9]*([0-9]{4})", 1)
    by_code = reduce(lambda a, kv: a.when(code == kv[0], kv[1]), list(SIC.items())[1:], F.when(code == "2834", SIC["2834"]))
    bio = keyword_hits(t, ["biotechnology", "pharmaceutical", "drug", "therapy", "clinical", "fda", "patent", "molecule"]) > 3
    kind = F.when(any_keyword(t, ["mrna", "messenger rna"]), "biotech_mrna").when(any_keyword(t, ["antibody", "monoclonal"]), "biotech_antibody").when(any_keyword(t, ["gene therapy", "gene editing"]), "biotech_gene").otherwise("biotech_general")
    return F.coalesce(by_code, F.when(bio, kind), F.lit("healthcare_general"))


def clean(text) -> Column:
    t = F.regexp_replace(collapse(text), r"[^A-Za-z0-9_\s.,;:!?\-()\[\]{}$%&/]", "")
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"Page [0-9]+ of [0-9]+", ""), r"(?i)Table of Contents", ""))


def stride_chunks(rows: DataFrame, key: str, text: str, size: int = 2000, overlap: int = 200, most: int | None = None) -> DataFrame:
    """Chunks of fixed stride with their offsets (from 0); no text has no chunk."""
    t = F.coalesce(F.col(text), F.lit(""))
    starts = F.when(F.length(t) > 0, F.sequence(F.lit(0), F.length(t) - 1, F.lit(size - overlap))).otherwise(F.array().cast("array<int>"))
    starts = F.slice(starts, 1, most) if most else starts
    return rows.select(key, t.alias("t"), F.posexplode(starts).alias("chunk", "start")).select(key, "chunk", "start", F.substring("t", F.col("start") + 1, F.lit(size)).alias("text"))


def sentence_chunks(rows: DataFrame, key: str, text: str, size: int = 2000, overlap: int = 200, look_back: int = 200) -> DataFrame:
    """Chunks of at most ``size`` characters that end after a sentence where one ends within ``look_back``; each begins
    ``overlap`` characters before the last one's end. Positions depend on one another, so one Python loop a text."""
    import re

    ends = [re.compile(p) for p in (r"\.\s+[A-Z]", r"\.\s*\n", r"[!?]\s+", r":\s*\n")]

    def cut(text: str) -> Iterator[tuple[int, int]]:
        start = 0
        while True:
            end = start + size
            if end >= len(text):
                yield start, len(text)
                return
            low = max(start + overlap + 1, end - look_back)  # so that every chunk moves on
            places = [m.start() + 1 for p in ends for m in p.finditer(text, low, end)]
            end = max(places) if places else end
            yield start, end
            start = max(end - overlap, start + 1)

    def run(batches):
        for pdf in batches:
            got = [(k, i, a, b, t[a:b]) for k, t in zip(pdf["k"], pdf["t"]) if t for i, (a, b) in enumerate(cut(t))]
            yield pd.DataFrame(got, columns=[key, "chunk", "start", "end", "text"])

    kind = dict(rows.dtypes)[key]
    return rows.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(run, f"{key} {kind}, chunk int, start int, end int, text string")


def heading_chunks(rows: DataFrame, key: str, text: str, heading: str, most: int = 8000) -> DataFrame:
    """Text split before every line that matches a heading; what stands before the first heading is a chunk too, and long
    chunks are cut into pieces of ``most`` characters, none lost."""
    marked = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"(?m)^(" + heading + ")", "\u0001$1")
    parts = F.filter(F.split(marked, "\u0001"), lambda x: F.length(F.trim(x)) > 0)
    cut = F.flatten(F.transform(parts, lambda x: F.transform(F.sequence(F.lit(0), F.length(x) - 1, F.lit(most)), lambda s: F.substring(x, s + 1, F.lit(most)))))
    return rows.select(key, F.posexplode(cut).alias("chunk", "text"))


def patent_citations(text, most: int = 50) -> Column:
    """US numbers of cited patents: in lists after Nos., application publications, then after Patent No.; each once, the first
    ``most``."""
    t = F.coalesce(F.col(text), F.lit(""))
    every = lambda p: F.when(t.rlike(r"(?i)u\.s\."), F.regexp_extract_all(t, F.lit(p), 1)).otherwise(F.array().cast("array<string>"))
    listed = F.flatten(F.transform(every(PATENT_LIST), lambda m: F.regexp_extract_all(m, F.lit(PATENT_NUMBER), 1)))
    numbers = F.concat(listed, every(PATENT_APPLICATION), F.regexp_extract_all(t, F.lit(PATENT_SINGLE), 1))
    digits = F.filter(F.transform(numbers, lambda x: F.regexp_replace(x, "[^0-9]", "")), lambda x: F.length(x) >= 6)
    return F.slice(F.array_distinct(F.transform(digits, lambda x: F.concat(F.lit("US"), x))), 1, most)


def paper_citations(text, most: int = 100) -> Column:
    """Cited papers: authors et al. with a year, two authors and a year, journal year;volume:pages. Names of parts of a text are
    none. A title after an author's name has no year in what is kept of it, so that form adds nothing."""
    t = F.coalesce(F.col(text), F.lit(""))
    found = F.concat(*[F.regexp_extract_all(t, F.lit(p), 1) for p in PAPERS])
    good = F.filter(F.transform(found, collapse), lambda x: (F.length(x) >= 8) & ~any_keyword(x, NOT_PAPERS))
    return F.slice(F.array_distinct(good), 1, most)


def page_text(html) -> Column:
    """Visible text of a page in built-in functions: no scripts, styles and navigation, paragraphs over 50 characters, else
    all text; boilerplate lines and lines of 20 characters or fewer go."""
    h = F.regexp_replace(F.col(html), r"(?is)<!--.*?-->|<(script|style|nav|header|footer|aside)\b.*?</\1>", " ")
    bare = lambda x: collapse(F.regexp_replace(F.regexp_replace(x, r"(?s)<[^>]*>", " "), r"&[a-z#0-9]+;", " "))
    ps = F.filter(F.transform(F.regexp_extract_all(h, F.lit(r"(?is)<p\b[^>]*>(.*?)</p>"), 1), bare), lambda x: F.length(x) > 50)
    whole = F.filter(F.array(bare(h)), lambda x: F.length(x) > 20)
    return F.array_join(F.filter(F.when(F.size(ps) > 0, ps).otherwise(whole), lambda x: ~F.lower(x).rlike("^(cookie|subscribe|share this|all rights reserved)")), "\n")


def url_title(url) -> Column:
    return title_case_path(url)


def url_date(url) -> Column:
    """Date in a URL: /2024/03/15/, /2024-03-15 or /20240315; null if none or no such day."""
    u = F.col(url)
    parts = []
    for p in (r"/([0-9]{4})/([0-9]{1,2})/([0-9]{1,2})/", r"/([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})", r"/([0-9]{4})([0-9]{2})([0-9]{2})"):
        y, m, d = (F.regexp_extract(u, p, k) for k in (1, 2, 3))
        parts.append(F.when(u.rlike(p), F.try_to_date(F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")))))
    return F.coalesce(*parts)


def text_metrics(text) -> list[Column]:
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.size(F.filter(F.split(F.trim(t), r"\s+"), lambda x: F.length(x) > 0))
    return [words.alias("word_count"), F.size(F.split(t, r"\.")).alias("sentence_count"), F.length(t).alias("char_count")]


def json_with_fallback(text, field: str) -> Column:
    """A field of JSON that may stand in other text and have trailing commas; else by pattern."""
    body = F.regexp_extract(F.col(text), r"(?s)(\{.*\})", 1)
    body = F.regexp_replace(body, r",\s*([}\]])", "$1")
    return F.coalesce(F.get_json_object(body, f"$.{field}"), F.nullif(F.regexp_extract(F.col(text), rf'"{field}"\s*:\s*"?([^",}}]*)', 1), F.lit("")))
