"""Names and mentions of entities: filters, resolution, grouping, merging, scores; vectors and clusters."""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import company_name, core_name, spelling
from tessera.sources.staging import cut

#: Words that are no name of a filing company.
GENERIC = ["company", "the company", "corporation", "the corporation", "we", "us", "our", "issuer", "registrant", "the issuer"]
#: Suffix words of entity names.
SUFFIX_WORDS = ["corporation", "corp", "company", "co", "incorporated", "inc", "limited", "ltd", "llc", "lp", "plc", "holdings", "group", "ag", "sa", "nv"]
#: Entity types of several recognisers under one name.
TYPES = {"Disease": "MEDICAL_CONDITION", "Chemical": "MEDICATION", "Drug": "MEDICATION", "PER": "PERSON", "ORG": "ORGANIZATION", "LOC": "LOCATION", "MONEY": "FINANCIAL", "PERCENT": "FINANCIAL"}


def is_noise(label: Column, text: Column) -> Column:
    """Dates, money and boilerplate law; a named act stays."""
    law = label == "Law"
    boiler = text.rlike("Securities Act of 1933|Exchange Act|Section ") | F.lower(text).isin("legal proceedings", "litigation")
    return label.isin("Date", "Money") | (law & boiler & ~F.contains(text, F.lit("Hart-Scott-Rodino")))


def normal_type(kind: Column) -> Column:
    out = F.upper(kind)
    for k, v in TYPES.items():
        out = F.when(kind == k, v).otherwise(out)
    return out


def passes(model: Column, text: Column, kind: Column, score: Column, least: float = 0.5, common: list[str] | None = None) -> Column:
    """Filters of each recogniser, and the least confidence."""
    ok = F.when(model == "biobert", kind != "0").when(model == "finbert", ~F.lower(text).isin(common or ["company", "year"])).when(model == "bert", kind != "MISC").otherwise(F.length(text) >= 2)
    return ok & (score >= least)


def route(filing_type: Column, section: Column) -> Column:
    """Recognisers that read a section of a filing."""
    lit = lambda *x: F.array(*map(F.lit, x))
    money = F.lower(section).rlike("financial|statement")
    own = F.upper(filing_type)
    return F.when(own.isin("10-K", "10-Q") & money, lit("finbert")).when(own == "8-K", lit("biobert", "bert_base", "roberta", "finbert")).otherwise(lit("bert_base", "roberta", "biobert"))


def quality(confidence: Column, canonical: Column, relations: Column) -> Column:
    return F.least(confidence + F.when(canonical, 0.1).otherwise(0.0) + F.least(relations * 0.02, F.lit(0.1)), F.lit(1.0))


def consensus_quality(confidence: Column, models: Column) -> Column:
    return F.least(confidence + F.when(models > 1, (models - 1) * 0.1).otherwise(0.0), F.lit(1.0))


def pipeline_score(coverage, precision, recall, deal, section, hallucination) -> tuple[Column, Column]:
    """Weighted score of a run and its grade."""
    s = coverage * 0.15 + precision * 0.30 + recall * 0.25 + deal * 0.20 + section * 0.05 + (100.0 - hallucination) * 0.05
    return s, F.when(s >= 90, "A").when(s >= 80, "B").when(s >= 70, "C").when(s >= 60, "D").otherwise("F")


def canonical_name(rows: DataFrame, key: str, text: str, place: str) -> DataFrame:
    """The longest name of each filing that is no generic word, the first of equals; else the first candidate."""
    formal = ~F.lower(text).isin(GENERIC) & (F.length(text) > 2)
    by = F.struct(F.when(formal, F.length(text)).otherwise(-1).alias("n"), (-F.col(place)).alias("p"))
    return rows.groupBy(key).agg(F.max_by(text, by).alias("canonical_name"))


def merge_positions(rows: DataFrame, keys: list[str], score: str, model: str) -> DataFrame:
    """One entity per place: the surest recogniser's, with all that found it."""
    rest = [c for c in rows.columns if c not in keys]
    g = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(score, model)).alias("r"), F.array_join(F.array_sort(F.collect_set(model)), ",").alias("models"), F.countDistinct(model).alias("n_models"))
    return g.select(*keys, "r.*", "models", "n_models")


def merge_groups(rows: DataFrame, keys: list[str], mention: str, score: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set(mention)), "|").alias("mentions"), F.max(score).alias("confidence"), F.count("*").alias("n"))


def cross_document(rows: DataFrame, keys: list[str], doc: str) -> DataFrame:
    """Entities of more than one document."""
    return rows.groupBy(*keys).agg(F.countDistinct(doc).alias("documents")).where("documents > 1")


def name_ratio(a: str, b: str) -> Column:
    """Ratcliff-Obershelp similarity of two name columns; 0 where one is empty. A pandas UDF: no built-in has its numbers."""
    return F.pandas_udf(_ratios, "double")(a, b)


def _ratios(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([SequenceMatcher(None, x.lower(), y.lower()).ratio() if x and y else 0.0 for x, y in zip(a, b)])


def _bigrams(text: Column) -> Column:
    """Pairs of neighbouring characters, each numbered by how often it stood before, so that equal ones match one to one."""
    grams = F.when(F.length(text) >= 2, F.transform(F.sequence(F.lit(1), F.length(text) - 1), lambda i: F.substring(text, i, F.lit(2)))).otherwise(F.array().cast("array<string>"))
    return F.transform(grams, lambda g, i: F.concat(g, F.size(F.filter(F.slice(grams, F.lit(1), i), lambda x: x == g)).cast("string")))


def _least_shared(m: Column, n: Column, least: float) -> Column:
    """How many bigrams names of m and n characters share at least where their ratio reaches ``least``.

    Of m + n characters u = m + n - 2 * matched stand alone. Every one of them in the first name breaks two of its m - 1
    bigrams, every one in the second one.
    """
    u = m + n - 2 * F.ceil(F.lit(least) * (m + n) / 2.0)
    return F.ceil((m + n - 3 * u) / 2.0 - 1.0)


def _similar_pairs(left: DataFrame, right: DataFrame, gs: list[str], least: float) -> DataFrame:
    """(_a, _b, *gs): all pairs of unequal names ``_n`` of both sides, equal in ``gs``, whose ratio can reach ``least`` (above 0.8)."""
    spelled = cut(left.unionByName(right).select("_n").distinct().select("_n", F.length("_n").alias("_m"), _bigrams(F.col("_n")).alias("_g")))
    rank = cut(spelled.select(F.explode("_g").alias("g")).groupBy("g").agg(F.count("*").alias("df")))
    # the least partner a name of m characters can have has m * least / (2 - least); fewest shared bigrams are asked for there
    low = F.ceil(F.col("_m") * F.lit(least / (2.0 - least)))
    head = F.col("_m") - 1 - F.greatest(F.floor((1.5 * least - 1.0) * (F.col("_m") + low) - 1.0), F.lit(1)) + 1
    ordered = spelled.select("_n", "_m", F.explode("_g").alias("g")).join(rank, "g").groupBy("_n", "_m").agg(F.array_sort(F.collect_list(F.struct("df", "g"))).alias("x"))
    ordered = cut(ordered.select("_n", "_m", F.transform("x", lambda v: v["g"]).alias("_g"), F.greatest(head, F.lit(1)).cast("int").alias("_h")))

    def side(df: DataFrame, mark: str) -> DataFrame:
        x = df.join(ordered, "_n").select(*[F.col(c).alias(f"{c}{mark}") for c in ("_n", "_m", "_g")], F.slice("_g", F.lit(1), "_h").alias(f"_p{mark}"), *gs)
        return x.select("*", F.explode(f"_p{mark}").alias("_k"))

    m, n = F.col("_m1"), F.col("_m2")
    near = (F.element_at(F.array_intersect("_p1", "_p2"), 1) == F.col("_k")) & (2.0 * F.least(m, n) >= least * (m + n))
    pairs = side(left, "1").join(side(right, "2"), ["_k", *gs]).where(near).where(F.size(F.array_intersect("_g1", "_g2")) >= _least_shared(m, n, least))
    return pairs.where("_n1 <> _n2").select(F.col("_n1").alias("_a"), F.col("_n2").alias("_b"), *gs)


def fuzzy_best(names: DataFrame, known: DataFrame, name: str, entity: str, group: str | None = None, least: float = 0.85) -> DataFrame:
    """For every name the most similar known entity of its group, from ``least`` (above 0.8) on; ties to the smaller entity.

    No qualifying pair is left out: names whose ratio reaches ``least`` share so many bigrams that the rarest ones of each, as
    many as may miss and one more, have one in common. Pairs are joined by those, each at the first common one only, cut by
    length and by shared bigrams, and then compared. Equal normal forms are compared once; null and empty names match none.
    """
    if least <= 0.8:
        raise ValueError("fuzzy_best: least must be above 0.8, below which similar names need not share a bigram")
    own = [F.col(group)] if group else []
    gs = [group] if group else []
    forms = lambda df: df.select(company_name(name).alias("_n"), *own).where("_n <> ''").distinct()
    left, right = forms(names), forms(known)
    pairs = _similar_pairs(left, right, gs, least)
    scored = pairs.withColumn("ratio", name_ratio("_a", "_b")).where(F.col("ratio") >= least)
    same = left.join(right, ["_n", *gs], "left_semi").select(F.col("_n").alias("_a"), F.col("_n").alias("_b"), *gs, F.lit(1.0).alias("ratio"))
    ids = known.select(company_name(name).alias("_b"), *own, F.col(entity)).groupBy("_b", *gs).agg(F.min(entity).alias(entity))
    best = scored.unionByName(same).join(ids, ["_b", *gs]).groupBy("_a", *gs).agg(F.max_by(F.struct(entity, "ratio"), F.struct("ratio", (-F.col(entity)).alias("e"))).alias("r"))
    return names.select(name, *own).distinct().withColumn("_a", company_name(name)).join(best, ["_a", *gs]).select(name, *gs, "r.*")


def resolve(names: DataFrame, variants: DataFrame, known: DataFrame, name: str, entity: str) -> DataFrame:
    """Cascade: an exact variant, the same normal form, a similar name, else an id made of the normal form."""
    a = names.select(name).distinct().join(variants.groupBy(name).agg(F.min(entity).alias("_a")), name, "left")
    forms = known.withColumn("_n", company_name(name)).groupBy("_n").agg(F.min(entity).alias("_b"))
    b = a.withColumn("_n", company_name(name)).join(forms, "_n", "left")
    open_ = b.where("_a IS NULL AND _b IS NULL").select(name)
    c = b.join(fuzzy_best(open_, known, name, entity).select(name, F.col(entity).alias("_c")), name, "left")
    how = F.when(F.col("_a").isNotNull(), "exact").when(F.col("_b").isNotNull(), "canonical").when(F.col("_c").isNotNull(), "fuzzy").otherwise("new")
    found = F.coalesce(F.col("_a").cast("string"), F.col("_b").cast("string"), F.col("_c").cast("string"), F.substring(F.sha2("_n", 256), 1, 16))
    return c.select(name, found.alias("canonical_id"), how.alias("method"))


def same_entity(a: str, b: str, full: bool = True, least: float = 0.85) -> bool:
    """One in the other, similar, initials, contained without blanks, or spelled otherwise."""
    if a and b and (a in b or b in a):
        return True
    if SequenceMatcher(None, a, b).ratio() >= least:
        return True
    short, long = sorted((a, b), key=len)
    parts = long.split()
    return bool(_bare(short)) and ((len(parts) > 1 and _bare(short) == "".join(p[0] for p in parts)) or _bare(short) in _bare(long))


def _bare(x: str) -> str:
    return "".join(c for c in x.lower() if c.isascii() and c.isalnum())


def _name_forms(core: pd.Series) -> pd.DataFrame:
    """Letters and digits alone, and the initials of names of more than one word."""
    parts = [x.split() for x in core]
    return pd.DataFrame({"bare": [_bare(x) for x in core], "initials": ["".join(w[0] for w in p) if len(p) > 1 else "" for p in parts]})


def _resemble(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([same_entity(x, y) for x, y in zip(a, b)], dtype=bool)


def _containing(needles: DataFrame, hays: DataFrame) -> DataFrame:
    """(x, y): ids of all (g, id, s) with the s of the first, not empty, inside the s of the second, of the same g.

    A needle is looked up by one of its runs of three characters, the one that fewest texts of its group hold; by itself, if it is shorter.
    """
    runs = lambda q: F.when(F.length("s") >= q, F.transform(F.sequence(F.lit(1), F.length("s") - (q - 1)), lambda i: F.substring(F.col("s"), i, F.lit(q)))).otherwise(F.array().cast("array<string>"))
    held = hays.select("g", "id", "s", F.explode(F.array_distinct(F.concat(runs(1), runs(2), runs(3)))).alias("k"))
    often = held.groupBy("g", "k").agg(F.count("*").alias("n"))
    own = needles.where("s <> ''").select("g", "id", "s", F.explode(F.array_distinct(F.when(F.length("s") < 3, F.array("s")).otherwise(runs(3)))).alias("k"))
    rare = own.join(often, ["g", "k"]).groupBy("g", "id", "s").agg(F.min_by("k", F.struct("n", "k")).alias("k"))
    both = rare.select("g", "k", F.col("id").alias("x"), F.col("s").alias("_s")).join(held.select("g", "k", F.col("id").alias("y"), "s"), ["g", "k"])
    return both.where((F.col("x") != F.col("y")) & F.contains("s", "_s")).select("x", "y")


def _serial_followers(batches):
    """Of all rows (c, a, b), edges a < b of a null c and members b of a clique c: the nodes that follow an earlier leader."""
    rows = pd.concat([*batches, pd.DataFrame({"c": [], "a": [], "b": []})])
    edge = rows["c"].isna()
    before, cliques = {}, {}
    for a, b in zip(rows["a"][edge].astype("int64").tolist(), rows["b"][edge].astype("int64").tolist()):
        before.setdefault(b, []).append(a)
        before.setdefault(a, [])
    for c, b in zip(rows["c"][~edge].tolist(), rows["b"][~edge].astype("int64").tolist()):
        cliques.setdefault(b, []).append(c)
        before.setdefault(b, [])
    leads, led, out = set(), set(), []
    for k in sorted(before):
        if any(a in leads for a in before[k]) or any(c in led for c in cliques.get(k, ())):
            out.append(k)
        else:
            leads.add(k)
            led.update(cliques.get(k, ()))
    yield pd.DataFrame({"id": pd.Series(out, dtype="int64")})


def first_leaders(nodes: DataFrame, edges: DataFrame, members: DataFrame, small: int = 200_000) -> DataFrame:
    """The ids that lead when nodes are taken in ascending order and lead unless they are linked with an earlier leader.

    Links are ``edges`` (a < b) and the pairs of nodes that stand in the same clique of ``members`` (c, id), which are not made. In a round all nodes lead that no
    earlier open one is linked with, and what they are linked with is done; so rounds are as many as the longest chain of such waits. What is
    left of at most ``small`` edges and members (counted) is ended by one task.
    """
    open_, e, m = cut(nodes.select("id")), cut(edges), cut(members)
    leads = []
    while (n := e.count() + m.count()) > small:
        waits = e.select(F.col("b").alias("id")).unionByName(m.join(m.groupBy("c").agg(F.min("id").alias("_f")), "c").where("id > _f").select("id"))
        new = cut(open_.join(waits, "id", "left_anti"))
        leads.append(new)
        near = e.join(new.withColumnRenamed("id", "a"), "a", "left_semi").select(F.col("b").alias("id"))
        same = m.join(m.join(new, "id", "left_semi").select("c").distinct(), "c", "left_semi").select("id")
        done = cut(new.unionByName(near).unionByName(same).distinct())
        open_ = cut(open_.join(done, "id", "left_anti"))
        for end in "ab":
            e = e.join(done.withColumnRenamed("id", end), end, "left_anti")
        e, m = cut(e.select("a", "b")), cut(m.join(done, "id", "left_anti"))
    if n:
        rest = e.select(F.lit(None).cast("long").alias("c"), "a", "b").unionByName(m.select("c", F.lit(None).cast("long").alias("a"), F.col("id").alias("b")))
        open_ = open_.join(cut(rest.coalesce(1).mapInPandas(_serial_followers, "id long")), "id", "left_anti")
    for new in leads:
        open_ = open_.unionByName(new)
    return cut(open_)


def greedy_groups(rows: DataFrame, keys: list[str], text: str, score: str, small: int = 200_000) -> DataFrame:
    """(keys, text, canonical, confidence): names of a group, longest first and then by spelling, join the first name before them that leads and that
    they resemble (``same_entity``, or spelled alike), else lead. Confidence is the greatest of those that share a leader.

    No group is one task: names that can resemble each other are found by joins (rare runs of characters for names in names, rare bigrams for similar ones, initials), and leaders
    by rounds (``first_leaders``). Names with the same core are one; names spelled alike are a clique whose pairs are not made. Null names have no row, null keys are a
    group, repeated names are one row.
    """
    names = rows.where(F.col(text).isNotNull()).groupBy(F.struct(*keys).alias("g"), F.col(text).cast("string").alias("_t")).agg(F.max(score).cast("double").alias("_s"))
    names = cut(names.withColumn("_core", core_name("_t", SUFFIX_WORDS)))
    nodes = names.groupBy("g", F.col("_core").alias("core")).agg(F.min(F.struct((-F.length("_t")).alias("n"), F.col("_t").alias("t"))).alias("o"))
    nodes = nodes.withColumn("v", spelling("core")).withColumn("f", F.pandas_udf(_name_forms, "bare string, initials string")("core"))
    # ids ascend in the order in which names are taken
    nodes = cut(nodes.orderBy("o.n", "o.t").select(F.monotonically_increasing_id().alias("id"), "g", "core", "v", "f.*", F.col("o.t").alias("t")))
    alike = nodes.groupBy("g", "v").agg(F.min("id").alias("c"), F.count("*").alias("n")).where("n > 1")
    members = cut(nodes.join(alike, ["g", "v"]).select("c", "id"))

    bare, raw = nodes.select("g", "id", F.col("bare").alias("s")), nodes.select("g", "id", F.col("core").alias("s"))
    plain = nodes.where("bare = '' AND core <> ''").select("g", "id", F.col("core").alias("s"))
    pairs = _containing(bare, bare).unionByName(_containing(plain, raw.join(plain.select("g").distinct(), "g", "left_semi")))
    short = nodes.where("bare <> ''").select("g", F.col("bare").alias("k"), F.col("id").alias("x"))
    pairs = pairs.unionByName(short.join(nodes.where("initials <> ''").select("g", F.col("initials").alias("k"), F.col("id").alias("y")), ["g", "k"]).where("x <> y").select("x", "y"))
    forms = nodes.select("g", F.col("core").alias("_n"))
    named = lambda n, i: nodes.select("g", F.col("core").alias(n), F.col("id").alias(i))
    pairs = pairs.unionByName(_similar_pairs(forms, forms, ["g"], 0.85).join(named("_a", "x"), ["g", "_a"]).join(named("_b", "y"), ["g", "_b"]).select("x", "y"))
    pairs = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    core = lambda i, n: nodes.select(F.col("id").alias(i), F.col("core").alias(n))
    edges = cut(pairs.join(core("a", "_x"), "a").join(core("b", "_y"), "b").where(F.pandas_udf(_resemble, "boolean")("_x", "_y")).select("a", "b"))

    leads = first_leaders(nodes, edges, members, small)
    by_edge = edges.join(leads.withColumnRenamed("id", "a"), "a").select(F.col("b").alias("id"), F.col("a").alias("h"))
    by_clique = members.join(members.join(leads, "id").select("c", F.col("id").alias("h")), "c").where("id > h").select("id", "h")
    first = by_edge.unionByName(by_clique).groupBy("id").agg(F.min("h").alias("h"))
    led = nodes.join(first, "id", "left").select("g", F.col("core").alias("_core"), F.coalesce("h", "id").alias("h"))
    out = cut(names.join(led, ["g", "_core"]).select("g", "_t", "_s", "h"))
    top = out.groupBy("h").agg(F.max("_s").alias("confidence")).join(nodes.select(F.col("id").alias("h"), F.col("t").alias("canonical")), "h")
    return out.join(top, "h").select("g.*", F.col("_t").alias("text"), "canonical", "confidence")


def _starts(rows: np.ndarray, k: int, n_init: int, seed: int) -> np.ndarray:
    """(n_init, k, dims) first centres, each drawn with a chance that grows with the squared distance to those before."""
    rng, out = np.random.default_rng(seed), []
    for _ in range(n_init):
        centres = [rows[rng.integers(len(rows))]]
        near = ((rows - centres[0]) ** 2).sum(axis=1)
        while len(centres) < k:
            chance = near / near.sum() if near.sum() > 0 else None
            centres.append(rows[rng.choice(len(rows), p=chance)])
            near = np.minimum(near, ((rows - centres[-1]) ** 2).sum(axis=1))
        out.append(centres)
    return np.array(out)


def kmeans_centres(vectors: DataFrame, vec: str, k: int = 8, seed: int = 42, n_init: int = 10, most_rounds: int = 50, sample: int = 5000) -> tuple[np.ndarray, float]:
    """(centres, inertia) of the best of ``n_init`` runs, all in one pass over the data a round; only sums of clusters reach the driver.

    First centres come from the ``sample`` vectors with the smallest hash; every round, and the inertia that decides, takes all vectors. A
    run is done when no centre moves by more than 1e-9 of the spread. Null vectors, and those with null or non-finite components or another length
    than the first of the sample, take no part. Fewer vectors than ``k`` repeat as centres.
    """
    e = F.col(vec)
    fine = e.isNotNull() & F.forall(e, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False))) & (F.size(e) > 0)
    rows = vectors.where(F.coalesce(fine, F.lit(False))).select(e.cast("array<double>").alias("x"))
    some = [r["x"] for r in rows.orderBy(F.xxhash64("x"), "x").limit(sample).collect()]
    if not some:
        return np.zeros((0, 0)), 0.0
    dims = len(some[0])
    rows = rows.where(F.size("x") == dims)
    first = np.array([x for x in some if len(x) == dims])
    centres, spread = _starts(first, k, n_init, seed), max(float(first.var()), 1e-300)
    best: tuple[float, np.ndarray] = (np.inf, centres[0])
    going = np.arange(n_init)
    for _ in range(most_rounds):
        now = centres[going]

        def sums(batches, now=now, going=going):
            total, n, inertia = np.zeros_like(now), np.zeros(now.shape[:2]), np.zeros(len(now))
            for pdf in batches:
                x = np.stack(pdf["x"].to_numpy())
                for i, c in enumerate(now):
                    d = (x * x).sum(axis=1)[:, None] - 2 * x @ c.T + (c * c).sum(axis=1)
                    a = d.argmin(axis=1)
                    inertia[i] += np.maximum(d[np.arange(len(x)), a], 0).sum()
                    np.add.at(total[i], a, x)
                    n[i] += np.bincount(a, minlength=len(c))
            yield pd.DataFrame([(int(run), j, total[i, j].tolist(), n[i, j], inertia[i] if j == 0 else 0.0) for i, run in enumerate(going) for j in range(now.shape[1])], columns=["run", "c", "s", "n", "inertia"])

        parts = rows.mapInPandas(sums, "run int, c int, s array<double>, n double, inertia double")
        each = parts.select("run", "c", "n", "inertia", F.posexplode("s").alias("i", "s")).groupBy("run", "c", "i").agg(F.sum("s").alias("s"), F.sum("n").alias("n"), F.sum("inertia").alias("inertia"))
        got = each.groupBy("run", "c").agg(F.sort_array(F.collect_list(F.struct("i", "s"))).alias("s"), F.max("n").alias("n"), F.max("inertia").alias("inertia")).collect()
        new = centres.copy()
        for r in got:
            if r["n"]:
                new[r["run"], r["c"]] = [y["s"] / r["n"] for y in r["s"]]
            if r["c"] == 0 and r["inertia"] < best[0]:
                best = (r["inertia"], centres[r["run"]].copy())
        going = np.array([i for i in going if ((new[i] - centres[i]) ** 2).sum(axis=1).max() > 1e-9 * spread])
        centres = new
        if not len(going):
            break
    return best[1], float(best[0])


def kmeans_topics(vectors: DataFrame, key: str, vec: str, k: int = 8, seed: int = 42, n_init: int = 10) -> DataFrame:
    """(key, cluster, confidence): 1 less the distance to the nearest centre over the greatest distance of all, for the best of ``n_init`` runs.

    Vectors that take no part in ``kmeans_centres`` have no row. Clusters are numbered by their centres in ascending order."""
    centres, _ = kmeans_centres(vectors, vec, k, seed, n_init)
    if not len(centres):
        return vectors.select(key, F.lit(0).alias("cluster"), F.lit(0.0).alias("confidence")).limit(0)
    e = F.col(vec).cast("array<double>")
    apart = lambda c: F.aggregate(F.zip_with(e, F.array(*[F.lit(float(x)) for x in c]), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    order = sorted(centres.tolist())
    near = F.array_min(F.array(*[F.struct(apart(c).alias("d"), F.lit(j).alias("cluster")) for j, c in enumerate(order)]))
    fine = F.coalesce((F.size(e) == len(order[0])) & F.forall(e, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))), F.lit(False))
    out = cut(vectors.where(fine).select(key, near.alias("x")).select(key, "x.cluster", F.sqrt("x.d").alias("d")))
    top = out.agg(F.max("d").alias("m"))  # one row
    return out.join(F.broadcast(top)).select(key, "cluster", (1.0 - F.coalesce(F.try_divide("d", "m"), F.lit(0.0))).alias("confidence"))


def vote_labels(rows: DataFrame, cluster: str, text: str, topics: dict[str, list[str]]) -> DataFrame:
    """Topic with most keyword occurrences among a cluster's texts; Other without any; ties to the first name."""
    from tessera.functions.text import keyword_hits

    found = F.array(*[F.struct(F.lit(n).alias("topic"), keyword_hits(text, w).alias("hits")) for n, w in topics.items()])
    g = rows.select(cluster, F.explode(found).alias("x")).groupBy(cluster, F.col("x.topic").alias("topic")).agg(F.sum("x.hits").alias("hits"))
    best = g.groupBy(cluster).agg(F.min_by(F.struct("topic", "hits"), F.struct((-F.col("hits")).alias("h"), "topic")).alias("r"))
    return best.select(cluster, F.when(F.col("r.hits") == 0, "Other").otherwise(F.col("r.topic")).alias("topic"), F.col("r.hits").alias("votes"))
