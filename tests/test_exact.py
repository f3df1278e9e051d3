"""Searches and graph metrics against brute force, with nulls, ties and repeated rows."""

import random
from difflib import SequenceMatcher

import numpy as np
import pytest

from tessera.operators import entity, graph, vectors


def normal(x):
    import re

    from tessera.functions.text import SUFFIXES

    x = x.lower().strip(" ")
    for s in SUFFIXES:
        x = re.sub(s, "", x)
    return re.sub(r"\s+", " ", x).strip(" ")


def test_fuzzy_best_loses_no_pair(spark):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abcdeimnorst ") for _ in range(n)).strip()
    known = [word(rng.randint(1, 24)) for _ in range(150)] + ["microsoft", "a", "ab", "International Business Machines Corp.", "International Business Machine"]

    def typo(x):
        x = list(x)
        for _ in range(rng.randint(0, max(1, len(x) // 8))):
            at = rng.randrange(len(x) + 1)
            x[at : at + rng.randint(0, 1)] = rng.choice(["", "q", "e", "ts"])
        return "".join(x)

    names = [typo(x) for x in known for _ in range(4)] + ["microsft", "mikrosoft", None, "", "a", "Intrnational Busines Machines, Inc."]
    a = spark.createDataFrame([(n,) for n in names] + [("a",)], "name string")
    b = spark.createDataFrame([(n, k) for k, n in enumerate(known)] + [("", 900), (None, 901)], "name string, entity long")
    got = {r["name"]: (r["entity"], r["ratio"]) for r in entity.fuzzy_best(a, b, "name", "entity").collect()}
    want = {}
    for n in {x for x in names if x}:
        for k, m in enumerate(known):
            x, y = normal(n), normal(m)
            r = SequenceMatcher(None, x, y).ratio() if x and y else 0.0
            if r >= 0.85 and (n not in want or r > want[n][1]):
                want[n] = (k, r)
    assert got == want and len(want) > 300
    with pytest.raises(ValueError):
        entity.fuzzy_best(a, b, "name", "entity", least=0.5)


def test_fuzzy_best_in_groups(spark):
    a = spark.createDataFrame([("acme widgets", "x"), ("acme widgets", "y"), ("acme widgets", None)], "name string, kind string")
    b = spark.createDataFrame([("acme widget", "x", 7), ("acme widgets", "z", 1)], "name string, kind string, entity long")
    assert [(r["name"], r["kind"], r["entity"]) for r in entity.fuzzy_best(a, b, "name", "entity", "kind").collect()] == [("acme widgets", "x", 7)]


def serial_groups(rows, cores):
    """One loop over the names of a group: {(group, text): (canonical, confidence)}."""
    out = {}
    for g in {r[0] for r in rows}:
        best = {}
        for _, t, x in (r for r in rows if r[0] == g and r[1] is not None):
            best[t] = x if best.get(t) is None else best[t] if x is None else max(x, best[t])
        lead, to = [], {}
        for t in sorted(best, key=lambda t: (-len(t), t)):
            (core, v) = cores[t]
            to[t] = next((h for h in lead if entity.same_entity(cores[h][0], core) or cores[h][1] == v), t)
            if to[t] == t:
                lead.append(t)
        for t, h in to.items():
            out[g, t] = (h, max((best[k] for k in to if to[k] == h and best[k] is not None), default=None))
    return out


@pytest.mark.parametrize("small", [0, 200_000])
def test_greedy_groups_equal_the_loop(spark, small):
    from tessera.functions.text import core_name, spelling

    rng = random.Random(4)
    words = ["acme", "global", "north", "partners", "bio", "sciences", "gen", "data", "a", "ab", "Müller", "日本", "s&p", "the", "first-rate", "über"]
    tails = ["", " Inc.", " Corp", " Holdings", ", LLC", " Group", "!"]
    rows = []
    for k in range(700):
        name = " ".join(rng.choice(words) for _ in range(rng.randint(1, 4)))
        if rng.random() < 0.4:
            at = rng.randrange(len(name))
            name = name[:at] + rng.choice(["", "x", name[at].upper(), " ", "&"]) + name[at + rng.randint(0, 1) :]
        if rng.random() < 0.1:
            name = "".join(w[0] for w in name.split())
        rows.append((rng.choice(["g", "g", "h", None]), name + rng.choice(tails), rng.choice([None, 0.25, 0.5, 0.75])))
    rows += [("g", t, 0.5) for t in ("", " ", "!", "日", "日本", "é", "é é", "aa bb", "a-b", "A.B.", "x" * 300, "x" * 299 + "y")] + [("g", None, 1.0), ("one", "alone", None)] + rows[:20]
    df = spark.createDataFrame(rows, "kind string, t string, s double").repartition(5)
    own = spark.createDataFrame([(t,) for t in {r[1] for r in rows} if t is not None], "t string")
    core = core_name("t", entity.SUFFIX_WORDS)
    cores = {r["t"]: (r["c"], r["v"]) for r in own.select("t", core.alias("c")).withColumn("v", spelling("c")).collect()}
    got = entity.greedy_groups(df, ["kind"], "t", "s", small=small).collect()
    assert {(r["kind"], r["text"]): (r["canonical"], r["confidence"]) for r in got} == serial_groups(rows, cores)
    assert len(got) == len({(g, t) for g, t, _ in rows if t is not None})
    assert entity.greedy_groups(df.limit(0), ["kind"], "t", "s", small=small).count() == 0


def test_first_leaders_of_chains_and_cliques(spark):
    rng = random.Random(6)
    n = 80
    edges = {(a, a + 1) for a in range(0, 12)} | {tuple(sorted(rng.sample(range(n), 2))) for _ in range(90)}
    members = [(1, k) for k in range(20, 40)] + [(2, k) for k in range(35, 50, 3)]
    near = {k: {a for a, b in edges if b == k} | {j for c, j in members for d, i in members if c == d and i == k and j < k} for k in range(n)}
    want = set()
    for k in range(n):
        if not near[k] & want:
            want.add(k)
    frame = lambda rows, schema: spark.createDataFrame(sorted(rows), schema)
    for small in (0, 40, 10_000):
        got = entity.first_leaders(frame([(k,) for k in range(n)], "id long"), frame(edges, "a long, b long"), frame(members, "c long, id long"), small)
        assert sorted(r["id"] for r in got.collect()) == sorted(want)


def vector_rows(n=400, dim=12, seed=5):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dim)) + 4 * rng.normal(size=(8, dim))[rng.integers(0, 8, n)]
    v[7] = v[3]
    rows = [(k, [float(x) for x in row]) for k, row in enumerate(v)]
    return rows + [(n, None), (n + 1, [0.0] * dim), (n + 2, [float("nan")] * dim), (n + 3, [None] * dim), (n + 4, [1.0, 0.0]), (n + 5, [2.0, 0.0])]


def cosines(rows):
    unit = {k: np.array(v) / np.linalg.norm(v) for k, v in rows if v and None not in v and np.isfinite(v).all() and any(v)}
    return {(a, b): float(unit[a] @ unit[b]) for a in unit for b in unit if a != b and len(unit[a]) == len(unit[b])}


def test_cosine_top(spark):
    rows = vector_rows()
    df = spark.createDataFrame(rows, "id long, v array<double>")
    sims = cosines(rows)
    for size in (7, 2048):
        got = {}
        for r in vectors.cosine_top(df, df.where("id % 50 = 0 OR id > 398"), "id", "v", 5, size, 3).collect():
            got.setdefault(r["query"], []).append((r["place"], r["id"], r["similarity"]))
        want = {}
        for q in {a for a, _ in sims if a % 50 == 0 or a > 398}:
            best = sorted((-round(s, 6), b) for (a, b), s in sims.items() if a == q)[:5]
            want[q] = [(i + 1, b, -s) for i, (s, b) in enumerate(best)]
        assert {k: [(p, i, pytest.approx(s)) for p, i, s in sorted(v)] for k, v in got.items()} == want


def test_reuse_asks_every_vector(spark):
    rows = vector_rows()
    df = spark.createDataFrame(rows, "id long, v array<double>")
    sims = cosines(rows)
    for size in (16, 2048):  # many lists and chunks, and one
        got = {r["id"]: r["found"] for r in vectors.first_within(df, "id", "v", 0.8, rows_a_list=size, chunk=size).collect()}
        want = {}
        for (a, b), s in sims.items():
            if s >= 0.8:
                want[a] = min(b, want.get(a, b))
        assert got == want and len(want) > 100
        got = {r["id"]: r["found"] for r in vectors.first_within(df, "id", "v", 0.8, rows_a_list=size, chunk=size, smaller=True).collect()}
        assert got == {k: x for k, x in want.items() if x < k}
    out = {r["id"]: (r["keyword"], r["reused"]) for r in vectors.reuse(df, "id", "v").collect()}
    assert out == {k: (want[k], True) if want.get(k, k) < k else (k, False) for k, _ in rows}
    assert vectors.reuse(df.limit(0), "id", "v").count() == 0


def test_no_vector_is_shuffled_to_the_lists_it_asks(spark):
    """Without clusters every list is asked; vectors are read in blocks, so disk grows with the vectors, not with the lists. Keys of any kind."""
    v = np.random.default_rng(4).normal(size=(300, 6))
    rows = [(f"{k:04}", x.tolist()) for k, x in enumerate(v)]
    df = spark.createDataFrame(rows, "id string, v array<double>")
    found = vectors.first_within(df, "id", "v", rows_a_list=16, chunk=16, smaller=True)
    above, below = found._jdf.queryExecution().executedPlan().toString().split("MapInPandas", 1)
    assert "Exchange" in above and "Exchange" not in below
    want = {}
    for (a, b), s in cosines(rows).items():
        if s >= 0.8 and b < a:
            want[a] = min(b, want.get(a, b))
    assert {r["id"]: r["found"] for r in found.collect()} == want and want


def test_residual_bounds_spare_pairs(spark):
    """Vectors that lie apart are seldom compared in all coordinates; a crowd of copies is, and loses nothing."""
    rng = np.random.default_rng(23)
    apart = [(k, v.tolist()) for k, v in enumerate(rng.normal(size=(600, 64)))]
    work = vectors.pairs_compared(spark.createDataFrame(apart, "id long, v array<double>"), "id", "v").first()
    assert work["met"] == 600 * 600 and work["compared"] < work["met"] // 50
    crowd = spark.createDataFrame([(k, apart[k % 3][1]) for k in range(3000)], "id long, v array<double>")
    got = {r["id"]: r["found"] for r in vectors.first_within(crowd, "id", "v", smaller=True).collect()}
    assert got == {k: k % 3 for k in range(3, 3000)}


def test_hubs_and_labels(spark):
    edges = [(1, 2, 1), (1, 3, 1), (2, 4, 1), (3, 4, 1), (4, 9, 1), *[(k, 4, 1) for k in range(20, 26)], (30, 31, 9), (31, 32, 9), (32, 30, 9)]
    df = spark.createDataFrame(edges, "src long, dst long, weight long")
    assert [(r["target"], r["path"], r["length"]) for r in graph.hub_paths(df, 1).collect()] == [(4, [1, 2, 4], 2)]
    assert graph.hub_paths(df, 99).count() == 0
    labels = {r["node"]: r["community"] for r in graph.label_propagation(df).collect()}
    assert labels[30] == labels[31] == labels[32] and labels[30] != labels[4] and len(labels) == 14


def test_best_of_ten_clusterings(spark):
    """No worse than the best of ten serial runs; confidences from the centres; bad vectors take no part."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 5)) + 5 * rng.normal(size=(8, 5))[rng.integers(0, 8, 300)]
    rows = [(k, [float(y) for y in v]) for k, v in enumerate(x)] + [(900, None), (901, [float("nan")] * 5), (902, [1.0]), (903, [None] * 5)]
    df = spark.createDataFrame(rows, "id long, v array<double>").repartition(3)
    best = np.inf
    for c in entity._starts(x, 8, 10, 1):
        for _ in range(60):
            a = ((x[:, None] - c) ** 2).sum(axis=2).argmin(axis=1)
            c = np.array([x[a == j].mean(axis=0) if (a == j).any() else c[j] for j in range(8)])
        best = min(best, ((x[:, None] - c) ** 2).sum(axis=2).min(axis=1).sum())
    centres, inertia = entity.kmeans_centres(df, "v")
    d = np.sqrt(((x[:, None] - np.array(sorted(centres.tolist()))) ** 2).sum(axis=2))
    assert inertia <= best * 1.001 and inertia == pytest.approx((d.min(axis=1) ** 2).sum())
    got = {r["id"]: (r["cluster"], r["confidence"]) for r in entity.kmeans_topics(df, "id", "v").collect()}
    assert set(got) == set(range(300))
    for k in range(300):
        assert got[k] == (d[k].argmin(), pytest.approx(1 - d[k].min() / d.min(axis=1).max()))
    assert entity.kmeans_topics(df.limit(0), "id", "v").count() == 0
