import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import jaccard
from tessera.llm.common import components


def shingles(text, n=4):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)})) if x]
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def classes(rows, num=85, den=100):
    sets = [(d, shingles(t)) for d, t in rows]
    low = {d: d for d, _ in sets}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for i, (d, a) in enumerate(sets):
        for e, b in sets[:i]:
            if a and b and den * len(a & b) >= num * len(a | b):
                x, y = find(d), find(e)
                low[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets}


def corpus(seed=1, n=160):
    rng = np.random.default_rng(seed)
    word = lambda: "w" + str(rng.integers(0, 3000))
    shared = " ".join(word() for _ in range(60))
    docs = []
    for _ in range(n):
        kind = rng.integers(0, 6)
        if kind < 2 or not docs:
            t = [word() for _ in range(rng.integers(1, 120))]
        elif kind == 2:
            t = [word() for _ in range(rng.integers(1, 60))] + shared.split()
        else:
            t = docs[rng.integers(0, len(docs))].split()
            for _ in range(rng.integers(0, 6)):
                t[rng.integers(0, len(t))] = word()
            t = t[: len(t) - rng.integers(0, 3)] or ["x"]
        docs.append(" ".join(t))
    return docs


@pytest.mark.parametrize("chunk,bits", [(1_000_000, 27), (300, 12)])
def test_equals_brute_force(spark, chunk, bits):
    rows = [(7 * k + 3, t) for k, t in enumerate(corpus())] + [(5000, ""), (5001, None), (5002, " \n"), (5003, "One two"), (5004, "one  TWO"), (5005, "one two three"), (5006, "É a b c"), (5007, "é a b c")]
    want = classes(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_shingles", F.lit("clash")).repartition(5)
    got = jaccard.ngram_classes(df, n=4, num=85, chunk_tokens=chunk, table_bits=bits).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert len({v[1] for v in want.values()}) < len(want) - 20


def test_long_texts(spark):
    """Texts of 10 MB link by all their shingles: a copy, one with a fortieth of its words changed, and one with a tenth."""
    words = [f"w{k * k % 300_007}" for k in range(1_500_000)]
    changed = lambda n: " ".join(words[: -len(words) // n] + [f"v{k}" for k in range(len(words) // n)])
    rows = [(1, " ".join(words)), (2, " ".join(words)), (3, changed(40)), (4, changed(10)), (5, "short one")]
    assert min(len(t) for _, t in rows[:4]) > 10_000_000
    sets = {d: set(zip(*(t.split()[k:] for k in range(4)))) or {tuple(t.split())} for d, t in rows}
    want = {d: min(x for x in sets if 100 * len(sets[x] & sets[d]) >= 85 * len(sets[x] | sets[d])) for d in sets}
    got = jaccard.ngram_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {d: (len(sets[d]), want[d]) for d in sets}
    assert want == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5}


def test_trie_forest():
    rng = np.random.default_rng(2)
    for _ in range(40):
        base = [rng.choice(60, rng.integers(1, 40), replace=False) for _ in range(4)]
        sets = []
        for _ in range(25):
            s = set(base[rng.integers(0, 4)].tolist())
            for _ in range(rng.integers(0, 4)):
                s ^= {int(rng.integers(0, 60))}
            sets.append(np.array(sorted(s), np.uint64))
        low = list(range(25))
        for i in range(25):
            for j in range(i):
                a, b = set(sets[i].tolist()), set(sets[j].tolist())
                if a and b and 100 * len(a & b) >= 80 * len(a | b):
                    x, y = low[i], low[j]
                    low = [min(x, y) if v in (x, y) else v for v in low]
        got = list(range(25))
        for i, j in jaccard.trie_links(sets, 80, 100):
            assert 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))
            x, y = got[i], got[j]
            got = [min(x, y) if v in (x, y) else v for v in got]
        assert got == low


def test_awkward(spark, awkward):
    rows = jaccard.ngram_classes(awkward).collect()
    assert len(rows) == awkward.count()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r["component_id"])
    assert by[None] == [None] and by[14] == [13, 13] and by[13] == [13] and by[1] == [1]
    assert jaccard.ngram_classes(awkward.limit(0)).count() == 0


@pytest.mark.parametrize("small", [0, 10_000])
def test_components(spark, small):
    rng = np.random.default_rng(4)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(1000 + k, 1001 + k) for k in range(60)] + [(2000, 2000 + k) for k in range(50)]
    low = {x: x for e in edges for x in e}
    for _ in range(len(low)):
        moved = False
        for a, b in edges:
            m = min(low[a], low[b])
            moved |= low[a] != m or low[b] != m
            low[a] = low[b] = m
        if not moved:
            break
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), "t", small=small).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: c for x, c in low.items() if x in linked}


def test_chance_ngrams_connect_nothing(spark, monkeypatch):
    """N-grams repeated by chance, more than the bit tables hold, make no block of unlike texts; near copies stay linked."""
    rng = random.Random(11)
    docs = [[f"w{rng.randrange(12)}" for _ in range(rng.choice([60, 90, 120]))] for _ in range(240)]
    docs += [[*d[:50], "odd", *d[51:]] for d in docs[:20]] + [d[:-3] for d in docs[20:30]]
    grams = [{tuple(d[k : k + 4]) for k in range(len(d) - 3)} for d in docs]
    want = list(range(len(docs)))
    for b in range(len(docs)):
        for a in range(b):
            if want[a] != want[b] and 100 * len(grams[a] & grams[b]) >= 85 * len(grams[a] | grams[b]):
                want = [want[a] if x == want[b] else x for x in want]
    seen = {}
    monkeypatch.setattr(jaccard, "components", lambda edges, name: seen.setdefault(name, components(edges, name)))
    df = spark.createDataFrame([(k, " ".join(d)) for k, d in enumerate(docs)], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard.ngram_classes(df, n=4, num=85, den=100, table_bits=14).collect()}
    assert [got[k] for k in range(len(docs))] == want and len(set(want)) == 240
    assert seen["blocks"].groupBy("component").count().agg({"count": "max"}).first()[0] < 20
