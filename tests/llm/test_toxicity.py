import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import toxicity


@pytest.mark.parametrize("density", [0.1, 0.9])
def test_block_max_is_exact(density):
    rng = np.random.default_rng(3)
    v = rng.random((300, 40)) * (rng.random((300, 40)) < density)
    v[7] = v[8]
    v[20] = 0
    v /= np.maximum(np.sqrt((v * v).sum(1, keepdims=True)), 1e-12)
    index = toxicity.BlockMax([(np.flatnonzero(x), x[np.flatnonzero(x)]) for x in v], 40, 16)
    for q in range(60):
        terms = np.flatnonzero(v[q])
        for step in (1, 8):
            ids, sims = index.search(terms, v[q][terms], 9, skip=q, step=step)
            s = v @ v[q]
            s[q] = 0
            want = [i for i in np.lexsort((np.arange(300), -np.round(s, 12))) if s[i] > 0][:9]
            assert ids.tolist() == want and np.allclose(sims, s[want])


def brute(docs, labels, k=15):
    """Scores and evidence by dense vectors of every document and all cosines: documents (id, text), labels {id: 0 or 1}."""
    import regex

    def marks(text):
        out = Counter()
        for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()):
            if w:
                out.update({f"<{w}>"[i : i + n] for n in (3, 4, 5) for i in range(len(w) + 3 - n)} | {f"<{w}>"})
        return out

    counts = [marks(t) for _, t in docs]
    ids = sorted(i for i, _ in docs if i in labels and zlib.crc32(str(i).encode()) % 3 != 1)
    at = {i: k for k, (i, _) in enumerate(docs)}
    y = np.array([labels[i] for i in ids])
    seen = {c: Counter(f for i, z in zip(ids, y) if z == c for f in counts[at[i]]) for c in (0, 1)}
    n1, n0 = int(y.sum()), int((1 - y).sum())

    def chi(f):
        a, b = seen[1][f], seen[0][f]
        return (a * n0 - b * n1) ** 2 * (n1 + n0) / (n1 * n0 * (a + b) * (n1 + n0 - a - b) + 1e-9)

    names = sorted(f for f in {*seen[0], *seen[1]} if seen[0][f] + seen[1][f] >= 5 and chi(f) >= max(10.83, 0.01 * (n1 + n0)))
    tf = np.array([[1 + math.log(c[f]) if c[f] else 0.0 for f in names] for c in counts])
    x = tf * (np.log((1 + len(docs)) / (1 + (tf > 0).sum(0))) + 1)
    norm = np.sqrt((x * x).sum(1))
    x = x / np.maximum(norm, 1e-300)[:, None]
    mine = np.array([at[i] for i in ids])
    held = {i: z for i, z in labels.items() if zlib.crc32(str(i).encode()) % 3 != 1}
    prior, rate = sum(held.values()) / len(held), y.mean()
    worth = np.where(y == 1, prior / rate, (1 - prior) / (1 - rate))
    empty = norm[mine] == 0
    bare = (worth * y)[empty].sum() / worth[empty].sum() if empty.any() else prior

    def vote(d, skip=None):
        s = np.round(x[mine] @ x[d], 12)
        if skip is not None:
            s[skip] = 0
        near = [i for i in np.lexsort((np.arange(len(s)), -s)) if s[i] > 0][:k]
        if not near:
            return bare, near
        w = s[near] ** 2 * worth[near]
        return (w * y[near]).sum() / w.sum(), near

    steps = toxicity.isotonic(np.array([vote(d, j)[0] for j, d in enumerate(mine)]), y, worth)
    out = {}
    for d, (i, _) in enumerate(docs):
        raw, near = vote(d)
        out[i] = (float(np.interp(raw, *steps)), [ids[j] for j in near[:5]])
    return out


def test_query_equals_brute_force(spark):
    """Scores and evidence of every document of the smallest tables, labels and all."""
    d = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    y = {r["doc_id"]: r["toxic"] for r in labels.collect() if r["toxic"] in (0, 1)}
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], y)
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    assert set(got) == set(want) and any(e for _, e in want.values())
    for i, (score, evidence) in want.items():
        assert got[i]["score"] == pytest.approx(score, abs=1e-9) and got[i]["evidence"] == evidence


def test_repeated_ids_and_long_text(spark):
    """A repeated id is one example, however many rows it has; a text of 10 MB is scored whole."""
    rows = [(0, "nasty idiot clown"), *[(1, f"fine text {k}") for k in range(50)], (2, "nice words here"), (3, "word " * 2_000_000 + "idiot")]
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 0)], "doc_id long, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = toxicity.toxicity(docs, labels, least_docs=1, least_chi=0.0, least_phi=0.0).collect()
    assert len(got) == 53
    kept, _, _ = toxicity.fit(docs, labels, least_docs=1, least_chi=0.0, least_phi=0.0)
    assert kept.count() == sum(zlib.crc32(str(k).encode()) % 3 != 1 for k in range(3))


def test_counts_equal_brute_force(awkward):
    from conftest import AWKWARD

    names = ["<same>", "tex", "wor", "<wo", "aaaaa", "ö", "<日本語>", "aaa"]
    got = toxicity.Counts(names)(AWKWARD)
    for text, (terms, times) in zip(AWKWARD, got):
        import regex

        want = {}
        for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()):
            for f in toxicity.features_of(w) if w else ():
                if f in names:
                    want[names.index(f)] = want.get(names.index(f), 0) + 1
        assert dict(zip(terms.tolist(), times.tolist())) == want


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    rows = toxicity.toxicity(docs, labels).collect()
    assert len(rows) == docs.count()
    y = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    own = [(r["score"], y[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in y]
    good = [s for s, t in own if t]
    bad = [s for s, t in own if not t]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])
    assert auc > 0.9, auc
    assert sum(s >= 0.7 for s in bad) <= 0.02 * len(bad)


def test_awkward(spark, awkward):
    labels = spark.createDataFrame([(0, 1), (1, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    rows = toxicity.toxicity(awkward.withColumn("score", F.lit("x")), labels).collect()
    assert len(rows) == awkward.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.toxicity(awkward, labels.limit(0)).agg(F.max("score")).first()[0] == 0.0
    assert toxicity.toxicity(awkward.limit(0), labels).count() == 0
