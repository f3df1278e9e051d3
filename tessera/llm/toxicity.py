"""Toxicity from the nearest labelled examples by exact TF-IDF cosine over block-max inverted indexes."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_in, id_out, small_batches, staged
from .pieces import text_chunks, tidy

SPANS = (3, 4, 5)


def features_of(word: str) -> set[str]:
    """A word's marks: itself, and the runs of 3 to 5 characters of it between boundaries. Long words give their runs too."""
    w = f"<{word}>"
    return {w[i : i + n] for n in SPANS for i in range(len(w) - n + 1)} | {w}


def _words(texts: list):
    """Distinct words of a batch, each document's words as indices into them, and where its words end."""
    import pyarrow as pa
    import pyarrow.compute as pc

    t = pc.utf8_lower(pc.fill_null(pa.array(texts, pa.string()), ""))
    cut = pc.split_pattern_regex(t, r"[^\p{L}\p{N}]+")
    coded = cut.flatten().dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(), cut.offsets.to_numpy() - cut.offsets[0].as_py()


class Counts:
    """Counts of selected features in texts; the features of known words are kept, up to most_words of them."""

    def __init__(self, names: list[str], most_words: int = 150_000):
        self.index, self.most_words, self.known = {f: k for k, f in enumerate(names)}, most_words, {}

    def __call__(self, texts: list) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text the ascending feature numbers and how often they occur."""
        if len(self.known) > self.most_words:
            self.known.clear()
        names, at, bounds = _words(texts)
        for w in names:
            if w not in self.known:
                self.known[w] = tuple(self.index[f] for f in features_of(w) if f in self.index) if w else ()
        has = [self.known[w] for w in names]
        n = np.fromiter(map(len, has), np.int64, len(has))
        flat, start = np.array([f for h in has for f in h], np.int64), np.cumsum(n) - n
        out, v = [], len(self.index)
        used = n[at] > 0  # most words have none
        doc = np.repeat(np.arange(len(texts)), np.diff(bounds))[used]
        at = at[used]
        lens = n[at]
        ends = np.cumsum(lens)
        f = flat[np.arange(int(lens.sum())) + np.repeat(start[at] - (ends - lens), lens)] if len(at) else np.zeros(0, np.int64)
        key, times = np.unique(np.repeat(doc, lens) * v + f, return_counts=True)
        cut = np.searchsorted(key, np.arange(len(texts) + 1) * v)
        for a, b in zip(cut, cut[1:]):
            out.append((key[a:b] % v if b > a else key[a:b], times[a:b]))
        return out


class BlockMax:
    """Examples in blocks; per block the posting list of every term, and per term and block the greatest weight.

    search() takes blocks by falling upper bound, a few at a time, and stops where the next one's bound is below the k-th best, so
    it is exact. Only postings of the query's own terms are read.
    """

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int, size: int = 64):
        self.n, self.size, self.n_terms = len(vectors), size, max(1, n_terms)
        # like examples stand together, by their heaviest term, so bounds are sharp
        heavy = np.array([t[w.argmax()] if len(t) else -1 for t, w in vectors], np.int64)
        self.order = np.lexsort((np.array([w.sum() for _, w in vectors]), heavy))
        n_blocks = -(-self.n // size)
        lens = np.array([len(vectors[i][0]) for i in self.order], np.int64)
        none = [np.zeros(0)]
        term = np.concatenate([*(vectors[i][0] for i in self.order), *none]).astype(np.int64)
        weight = np.concatenate([*(vectors[i][1] for i in self.order), *none])
        place = np.repeat(np.arange(self.n), lens)
        cell = place // size * self.n_terms + term
        by = np.lexsort((place, cell))
        self.place, self.weight, cell = place[by].astype(np.int32), weight[by], cell[by]
        #: Where the postings of each block and term begin; they end where the next ones begin.
        self.start = np.searchsorted(cell, np.arange(n_blocks * self.n_terms + 1)).astype(np.int32)
        self.greatest = np.zeros((n_blocks, self.n_terms))
        np.maximum.at(self.greatest.reshape(-1), cell, self.weight)
        self.greatest = np.ascontiguousarray(self.greatest.T)

    def _scores(self, blocks: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of these blocks' examples with a common term, and their cosines."""
        cell = (blocks[:, None] * self.n_terms + terms[None, :]).ravel()
        begin = self.start[cell]
        lens = self.start[cell + 1] - begin
        ends = np.cumsum(lens)
        at = np.arange(int(ends[-1])) + np.repeat(begin - (ends - lens), lens)
        slot = np.repeat(np.repeat(np.arange(len(blocks)), len(terms)), lens) * self.size + self.place[at] % self.size
        s = np.bincount(slot, self.weight[at] * np.repeat(np.tile(weights, len(blocks)), lens), len(blocks) * self.size)
        some = np.flatnonzero(s > 0)
        return blocks[some // self.size] * self.size + some % self.size, s[some]

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, skip: int = -1, step: int = 8) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest examples with positive cosine (ties: the smaller number), nearest first, and their cosines."""
        bound = weights @ self.greatest[terms]
        queue = np.argsort(-bound, kind="stable")
        queue = queue[bound[queue] > 0]
        ids, sims, least = np.zeros(0, np.int64), np.zeros(0), 0.0
        while len(queue):
            if len(ids) == k:
                queue = queue[: np.searchsorted(-bound[queue], -(least - 1e-12), side="right")]
                if not len(queue):
                    break
            place, s = self._scores(queue[:step], terms, weights)
            queue = queue[step:]
            own = self.order[place]
            good = (s >= least - 1e-12) & (own != skip)
            ids, sims = np.concatenate([ids, own[good]]), np.concatenate([sims, s[good]])
            best = np.lexsort((ids, -np.round(sims, 12)))[:k]
            ids, sims = ids[best], sims[best]
            least = sims[-1] if len(ids) == k else 0.0
        return ids, sims


class Model:
    """Feature names and idf, the examples' index, labels and ids, class weights, and the calibration steps."""

    def __init__(self, names, idf, counts, labels, ids, prior: float, k: int = 15):
        self.names, self.idf, self.labels, self.ids, self.k = names, idf, labels, ids, k
        rate = labels.mean() if len(labels) else 0.0
        self.prior = prior
        # examples are drawn evenly from both classes; votes count as in the labelled rows
        self.worth = np.where(labels == 1, prior / max(rate, 1e-9), (1 - prior) / max(1 - rate, 1e-9)) if 0 < rate < 1 else np.ones(len(labels))
        self.index = BlockMax([self.vector(t, c) for t, c in counts], len(names))
        self.steps = (np.zeros(0), np.zeros(0))
        bare = np.array([not len(t) for t, _ in counts], bool)
        self.bare = float((self.worth * labels)[bare].sum() / self.worth[bare].sum()) if bare.any() else prior
        raw = np.array([self.vote(*self.vector(*counts[i]), skip=i)[0] for i in range(len(labels))])
        self.steps = isotonic(raw, labels, self.worth)

    def vector(self, terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = (1 + np.log(np.maximum(counts, 1))) * self.idf[terms]
        norm = np.sqrt((w * w).sum())
        return terms, w / norm if norm > 0 else w

    def vote(self, terms, weights, skip: int = -1) -> tuple[float, np.ndarray]:
        """The share of toxic votes, nearer examples weighing more; without a neighbour, the rate of texts without features."""
        if not len(terms) or not weights.any():
            return self.bare, np.zeros(0, np.int64)
        near, sims = self.index.search(terms, weights, self.k, skip)
        if not len(near):
            return self.bare, near
        w = sims * sims * self.worth[near]
        return float((w * self.labels[near]).sum() / w.sum()), near

    def score(self, terms, counts) -> tuple[float, list[int]]:
        raw, near = self.vote(*self.vector(terms, counts))
        x, y = self.steps
        return float(np.interp(raw, x, y)) if len(x) else self.prior, self.ids[near[:5]].tolist()


def isotonic(raw: np.ndarray, labels: np.ndarray, worth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising steps of the weighted toxic rate by raw vote (pool adjacent violators), drawn a little to the middle."""
    if not len(raw):
        return np.zeros(0), np.zeros(0)
    order = np.argsort(raw, kind="stable")
    pools: list[list[float]] = []  # raw low, raw high, weight, toxic weight
    for r, y, w in zip(raw[order], labels[order], worth[order]):
        if pools and pools[-1][1] == r:
            pools[-1][2] += w
            pools[-1][3] += w * y
        else:
            pools.append([r, r, w, w * y])
        while len(pools) > 1 and pools[-2][3] * pools[-1][2] >= pools[-1][3] * pools[-2][2]:
            _, high, w1, t1 = pools.pop()
            pools[-1][1], pools[-1][2], pools[-1][3] = high, pools[-1][2] + w1, pools[-1][3] + t1
    x, y = [], []
    for low, high, w, t in pools:
        p = (t + 0.5 * worth.min()) / (w + worth.min())
        x += [low, high] if high > low else [low]
        y += [p, p] if high > low else [p]
    return np.array(x), np.array(y)


def held_out(id_column: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = 4000, least_phi: float = 0.1, least_chi: float = 10.83, least_docs: int = 5, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"):
    """Examples, features and class weights from labelled rows that are not held out.

    At most ``fit_rows`` examples, half of either class, the first by hash of their id (of repeated ids the least text). Features
    are all that ``least_docs`` examples have and that go with a class, by document counts in the examples: a phi coefficient of
    ``least_phi`` (a small effect, whatever the number of examples) and a chi square of ``least_chi`` (one wrong in a thousand).
    Their number has no limit but the examples. Only class totals come from all labels.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    known = staged(known.groupBy(F.col(id_col).cast("long").alias("d")).agg(F.max(F.col(label_col)).cast("int").alias("y")), "labels")
    total = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}  # two rows
    prior = total.get(1, 0) / max(1, sum(total.values()))
    part = lambda y: known.where(F.col("y") == y).orderBy(F.xxhash64("d"), "d").limit(fit_rows // 2)
    chosen = part(1).unionByName(part(0))
    rows = docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).cast("string").alias("t")).join(F.broadcast(chosen), "d")
    rows = staged(rows.groupBy("d").agg(F.max("y").alias("y"), F.min("t").alias("t")), "examples")  # a row an id

    def occur(batches):
        seen: Counter = Counter()
        for pdf in batches:
            y = pdf["y"].to_numpy()
            for lo, hi in text_chunks(pdf["t"].tolist()):
                names, at, bounds = _words(pdf["t"].iloc[lo:hi].tolist())
                for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    own = set()
                    for w in set(at[a:b].tolist()):
                        if names[w]:
                            own |= features_of(names[w])
                    seen.update((f, int(y[lo + k])) for f in own)
        if seen:
            yield pd.DataFrame({"f": [f for f, _ in seen], "y": [y for _, y in seen], "n": list(seen.values())})

    counts = rows.mapInPandas(occur, "f string, y int, n long").groupBy("f").agg(F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("b"))
    n = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n1, n0 = float(n.get(1, 0)), float(n.get(0, 0))
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    chi = F.try_divide((a * n0 - b * n1) ** 2 * (n1 + n0), n1 * n0 * (a + b) * (n1 + n0 - a - b) + F.lit(1e-9))
    names = sorted(r["f"] for r in counts.where((a + b >= least_docs) & (chi >= max(least_chi, least_phi**2 * (n1 + n0)))).select("f").collect()) if n1 and n0 else []  # of fit_rows texts
    return rows, names, prior


def toxicity(docs: DataFrame, labels: DataFrame, fit_rows: int = 4000, least_phi: float = 0.1, least_chi: float = 10.83, least_docs: int = 5, k: int = 15, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, evidence (ids of its nearest examples).

    Inverse document frequencies are counted over all documents. Null and empty texts and texts without a feature get
    the rate of such examples. Null ids are never held out. Without labels of both classes every score is the rate of
    toxic labels (0 without labels). Repeated rows are scored each.
    """
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    rows, names, prior = fit(docs, labels, fit_rows, least_phi, least_chi, least_docs, id_col, text_col, label_col)
    shared_names = spark.sparkContext.broadcast(names)

    def count(batches):
        counts = Counts(shared_names.value)
        yield from counted(batches, counts)
        counts.known.clear()  # the worker lives on
        tidy()

    def counted(batches, counts):
        for pdf in batches:
            texts = pdf["t"].tolist()
            for lo, hi in text_chunks(texts, 1_000_000):
                got = counts(texts[lo:hi])
                yield pd.DataFrame({"doc_id": pdf["d"].iloc[lo:hi].values, "terms": [t.astype(np.int32) for t, _ in got], "times": [c.astype(np.int32) for _, c in got]})

    vectors = staged(docs.select(id_in(id_col).alias("d"), F.col(text_col).cast("string").alias("t")).mapInPandas(count, "doc_id long, terms array<int>, times array<int>"), "vectors")
    df = np.zeros(max(1, len(names)))

    def occur(batches):
        n = np.zeros(len(df), np.int64)
        for pdf in batches:
            n += np.bincount(np.concatenate([*pdf["terms"], np.zeros(0, np.int32)]), minlength=len(df))
        some = np.flatnonzero(n)
        yield pd.DataFrame({"f": some, "n": n[some]})

    for r in vectors.select("terms").mapInPandas(occur, "f long, n long").groupBy("f").agg(F.sum("n").alias("n")).collect():  # a row per feature
        df[r["f"]] = r["n"]
    idf = np.log((1 + vectors.count()) / (1 + df)) + 1
    examples = rows.select("d", "y", "t").toArrow().to_pandas().sort_values("d")  # at most fit_rows
    own = Counts(names)
    got = [own([t])[0] for t in examples["t"]] if names else [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(examples)
    shared = spark.sparkContext.broadcast(Model(names, idf, got, examples["y"].to_numpy(np.int64), examples["d"].to_numpy(np.int64), prior, k))

    def score(batches):
        model, seen = shared.value, {}
        for pdf in batches:
            scores, near = [], []
            for t, c in zip(pdf["terms"], pdf["times"]):
                key = (t.tobytes(), c.tobytes())
                if key not in seen:
                    if len(seen) > 20_000:
                        seen.clear()
                    seen[key] = model.score(t.astype(np.int64), c)
                scores.append(seen[key][0])
                near.append(seen[key][1])
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "score": scores, "evidence": near})
        del model, seen
        tidy()

    # the vectors are few bytes in few files; dealt anew, as many tasks score them as read the documents
    spread = vectors.repartition(max(1, len(vectors.inputFiles())))
    out = spread.mapInPandas(score, "doc_id long, score double, evidence array<long>").withColumn("doc_id", id_out("doc_id"))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "evidence")


__all__ = ["BlockMax", "Counts", "Model", "features_of", "fit", "held_out", "isotonic", "toxicity"]
