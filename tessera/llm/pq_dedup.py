"""Embedding near-dedup by product quantisation: inverted lists, residual codes, table-lookup distances, exact rerank."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, staged


def kmeans(x: np.ndarray, k: int, rounds: int = 10, seed: int = 7) -> np.ndarray:
    """Lloyd's rounds from k distinct rows; an empty cluster takes the row farthest from its centre."""
    rng = np.random.default_rng(seed)
    c = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        d = (c * c).sum(1)[None, :] - 2 * x @ c.T
        at = d.argmin(1)
        far = list(np.argsort(-(d[np.arange(len(x)), at] + (x * x).sum(1))))
        for j in range(len(c)):
            own = x[at == j]
            c[j] = own.mean(0) if len(own) else x[far.pop(0)]
    return c


class Quantiser:
    """Coarse centroids and, for each of m slices of the residual, a codebook; fitted on a bounded sample of unit vectors."""

    def __init__(self, sample: np.ndarray, lists: int, m: int = 16, codes: int = 64):
        self.dim, n = sample.shape[1], len(sample)
        self.coarse = kmeans(sample, min(lists, n))
        self.cuts = np.linspace(0, self.dim, min(m, self.dim) + 1).astype(int)
        rest = sample - self.coarse[self.nearest(sample)]
        self.books = [kmeans(rest[:, a:b], min(codes, n)) for a, b in zip(self.cuts, self.cuts[1:])]
        self.apart = np.sqrt(((self.coarse[:, None, :] - self.coarse[None, :, :]) ** 2).sum(2))

    def _to_coarse(self, u: np.ndarray) -> np.ndarray:
        return (u * u).sum(1)[:, None] + (self.coarse**2).sum(1)[None, :] - 2 * u @ self.coarse.T

    def nearest(self, u: np.ndarray) -> np.ndarray:
        return self._to_coarse(u).argmin(1)

    def encode(self, u: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes and, for each vector, the distance to what its codes stand for."""
        rest = u - self.coarse[lists]
        codes, err = np.zeros((len(u), len(self.books)), np.uint8), np.zeros(len(u))
        for k, (a, b) in enumerate(zip(self.cuts, self.cuts[1:])):
            d = ((rest[:, None, a:b] - self.books[k][None]) ** 2).sum(2) if len(u) * len(self.books[k]) * (b - a) < 1 << 24 else (rest[:, a:b] ** 2).sum(1)[:, None] + (self.books[k] ** 2).sum(1)[None] - 2 * rest[:, a:b] @ self.books[k].T
            codes[:, k] = d.argmin(1)
            err += np.maximum(d.min(1), 0)
        return codes, np.sqrt(err)

    def probes(self, u: np.ndarray, radius: float) -> list[np.ndarray]:
        """All lists that can hold a vector within radius: those whose border with the nearest list is that near."""
        d = self._to_coarse(u)
        first = d.argmin(1)
        gap = (d - d[np.arange(len(u)), first][:, None]) / np.maximum(2 * self.apart[first], 1e-12)
        near = gap <= radius + 1e-9
        near[np.arange(len(u)), first] = True
        return [np.flatnonzero(x) for x in near]

    def distances(self, u: np.ndarray, which: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric distances from each query to each coded vector of one list: sums of table look-ups."""
        rest = u - self.coarse[which]
        total = np.zeros((len(u), len(codes)), np.float32)
        for k, (a, b) in enumerate(zip(self.cuts, self.cuts[1:])):
            table = ((rest[:, None, a:b] - self.books[k][None]) ** 2).sum(2).astype(np.float32)
            total += table[:, codes[:, k]]
        return np.sqrt(total)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow and no vanishing of squares
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _of_length(fitted: dict[int, Quantiser], dim: int, m: int, codes: int) -> Quantiser:
    """The quantiser of a length; for one that the sample lacks, a single list whose codes rule nothing out."""
    return fitted.get(dim) or Quantiser(np.zeros((1, dim)), 1, m, codes)


def search_cell(q: Quantiser, which: int, index: dict, queries: dict, threshold: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """For each query the weight of the index rows linked with it (itself aside), and links that connect what all links connect."""
    radius = np.sqrt(max(0.0, 2 - 2 * threshold))
    count, edges, comp = np.zeros(len(queries["id"]), np.int64), [], np.arange(len(index["id"]))
    for lo in range(0, len(count), 256):
        u = queries["u"][lo : lo + 256]
        near = q.distances(u, which, index["codes"]) <= (radius + index["err"] + 1e-4)[None, :].astype(np.float32)
        cols = np.flatnonzero(near.any(0))
        if not len(cols):
            continue
        link = near[:, cols] & (u @ index["u"][cols].T >= threshold) & (queries["id"][lo : lo + 256, None] != index["id"][cols][None, :])
        count[lo : lo + 256] = link @ index["weight"][cols]
        for i in np.flatnonzero(link.any(1)).tolist():
            own = cols[link[i]]
            names, first = np.unique(comp[own], return_index=True)
            edges += [(int(queries["id"][lo + i]), int(index["id"][own[k]])) for k in first]
            if len(names) > 1:
                comp[np.isin(comp, names)] = names[0]
    return count, edges


def near_copies(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str | None = "label", fit_rows: int = 20_000, rows_a_list: int = 4096, least_lists: int = 8, most_lists: int = 4096, chunk: int = 4096, query_chunk: int = 16_384, m: int = 16, codes: int = 64) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Links: equal, non-null labels (all rows, without label_col) and cosine >= threshold in double precision. Exact:
    probes are all lists that can hold a neighbour, and table distances rule a pair out only beyond the error of
    its codes. Vectors that are null, zero, or hold null or non-finite components link with nothing, nor do rows without
    an id, nor vectors of unequal length with each other. Rows of equal vectors stand in one class and count as vectors
    each. Quantisers, one for each length, are fitted on ``fit_rows`` rows by hash order; every row is indexed. A length has a list for
    ``rows_a_list`` rows, and ``least_lists`` where its sample has 64 rows for each; a length without a row in the sample has one list, whose rows are all
    reranked. A list's rows and queries are dealt out in chunks, so no task holds more than ``chunk`` + ``query_chunk`` vectors.
    """
    spark = vectors.sparkSession
    label = F.col(label_col) if label_col else F.lit(0)
    e = F.col(vec_col).cast("array<double>")
    big = F.lit(1.7976931348623157e308)
    fine = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= big)) & F.exists("e", lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), label.alias("label"), e.alias("e"))
    rows = rows.withColumn("ok", F.coalesce(fine & F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.lit(False)))
    rows = rows.withColumn("k1", F.when(F.col("ok"), F.xxhash64("e"))).withColumn("k2", F.when(F.col("ok"), F.xxhash64(F.lit("again"), "e")))
    good = staged(rows.where("ok").groupBy("label", "k1", "k2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"), F.first("e").alias("e")), "vectors")
    n = good.count()
    found = None
    if n:
        sample = good.orderBy(F.xxhash64("rep"), "rep", "k1").limit(fit_rows).select("e").toArrow().to_pandas()["e"]
        fitted = {}
        for dim, own in sample.groupby(sample.map(len)):
            lists = max(n * len(own) // len(sample) // rows_a_list, min(least_lists, len(own) // 64), 1)
            fitted[int(dim)] = Quantiser(_unit(np.stack(own.to_list())), min(lists, most_lists), m, codes)
        shared = spark.sparkContext.broadcast(fitted)
        radius = np.sqrt(max(0.0, 2 - 2 * threshold))

        def index(batches):
            for every in batches:
                for dim, pdf in every.groupby(every["e"].map(len)):
                    q = _of_length(shared.value, int(dim), m, codes)
                    u = _unit(np.stack(pdf["e"].to_list()))
                    at = q.nearest(u)
                    code, err = q.encode(u, at)
                    yield pd.DataFrame({"rep": pdf["rep"].to_numpy(), "label": pdf["label"].to_numpy(), "weight": pdf["weight"].to_numpy(), "dim": dim, "u": [x.tobytes() for x in u], "list": at, "codes": [x.tobytes() for x in code], "err": err, "probes": q.probes(u, radius)})

        kind = dict(good.dtypes)["label"]
        coded = staged(good.select("rep", "label", "weight", "e").mapInPandas(index, f"rep long, label {kind}, weight long, dim int, u binary, list int, codes binary, err double, probes array<int>"), "codes")
        cell = ["label", "dim", "list"]
        asked = coded.select("label", "dim", F.explode("probes").alias("list"), "rep", "u")
        sizes = coded.groupBy(*cell).agg(F.ceil(F.count("*") / chunk).cast("int").alias("a"))
        sizes = sizes.join(asked.groupBy(*cell).agg(F.ceil(F.count("*") / query_chunk).cast("int").alias("b")), cell)
        none = lambda t, c: F.lit(None).cast(t).alias(c)
        held = coded.join(sizes, cell).select(*cell, F.pmod(F.xxhash64("rep"), "a").cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("b") - 1)).alias("j"), "rep", "u", "weight", "codes", "err")
        asks = asked.join(sizes, cell).select(*cell, F.explode(F.sequence(F.lit(0), F.col("a") - 1)).alias("i"), F.pmod(F.xxhash64("rep"), "b").cast("int").alias("j"), "rep", "u", none("long", "weight"), none("binary", "codes"), none("double", "err"))

        def search(pdf: pd.DataFrame) -> pd.DataFrame:
            q, which = _of_length(shared.value, int(pdf["dim"].iloc[0]), m, codes), int(pdf["list"].iloc[0])
            side = pdf["codes"].notna()
            a, b = pdf[side], pdf[~side]
            mat = lambda s, t, w: np.frombuffer(b"".join(s), t).reshape(len(s), w)
            if a.empty or b.empty:
                return pd.DataFrame({"rep": [], "links": [], "other": []}, dtype="int64")
            ind = {"id": a["rep"].to_numpy(), "u": mat(a["u"], np.float64, q.dim), "codes": mat(a["codes"], np.uint8, len(q.books)), "err": a["err"].to_numpy(), "weight": a["weight"].to_numpy(np.int64)}
            count, edges = search_cell(q, which, ind, {"id": b["rep"].to_numpy(), "u": mat(b["u"], np.float64, q.dim)}, threshold)
            some = np.flatnonzero(count)
            counts = pd.DataFrame({"rep": b["rep"].to_numpy()[some], "links": count[some], "other": b["rep"].to_numpy()[some]})
            return pd.concat([counts, pd.DataFrame({"rep": [x for x, _ in edges], "links": [0] * len(edges), "other": [y for _, y in edges]})]).astype("int64")

        found = staged(held.unionByName(asks).groupBy(*cell, "i", "j").applyInPandas(search, "rep long, links long, other long"), "found")
    if found is None:
        found = spark.createDataFrame([], "rep long, links long, other long")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    comps = components(found.select(F.col("rep").alias("a"), F.col("other").alias("b")), "vectors")
    classes = good.drop("e").join(links, "rep", "left").join(comps, F.col("rep") == F.col("node"), "left")
    classes = classes.select("label", "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = rows.select("vec_id", "label", "k1", "k2").join(classes, ["label", "k1", "k2"], "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
