"""Exact searches over vectors in matrix products: nearest neighbours of a query set, and all neighbours within a cosine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.sources.staging import cut


#: Options to write rows of some MB: groups of 32 MB, whose size is looked at after every row.
WIDE_ROWS = {"parquet.block.size": str(32 << 20), "parquet.page.size.row.check.min": "1"}


def _unit_rows(df: DataFrame, key: str, vec: str) -> DataFrame:
    """(id, u): vectors of length 1 in doubles; null and zero ones and those with null or non-finite components are left out."""
    v = F.col(vec).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= 1.7976931348623157e308)) & F.exists(v, lambda x: x != 0)
    rows = df.select(F.col(key).alias("id"), v.alias("v")).where(F.coalesce(fine, F.lit(False)) & F.col("id").isNotNull())
    top = F.aggregate("v", F.lit(0.0), lambda s, x: F.greatest(s, F.abs(x)))
    rows = rows.select("id", "v", top.alias("_top")).select("id", F.transform("v", lambda x: x / F.col("_top")).alias("v"))  # no overflow of squares
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    return rows.select("id", "v", norm.alias("_norm")).select("id", F.transform("v", lambda x: x / F.col("_norm")).alias("u"))


def _matrix(rows) -> np.ndarray:
    return np.stack([np.frombuffer(x, np.float64) for x in rows]) if len(rows) else np.zeros((0, 0))


def _blocks(df: DataFrame, kind: str, size: int) -> DataFrame:
    """(dim, ids, u): up to ``size`` unit vectors of one length a row, as bytes."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}
        for pdf in batches:
            for k, u in zip(pdf["id"], pdf["u"]):
                own = held.setdefault(len(u), [])
                own.append((k, np.asarray(u, np.float64)))
                if len(own) == size:
                    yield pd.DataFrame([_block(len(u), held.pop(len(u)))])
        for dim, own in held.items():
            yield pd.DataFrame([_block(dim, own)])

    return df.mapInPandas(pack, f"dim int, ids array<{kind}>, u binary")


def _block(dim: int, rows: list) -> dict:
    return {"dim": dim, "ids": [k for k, _ in rows], "u": np.concatenate([u for _, u in rows]).tobytes()}


def cosine_top(vectors: DataFrame, queries: DataFrame, key: str, vec: str, k: int, size: int = 2048, parts: int = 64) -> DataFrame:
    """The k nearest others of each query vector by exact cosine (6 digits; ties to the smaller id): query, key, similarity, place.

    Vectors and queries meet in blocks of ``size``, a matrix product each, that emits k rows a query; no pair is a row. Blocks of
    vectors are dealt into ``parts``, each of which reads all blocks of queries as a stream; nothing is broadcast by force.
    Vectors of another length than the query's and those without a direction are nobody's neighbours.
    """
    kind = dict(vectors.dtypes)[key]
    q = _blocks(_unit_rows(queries, key, vec), kind, size).select("dim", F.col("ids").alias("q_ids"), F.col("u").alias("q_u"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    met = _blocks(_unit_rows(vectors, key, vec), kind, size).withColumn("part", F.pmod(F.xxhash64("ids"), F.lit(parts)).cast("int")).join(q, ["dim", "part"])

    def best(batches):
        for pdf in batches:
            for dim, ids, u, q_ids, q_u in zip(pdf["dim"], pdf["ids"], pdf["u"], pdf["q_ids"], pdf["q_u"]):
                ids, q_ids = np.asarray(ids), np.asarray(q_ids)
                s = np.round(np.frombuffer(q_u).reshape(-1, dim) @ np.frombuffer(u).reshape(-1, dim).T, 6)
                s[q_ids[:, None] == ids[None, :]] = -2.0
                order = np.argsort(ids, kind="stable")  # of equal similarity the smaller id
                top = order[np.argsort(-s[:, order], axis=1, kind="stable")[:, :k]]
                at = np.repeat(np.arange(len(q_ids)), top.shape[1])
                out = pd.DataFrame({"query": q_ids[at], key: ids[top.ravel()], "similarity": s[at, top.ravel()] + 0.0})
                yield out[out["similarity"] > -2.0]

    found = met.mapInPandas(best, f"query {kind}, {key} {kind}, similarity double")
    w = Window.partitionBy("query").orderBy(F.desc("similarity"), key)
    return found.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def _centres(sample: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    c = sample[np.linspace(0, len(sample) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        at = ((c * c).sum(1)[None, :] - 2 * sample @ c.T).argmin(1)
        for j in range(k):
            own = sample[at == j]
            if len(own):
                c[j] = own.mean(0)
    return c


def _axes(sample: np.ndarray, least: float) -> np.ndarray:
    """Leading principal axes of a sample, as many as make the bound of ``_reaching`` cheapest on 256 of its rows."""
    axes = np.linalg.eigh(sample.T @ sample)[1][:, ::-1]
    some = sample[np.linspace(0, len(sample) - 1, min(256, len(sample))).astype(int)]
    dim, costs = sample.shape[1], {}
    for p in sorted({-(-dim * x // 16) for x in range(1, 16)}):
        lead = _leading(some, axes[:, :p])
        costs[p] = p + 16 * dim * (lead @ lead.T >= least).mean()  # single pairs cost more than a product
    return np.ascontiguousarray(axes[:, : min(costs, key=costs.get)])


def _leading(u: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Leading coordinates of unit vectors and the length of what is left: products of such rows are upper bounds of cosines, as what is left
    has at most the product of its lengths. In single precision, which errs by less than 1e-5."""
    x = u @ axes
    return np.column_stack([x, np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(1)))]).astype(np.float32)


def _reaching(a_ids, a, b_ids, b, axes: np.ndarray, least: float, smaller: bool, tile: int = 1024):
    """(places in b, first ids of a, pairs met, pairs compared in full): the smallest other id of a (sorted) within ``least`` of each b.

    Pairs whose bound stays below ``least`` are not compared; tiles in which more than one pair in 32 passes are compared as a matrix
    product, so copies take no memory a pair.
    """
    p, q = _leading(a, axes), _leading(b, axes)
    at, first, met, full = [], [], 0, 0
    for s in range(0, len(b), tile):
        own = b_ids[s : s + tile]
        end = int(np.searchsorted(a_ids, own.max())) if smaller else len(a_ids)
        for t in range(0, end, tile):
            ids = a_ids[t : min(t + tile, end)]
            maybe = q[s : s + tile] @ p[t : t + len(ids)].T >= np.float32(least - 1e-5)
            met += maybe.size
            if np.count_nonzero(maybe) * 32 > maybe.size:
                full += maybe.size
                maybe &= (ids[None, :] < own[:, None]) if smaller else (ids[None, :] != own[:, None])
                i, j = np.nonzero(maybe & (b[s : s + tile] @ a[t : t + len(ids)].T >= least))
            else:
                i, j = np.divmod(np.flatnonzero(maybe), len(ids))
                other = (ids[j] < own[i]) if smaller else (ids[j] != own[i])
                i, j = i[other], j[other]
                full += len(i)
                fine = np.einsum("ij,ij->i", b[s + i], a[t + j]) >= least
                i, j = i[fine], j[fine]
            i, where = np.unique(i, return_index=True)  # pairs are in order of b, then of ids
            at.append(s + i)
            first.append(ids[j[where]])
    return (np.concatenate(at) if at else np.zeros(0, int)), (np.concatenate(first) if first else a_ids[:0]), met, full


def first_within(vectors: DataFrame, key: str, vec: str, least: float = 0.8, fit_rows: int = 20_000, rows_a_list: int = 8192, chunk: int = 4096, smaller: bool = False) -> DataFrame:
    """(key, found): the smallest id among the other vectors with a cosine of ``least`` or more; vectors without one are absent. With
    ``smaller`` only ids smaller than the vector's own are looked at.

    Exact. Vectors stand in lists round centres that are fitted on at most ``fit_rows`` of them; a vector asks every list whose
    border with its own nearest one lies within the distance that ``least`` allows. Of a list only those vectors are compared in
    full whose leading coordinates, on principal axes of the same sample, leave room for ``least``. Lists stand in blocks of some ``chunk``
    vectors, a row each, that are written once; tasks read pairs of their parts, so no vector is shuffled to the lists it asks, and only the
    least id of each vector and block is emitted.
    """
    found = _search_lists(vectors, key, vec, least, fit_rows, rows_a_list, chunk, smaller).where(F.col("found").isNotNull())
    return found.groupBy(key).agg(F.min("found").alias("found"))


def pairs_compared(vectors: DataFrame, key: str, vec: str, least: float = 0.8, fit_rows: int = 20_000, rows_a_list: int = 8192, chunk: int = 4096, smaller: bool = False) -> DataFrame:
    """One row: the pairs that ``first_within`` meets in its lists, and those it compares in all coordinates."""
    work = _search_lists(vectors, key, vec, least, fit_rows, rows_a_list, chunk, smaller)
    return work.agg(F.coalesce(F.sum("met"), F.lit(0)).alias("met"), F.coalesce(F.sum("compared"), F.lit(0)).alias("compared"))


def _search_lists(vectors: DataFrame, key: str, vec: str, least: float, fit_rows: int, rows_a_list: int, chunk: int, smaller: bool) -> DataFrame:
    """(key, found, met, compared): a row a vector and chunk with a find, and one a chunk with its pairs."""
    spark = vectors.sparkSession
    kind = dict(vectors.dtypes)[key]
    rows = cut(_unit_rows(vectors, key, vec).withColumn("dim", F.size("u")))
    sizes = {r["dim"]: r["n"] for r in rows.groupBy("dim").agg(F.count("*").alias("n")).collect()}  # a row a vector length
    centres, axes = {}, {}
    for dim, n in sizes.items():
        sample = rows.where(F.col("dim") == dim).orderBy(F.xxhash64("id"), "id").limit(fit_rows).select("u").toArrow().to_pandas()["u"]
        sample = np.stack(sample.to_list())
        centres[dim] = _centres(sample, int(np.clip(n // rows_a_list, 1, min(1024, len(sample)))))
        axes[dim] = _axes(sample, least)
    shared = spark.sparkContext.broadcast((centres, axes))
    radius = float(np.sqrt(max(0.0, 2.0 - 2.0 * least)))

    def lists(batches):
        for pdf in batches:
            for dim, own in pdf.groupby("dim"):
                c, u = shared.value[0][dim], np.stack(own["u"].to_list())
                yield pd.DataFrame({"id": own["id"], "dim": own["dim"], "u": [x.tobytes() for x in u], "list": ((c * c).sum(1)[None, :] - 2 * u @ c.T).argmin(1)})

    held = cut(rows.mapInPandas(lists, f"id {kind}, dim int, u binary, list int"))
    n = held.groupBy("dim", "list").agg(F.ceil(F.count("*") / chunk).cast("int").alias("parts"))
    dealt = held.join(F.broadcast(n), ["dim", "list"]).select("dim", "list", F.pmod(F.xxhash64("id"), "parts").alias("part"), "id", "u")

    def asking(u, c, own, others):
        """Which vectors of list ``own`` ask which of the other lists: those whose border with it lies within the radius."""
        apart = np.sqrt(((c[own] - c[others]) ** 2).sum(1))
        away = ((c[others] ** 2).sum(1) - 2 * u @ c[others].T) - ((c[own] ** 2).sum() - 2 * u @ c[own])[:, None]
        return (away / np.maximum(2 * apart, 1e-12) <= radius + 1e-6) | (np.asarray(others) == own)

    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        dim, own = int(pdf["dim"].iloc[0]), int(pdf["list"].iloc[0])
        c = shared.value[0][dim]
        asks = asking(_matrix(pdf["u"].to_list()), c, own, np.arange(len(c))).any(axis=0)
        return pd.DataFrame([{"dim": dim, "list": own, "ids": pdf["id"].to_list(), "asks": np.flatnonzero(asks), "u": b"".join(pdf["u"])}])

    blocks = cut(dealt.groupBy("dim", "list", "part").applyInPandas(block, f"dim int, list int, ids array<{kind}>, asks array<int>, u binary"), **WIDE_ROWS)
    a = blocks.select(*[F.col(x).alias(f"a_{x}") for x in ("dim", "list", "ids", "u")])
    b = blocks.select("dim", "list", "ids", "asks", "u")
    meet = (F.col("a_dim") == F.col("dim")) & F.array_contains("asks", F.col("a_list"))
    if smaller:
        meet &= F.col("a_ids")[0] < F.element_at("ids", -1)
    pairs = b.join(a.hint("shuffle_replicate_nl"), meet).select("dim", "list", "ids", "u", "a_list", "a_ids", "a_u")

    def search(batches):
        for pdf in batches:
            for dim, own, b_ids, b_u, a_list, a_ids, a_u in pdf.itertuples(index=False):
                c, b_all = shared.value[0][dim], np.frombuffer(b_u).reshape(-1, dim)
                asks = asking(b_all, c, own, [a_list])[:, 0]
                ids = np.asarray(b_ids)[asks]
                at, first, met, full = _reaching(np.asarray(a_ids), np.frombuffer(a_u).reshape(-1, dim), ids, b_all[asks], shared.value[1][dim], least, smaller)
                out = pd.DataFrame({key: ids[at], "found": first, "met": 0, "compared": 0})
                yield pd.concat([out.astype({key: object, "found": object}), pd.DataFrame({key: [None], "found": [None], "met": [met], "compared": [full]})])

    return pairs.mapInPandas(search, f"{key} {kind}, found {kind}, met long, compared long")


def reuse(vectors: DataFrame, key: str, vec: str, least: float = 0.8) -> DataFrame:
    """Keyword of each vector: the smallest id within ``least`` of it that is smaller than its own, else its own. Every vector is a
    candidate; vectors without a direction keep their own."""
    near = first_within(vectors, key, vec, least, smaller=True)
    rows = vectors.select(key).join(near, key, "left")
    old = F.coalesce(F.col("found") < F.col(key), F.lit(False))
    return rows.select(key, F.when(old, F.col("found")).otherwise(F.col(key)).alias("keyword"), old.alias("reused"))


__all__ = ["cosine_top", "first_within", "pairs_compared", "reuse"]
