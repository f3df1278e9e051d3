"""Centroid clustering of whole-number vectors with Elkan's bounds: exact assignments, most distances never computed."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, staged

#: Components this large or larger are left out as those that are not finite: squared distances stay within a long.
MOST = 1 << 20


def whole_vectors(vectors: DataFrame, dims: int, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, x array<int>) of the vectors with exactly ``dims`` components, none null or non-finite: floor(scale * component)."""
    e = F.col(vec_col)
    fine = F.forall(e, lambda x: F.coalesce(F.abs(x.cast("double")) < MOST, F.lit(False)))  # NaN is above all
    return vectors.where(F.coalesce((F.size(e) == dims) & fine, F.lit(False))).select(F.col(id_col).cast("long").alias("vec_id"), F.transform(e, lambda x: F.floor(x.cast("double") * scale).cast("int")).alias("x"))


def up(x: np.ndarray) -> np.ndarray:
    """Single-precision numbers not below x; the step is wider than the rounding of any double computed before."""
    return np.nextafter(np.asarray(x, np.float32), np.float32(np.inf))


def down(x: np.ndarray) -> np.ndarray:
    return np.maximum(np.nextafter(np.asarray(x, np.float32), np.float32(-np.inf)), np.float32(0))


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d = x - y
    return np.einsum("ij,ij->i", d, d)


def half_apart(c: np.ndarray) -> np.ndarray:
    """Not above half the distance of each two centroids."""
    return down(np.sqrt(np.stack([squared(c, y) for y in c]).astype(float)) / 2)


def assign(x: np.ndarray, a: np.ndarray, u: np.ndarray, l: np.ndarray, c: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Moves every row of x to its nearest of the centroids c, in place; ties to the smaller number.

    u is not below the distance to the row's own centroid a, l[:, j] not above that to centroid j. A centroid is skipped only
    where a bound is strictly beyond u, so equal distances are always compared as whole numbers. Returns the exact squared
    distance to a where it was asked for, else -1, and how many distances each row took.
    """
    own, asked = np.full(len(x), -1, np.int64), np.zeros(len(x), np.int32)

    def open_to(rows, j):
        return (a[rows] != j) & (l[rows, j] <= u[rows]) & (apart[a[rows], j] <= u[rows])

    every = np.arange(len(x))
    for j in range(len(c)):
        rows = every[open_to(every, j)]
        loose = rows[own[rows] < 0]
        if len(loose):
            own[loose] = squared(x[loose], c[a[loose]])
            asked[loose] += 1
            d = np.sqrt(own[loose].astype(float))
            u[loose], l[loose, a[loose]] = up(d), down(d)
            rows = rows[open_to(rows, j)]
        if not len(rows):
            continue
        d = squared(x[rows], c[j])
        asked[rows] += 1
        l[rows, j] = down(np.sqrt(d.astype(float)))
        nearer = (d < own[rows]) | ((d == own[rows]) & (j < a[rows]))
        moved = rows[nearer]
        a[moved], own[moved], u[moved] = j, d[nearer], up(np.sqrt(d[nearer].astype(float)))
    return own, asked


def first_centroids(points: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k points whose ``seed:vec_id`` has the smallest sha256, in its order; null ids last, ties by components."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return np.array([r["x"] for r in points.orderBy(h.asc_nulls_last(), "x").limit(k).select("x").collect()], np.int64)


STATE = "vec_id long, x array<int>, cluster int, upper float, lower binary, asked int, distance long"


def _moved(rows: DataFrame, c: np.ndarray, shift: np.ndarray | None, last: bool) -> DataFrame:
    """State of each vector after an assignment to the centroids c, which moved by at most ``shift`` since the state before."""
    k, dims = c.shape
    apart = half_apart(c)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            n = b.num_rows
            if not n:
                continue
            x = b.column("x").flatten().to_numpy().astype(np.int64).reshape(n, dims)
            if shift is None:
                a, u, l, before = np.zeros(n, np.int64), np.full(n, np.inf, np.float32), np.zeros((n, k), np.float32), 0
            else:
                a = b.column("cluster").to_numpy().astype(np.int64)
                u = up(b.column("upper").to_numpy().astype(float) + shift[a])
                l = down(np.frombuffer(b"".join(b.column("lower").to_pylist()), np.float32).reshape(n, k).astype(float) - shift)
                before = b.column("asked").to_numpy()
            own, asked = assign(x, a, u, l, c, apart)
            if last and (rest := np.flatnonzero(own < 0)).size:
                own[rest] = squared(x[rest], c[a[rest]])
                asked[rest] += 1
            lower = pa.array([None] * n if last else [r.tobytes() for r in l], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), pa.nulls(n, pa.list_(pa.int32())) if last else b.column("x"), pa.array(a.astype(np.int32)), pa.array(u), lower, pa.array((before + asked).astype(np.int32)), pa.array(own)],
                names=["vec_id", "x", "cluster", "upper", "lower", "asked", "distance"],
            )

    return rows.mapInArrow(run, STATE)


def _sums(state: DataFrame, k: int, dims: int) -> dict[int, tuple[list[int], int]]:
    """Exact component sums and sizes of the clusters: a row a cluster from each task, added up by Spark; k rows reach the driver."""

    def run(batches):
        import pyarrow as pa

        total, n = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for b in batches:
            x = b.column("x").flatten().to_numpy().astype(np.int64).reshape(b.num_rows, dims)
            a = b.column("cluster").to_numpy()
            np.add.at(total, a, x)
            n += np.bincount(a, minlength=k)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some].tolist(), pa.list_(pa.int64())), pa.array(n[some])], names=["cluster", "s", "n"])

    parts = state.select("cluster", "x").mapInArrow(run, "cluster int, s array<long>, n long")
    each = parts.select("cluster", "n", F.posexplode("s").alias("i", "s")).groupBy("cluster", "i").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    rows = each.groupBy("cluster").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("i", "s"))).alias("s")).collect()
    return {r["cluster"]: ([y["s"] for y in r["s"]], r["n"]) for r in rows}


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256, asked.

    Kept are vectors with exactly ``dims`` components, none null, non-finite or of 2^20 and more; each component x becomes
    floor(scale * x). Centroids start as ``first_centroids``; each round assigns all vectors and replaces every centroid that has
    some by the floor of their mean. Then all are assigned once more. All figures are whole numbers, so the result does not
    depend on the order or number of tasks. ``asked`` is how many distances a vector took in all assignments, of at most
    (rounds + 1) * k without bounds. Bounds go with each vector from round to round, staged in the shared folder; the state
    before is deleted when the next one is written. The driver holds k centroids. Fewer than k vectors give as many centroids;
    equal ones leave the later empty. Repeated rows are vectors each; null ids are kept and start no centroid before others.
    An empty table, or one without kept vectors, gives no rows. Other columns are not read.
    """
    points = staged(whole_vectors(vectors, dims, scale, id_col, vec_col), "points")
    c = first_centroids(points, k, seed)
    spark, columns = vectors.sparkSession, "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, asked int"
    if not len(c):
        return spark.createDataFrame([], columns)
    state, shift = points, None
    for r in range(rounds + 1):
        new = staged(_moved(state, c, shift, r == rounds), f"assigned-{r}")
        forget(state)
        state = new
        if r < rounds:
            found = _sums(state, *c.shape)
            moved = np.array([[s // found[j][1] for s in found[j][0]] if j in found else c[j] for j in range(len(c))], np.int64)
            shift = np.sqrt(squared(moved, c).astype(float)) * (1 + 1e-12)
            c = moved
    inertia = {r["cluster"]: r["d"] for r in state.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    rows = [(j, d, sum(inertia.values()), hashlib.sha256(",".join(map(str, c[j].tolist())).encode()).hexdigest()) for j, d in inertia.items()]
    about = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.select("vec_id", "cluster", "distance", "asked").join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "asked")
