import numpy as np
import pytest

from tessera.llm import pq_dedup


def brute(rows, t=0.93):
    low = {r[0]: r[0] for r in rows}
    n = dict.fromkeys(low, 0)

    def unit(v):
        if v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, float) / np.abs(v).max()
        return v / np.linalg.norm(v)

    us = [(i, unit(v), y) for i, v, y in rows]
    for a in range(len(us)):
        for b in range(a):
            (i, u, y), (j, v, z) = us[a], us[b]
            if u is not None and v is not None and y is not None and y == z and len(u) == len(v) and u @ v >= t:
                n[i] += 1
                n[j] += 1
                x, w = low[i], low[j]
                low = {k: min(x, w) if c in (x, w) else c for k, c in low.items()}
    return {i: (n[i], low[i], low[i] == i) for i in low}


@pytest.mark.parametrize("sizes", [{}, {"fit_rows": 9}, {"rows_a_list": 12, "chunk": 7, "query_chunk": 9, "codes": 4, "m": 3}])
def test_equals_brute_force(spark, sizes):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(30, 8))
    rows = []
    for k in range(220):
        v = base[rng.integers(0, 30)] * rng.uniform(0.2, 5) + rng.normal(size=8) * rng.choice([0, 0.1, 0.3, 2])
        rows.append((k * 5 + 1, v.tolist(), int(rng.integers(0, 2)) if k % 11 else None))
    rows += [(2000 + k, base[0].tolist(), 1) for k in range(20)]
    rows += [(3000, None, 1), (3001, [0.0] * 8, 1), (3002, [float("nan")] + [1.0] * 7, 1), (3003, [float("inf")] + [1.0] * 7, 1), (3004, [None] + [1.0] * 7, 1), (3005, [1.0, 2.0], 1), (3006, [1e-200] * 8, 1), (3007, [1e200] * 8, 1)]
    for k in range(60):  # other lengths: a common one, and some that a small sample lacks
        dim = 3 if k < 40 else k - 39
        rows.append((4000 + k, (base[k % 4, : min(dim, 8)].tolist() + [0.01 * k] * max(0, dim - 8))[:dim], 1))
        rows.append((5000 + k, (np.array(rows[-1][1]) + 0.01).tolist(), 1))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in pq_dedup.near_copies(df, **sizes).collect()}
    assert got == brute(rows)


def test_awkward(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0], 1, "x"), (1, [1.0, 0.0], 1, "x"), (2, [2.0, 0.0], 1, "x"), (2, [2.0, 0.0], 1, "x")], "vec_id long, embedding array<float>, label int, n_links string")
    got = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in pq_dedup.near_copies(df).collect())
    assert got == [(0, 0, None, True), (1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False)]
    assert pq_dedup.near_copies(df.limit(0)).count() == 0


def test_links_of_every_length(spark):
    rows = [(k, np.eye(8)[k % 8].tolist(), 1) for k in range(40)] + [(100, [1.0, 0.001], 1), (101, [1.0, 0.0], 1), (102, [1.0, 0.0, 0.0], 1), (103, [0.0, 1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in pq_dedup.near_copies(df).collect()}
    assert got[100] == (1, 100) and got[101] == (1, 100) and got[102] == (0, 102) and got[103] == (0, 103) and got[9] == (4, 1)


def test_several_lists_of_few_rows(spark):
    """Even 600 vectors are searched by lists, and near ones are found across their borders."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 8))
    rows = [(k, (base[k % 40] + 0.15 * rng.normal(size=8)).tolist(), 1) for k in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in pq_dedup.near_copies(df).collect()}
    assert got == brute(rows)
