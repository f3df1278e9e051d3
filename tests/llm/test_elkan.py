"""Clustering against plain rounds over all distances."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import types as T

from tessera.llm import elkan
from tessera.llm.queries import QUERIES

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("cluster", T.StringType()), T.StructField("distance", T.StringType())])


def plain(rows, k, rounds, dims, scale):
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid) by Python's whole numbers."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    c = [x for _, _, x in sorted(("~" if i is None else hashlib.sha256(f"1:{i}".encode()).hexdigest(), 0, x) for i, x in kept)[:k]]
    for r in range(rounds + 1):
        best = [min((sum((a - b) ** 2 for a, b in zip(x, y)), j) for j, y in enumerate(c)) for _, x in kept]
        if r < rounds:
            for j in range(len(c)):
                if mine := [x for (_, x), (_, a) in zip(kept, best) if a == j]:
                    c[j] = [sum(z) // len(mine) for z in zip(*mine)]
    total = {j: sum(d for d, a in best if a == j) for j in range(len(c))}
    return sorted(((i, a, d, total[a], sum(total.values()), hashlib.sha256(",".join(map(str, c[a])).encode()).hexdigest()) for (i, _), (d, a) in zip(kept, best)), key=repr)


def clusters(df, **kw):
    return df, sorted((tuple(r)[:6] for r in df.collect()), key=repr)


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_equals_plain_rounds(spark, spread):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(6, 5))[rng.integers(0, 6, 300)] + spread * rng.normal(size=(300, 5))
    v = np.round(v * 2) / 2 if spread == 1.0 else v  # many ties
    rows = [(i, [float(y) for y in x]) for i, x in enumerate(v)] + [(3, [float(y) for y in v[3]]), (None, [0.0] * 5), (900, None), (901, []), (902, [1.0] * 4), (903, [1.0, None, 1.0, 1.0, 1.0]), (904, [math.nan] * 5), (905, [math.inf] * 5), (906, [-0.01] * 5)]
    df = spark.createDataFrame([(i, x, "z", "z") for i, x in rows], SCHEMA).repartition(3)
    got = elkan.cluster(df, k=7, rounds=4, dims=5)
    assert sorted((tuple(r)[:6] for r in got.collect()), key=repr) == plain(rows, 7, 4, 5, 64)
    if spread < 1:  # the bounds do skip distances
        assert got.agg({"asked": "avg"}).first()[0] < 0.6 * 5 * 7


def test_small_tables(spark):
    few = spark.createDataFrame([(1, [1.0, 2.0], "", ""), (2, [1.0, 2.0], "", ""), (2, [1.0, 2.0], "", "")], SCHEMA)
    assert sorted((tuple(r)[:6] for r in elkan.cluster(few, dims=2).collect()), key=repr) == plain([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (2, [1.0, 2.0])], 16, 3, 2, 64)
    none = elkan.cluster(few.limit(0))
    assert none.count() == 0 and none.columns == elkan.cluster(few, dims=2).columns


def test_query_equals_plain(spark):
    d = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{d}/embeddings.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op12_elkan"](spark, d).collect()), key=repr) == plain(rows, 16, 3, 64, 64)
