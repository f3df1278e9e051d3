"""Breakers by the reset rule against a plain loop, in batches and streams; parameters that change between batches."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import breaker as B

START = datetime.datetime(2024, 3, 1, tzinfo=datetime.timezone.utc)


def rows_of(n, seed, mean):
    rng, at, out = random.Random(seed), 0.0, []
    for k in range(n):
        at += rng.choice([0, rng.expovariate(1 / mean), rng.expovariate(1 / mean), 300.0, 300.000001])
        out.append((rng.choice("ab") if seed % 2 else "a", k, START + datetime.timedelta(microseconds=round(at * 1e6)), rng.random() < 0.8))
    return out


def plain(rows, span=300, least=3):
    """The loop: a failure more than the span after the last reset resets the count to 1."""
    out, state = [], {}
    for key, i, t, bad in sorted(rows, key=lambda r: (r[2], r[1])):
        if not bad:
            continue
        began, n = state.get(key, (None, 0))
        n += 1
        if began is None or t - began > datetime.timedelta(seconds=span):
            began, n = t, 1
        state[key] = (began, n)
        out.append((key, i, t, n, began, n >= least))
    return sorted(out)


def collected(df):
    return sorted((r["key"], r["id"], r["time"].astimezone(datetime.timezone.utc), r["failures"], r["count_began"].astimezone(datetime.timezone.utc), r["tripped"]) for r in df.collect())


SCHEMA = "k string, i long, t timestamp, bad boolean"


@pytest.mark.parametrize("seed,mean,block", [(1, 40.0, 300), (2, 40.0, 1000), (3, 400.0, 86_400), (4, 5.0, 301)])
def test_breaker_equals_loop(spark, seed, mean, block):
    rows = rows_of(600, seed, mean)
    want = plain(rows)
    df = spark.createDataFrame(rows + [(None, 9, START, True), ("a", 9, None, True), ("a", 10, START, None)], SCHEMA)
    assert collected(B.breaker(df, F.col("bad"), F.col("k"), "t", "i", block_seconds=block)) == want
    assert any(w[5] for w in want) and not all(w[5] for w in want)
    assert B.breaker(df.limit(0), F.col("bad"), F.col("k"), "t", "i").count() == 0


def test_breaker_stream_equals_batch(spark, tmp_path):
    rows = rows_of(300, 5, 60.0)
    bad = [r for r in sorted(rows, key=lambda r: (r[2], r[1])) if r[3]]
    for k in range(3):  # three files in order of time, one a micro-batch
        spark.createDataFrame(bad[k * len(bad) // 3 : (k + 1) * len(bad) // 3], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    s = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(str(tmp_path / "in"))
    B.breaker_stream(s, "k", "t", "i").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    assert collected(spark.read.parquet(str(tmp_path / "out"))) == plain(rows)


def test_parameters_change_between_batches(spark, tmp_path):
    for k in range(3):
        spark.createDataFrame([("limit", k * 10 + j) for j in range(2)], "param_key string, x long").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    now, seen = {"rows": [("limit", "1")]}, {}

    def use(rows, k):
        seen[k] = sorted((r["x"], r["value"]) for r in rows.collect())
        if k == 0:
            now["rows"] = [("limit", "2"), ("other", "x")]

    s = spark.readStream.schema("param_key string, x long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    taken = B.with_reloaded(s, lambda: spark.createDataFrame(now["rows"], "param_key string, value string"), ["param_key"], use, str(tmp_path / "ck"))
    assert [k for k, _ in taken] == [0, 1]  # the third batch finds the same content
    assert [sorted({v for _, v in seen[k]}) for k in range(3)] == [["1"], ["2"], ["2"]]
    assert sorted(x for v in seen.values() for x, _ in v) == [0, 1, 10, 11, 20, 21]
