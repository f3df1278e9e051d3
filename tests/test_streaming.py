from pyspark.sql import functions as F

from tessera.operators.relational import latest_each
from tessera.streaming import events as V

PATH = "/root/testdata/sf0.001/events.parquet"


def folder(spark, tmp_path):
    e = spark.read.parquet(PATH).withColumn("ts", F.col("ts").cast("timestamp"))
    e.repartitionByRange(4, "ts").write.parquet(str(tmp_path / "in"))
    return e, V.source(spark, str(tmp_path / "in"), e.schema, 1)


def test_windows_equal_batch(spark, tmp_path):
    e, s = folder(spark, tmp_path)
    out = str(tmp_path / "out")
    V.run_available(V.tumbling(V.timed(s, "ts", "3650 days"), "ts", "1 hour", ["event_type"]), out, str(tmp_path / "ck"), "append")
    V.run_available(V.tumbling(V.timed(s, "ts"), "ts", "6 hours", ["event_type"], "3 hours"), str(tmp_path / "out2"), str(tmp_path / "ck2"))
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out2")).collect()}
    want = {tuple(r) for r in V.tumbling(e, "ts", "6 hours", ["event_type"], "3 hours").collect()}
    last = max(r[1] for r in want)
    assert got <= want and len(got) > 0.5 * len([w for w in want if w[1] < last])


def test_upserts_equal_batch(spark, tmp_path):
    e, s = folder(spark, tmp_path)
    state = {}

    def sink(rows, k):
        for r in rows.collect():
            state[r["user_id"]] = max(state.get(r["user_id"], (r["ts"], r["event_id"])), (r["ts"], r["event_id"]))

    V.run_upserts(s, str(tmp_path / "ck"), ["user_id"], ["ts", "event_id"], sink)
    assert state == {r["user_id"]: (r["ts"], r["event_id"]) for r in latest_each(e, ["user_id"], ["ts", "event_id"]).collect()}


def test_once(spark, tmp_path):
    e, s = folder(spark, tmp_path)
    V.run_available(V.once(V.timed(s.unionByName(s), "ts", "3650 days"), ["event_id"]).select("event_id"), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == sorted(r[0] for r in V.once(e, ["event_id"]).select("event_id").collect())
