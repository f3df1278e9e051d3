"""Zipped members, loads that are broken off, tables that join without a shuffle, names and addresses that stand in texts."""

import io
import random
import time
import zipfile

import pytest

from tessera.operators.relational import contained_pairs
from tessera.sources import archives as A
from tessera.sources import files as S


def archive(**members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in members.items():
            z.writestr(name.replace("_", "."), text)
    return out.getvalue()


def test_zipped_members(spark):
    text = '"org"\t"id"\t"x"\n"Acme"\t"1"\t"a"\nbad line\n""\t"2"\t"b"\n"Bolt"\t"3"\t"c"\r\n"Cog"\t"4"\t"d"\textra\n"Dye"\t"5"\t"e"'
    rows = [(archive(a_tsv=text, readme_txt="no"),), (archive(b_tsv="id\n7\n"),), (archive(c_tsv=""),), (b"no zip",), (b"",), (None,)]
    df = spark.createDataFrame(rows, "content binary")
    got = sorted(map(tuple, A.read_zipped(df, ["id", "org", "other"], required="org").collect()))
    assert got == [("a.tsv", 1, "1", "Acme", None), ("a.tsv", 4, "3", "Bolt", None), ("a.tsv", 6, "5", "Dye", None)]
    part = lambda skip, limit: [r["id"] for r in A.read_zipped(df.limit(1), ["id"], skip=skip, limit=limit).collect()]
    assert part(0, 3) + part(3, 2) + part(5, None) == ["1", "2", "3", "5"] == part(0, None)
    assert A.read_zipped(df.limit(0), ["id"]).count() == 0


def test_load_goes_on_where_it_stopped(spark, tmp_path):
    for k in range(4):
        spark.createDataFrame([(k * 100 + j,) for j in range(100)], "x long").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("x long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out, progress, seen = str(tmp_path / "out"), str(tmp_path / "ck"), []

    def broken(k):
        seen.append(k)
        if k == 2:
            raise InterruptedError("stopped")

    with pytest.raises(Exception, match="stopped"):  # the third batch is written, but not recorded
        A.load_resumably(stream, out, progress, broken)
    assert seen == [0, 1, 2] and spark.read.parquet(out).count() == 300
    A.load_resumably(stream, out, progress, seen.append)
    assert seen == [0, 1, 2, 2, 3]
    A.load_resumably(stream, out, progress, seen.append)
    assert seen == [0, 1, 2, 2, 3] and sorted(r["x"] for r in spark.read.parquet(out).collect()) == list(range(400))


def test_bucketed_join_plans_no_shuffle(spark):
    a = spark.createDataFrame([(k % 50, k) for k in range(500)], "ka long, x long")
    b = spark.createDataFrame([(k, f"n{k}") for k in range(60)], "kb long, y string")
    rows = A.joined_tables(spark, a, b, "ka", "kb", 4).groupBy("ka").count()
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert rows.count() == 50 and all(r["count"] == 10 for r in rows.collect())
    name = A.table_name("parts")
    t = A.create_table(a.withColumn("p", a["ka"] % 3), name, partition_by=["p"])
    assert "PartitionFilters: [isnotnull(p" in t.where("p = 1")._jdf.queryExecution().executedPlan().toString()
    spark.sql(f"DROP TABLE {name}")


def test_addresses_in_long_texts(spark):
    rng = random.Random(4)
    piece = lambda n: "".join(rng.choice("ab.") for _ in range(rng.randint(1, n)))
    mails = [(k, f"{piece(4)}@{piece(4)}") for k in range(60)] + [(70, None), (71, "no mail"), (72, "a@b@c"), (73, "@x"), (74, "x@")]
    texts = [(k, " ".join(f"{piece(9)}@{piece(9)}{rng.choice(['', '@' + piece(5)])}" for _ in range(rng.randint(0, 4)))) for k in range(120)] + [(200, None), (201, "")]
    texts.append((300, "x" * 50_000 + "a@b" + "y" * 50_000 + " " + "a@" * 2000))
    m, c = spark.createDataFrame(texts, "m long, s string"), spark.createDataFrame(mails, "c long, e string")
    began = time.time()
    got = {r["m"]: r["c"] for r in S.first_contained(m, c, "s", "e", "c").collect()}
    assert time.time() - began < 30
    fine = [(k, e) for k, e in mails if e and e.count("@") == 1 and " " not in e and all(e.split("@"))]
    want = {k: min(i for i, e in fine if e in s) for k, s in texts if s and any(e in s for _, e in fine)}
    assert got == want and len(want) > 50


@pytest.mark.parametrize("q", [2, 4])
def test_names_in_names(spark, q):
    rng = random.Random(q)
    name = lambda: "".join(rng.choice("abc ") for _ in range(rng.randint(0, 9)))
    a, b = [(k, name()) for k in range(80)] + [(90, None), (91, "abc"), (91, "abc")], [(k, name()) for k in range(80)] + [(90, None), (91, "abc")]
    got = sorted((r["i"], r["j"]) for r in contained_pairs(spark.createDataFrame(a, "i long, x string"), spark.createDataFrame(b, "j long, y string"), "x", "y", q).collect())
    assert got == sorted((i, j) for i, x in a for j, y in b if x and y and (x in y or y in x)) and len(got) > 50
