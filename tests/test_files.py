"""Readers, imports and matches on rows that the generated tables do not hold."""

import fnmatch
import random

from pyspark.sql import functions as F

from tessera.sources import files


def test_first_contained(spark):
    rng = random.Random(2)
    part = lambda: "".join(rng.choice("ab.") for _ in range(rng.randint(1, 3)))
    contacts = [(k, f"{part()}@{part()}") for k in range(60)] + [(90, None), (91, ""), (92, "a b@c"), (93, "a@b@c")]
    senders = [rng.choice(["", "Name <", "a "]) + "@".join(part() for _ in range(rng.randint(1, 4))) + rng.choice(["", ">", " x@b"]) for _ in range(200)] + ["", None, "@", "a@", "@b", "a@@b"]
    m = spark.createDataFrame(list(enumerate(senders)), "id long, sender string")
    c = spark.createDataFrame(contacts, "k long, email string")
    got = {r["id"]: r["k"] for r in files.first_contained(m, c, "sender", "email", "k").collect()}
    good = [(k, e) for k, e in contacts if k < 90]
    assert got == {i: min(k for k, e in good if e in s) for i, s in enumerate(senders) if s and any(e in s for _, e in good)}


def test_patterns_and_invalidation(spark):
    keys = ["uno.sec.a", "uno.sec.b1", "uno.secx", "uno", "a[b]", "line\nuno.sec.c", "UNO.sec.a"]
    df = spark.createDataFrame([(k,) for k in keys] + [(None,)], "k string")
    for p in ("uno.sec.*", "uno.???.?", "*[ab]", "uno.sec.[!a]*", "a[[]b]", "*", "uno.sec.*[0-9]"):
        left = [r["k"] for r in files.invalidate(df, "k", pattern=p).collect()]
        assert left == [k for k in keys if not fnmatch.fnmatchcase(k, p)] + [None], p
    assert files.invalidate(df, "k", namespace="uno.sec").count() == 6 and files.invalidate(df, "k", exact="uno").count() == 7 and files.invalidate(df, "k").count() == 8


def test_contact_rows(spark):
    rows = spark.createDataFrame([("A@x.org", None, "li", 2), ("a@X.org", "B", "", 1), ("  ", "C", None, 3), ("k@x.org", "D", None, 4)], "`E-Mail` string, firstname string, LinkedIn string, row long").withColumnRenamed("E-Mail", "EMAIL ")
    got = files.import_contacts(files.contacts_of(rows), spark.createDataFrame([("K@X.ORG",)], "email string"), "row").collect()
    assert [tuple(r) for r in got] == [("a@X.org", "B", "", "", "", "", "Default")]
    old = spark.createDataFrame([(None, "x.org/a", "true"), ("A", None, None)], "`First Name` string, `Linkedin Url` string, `Paused?` string")
    got = files.migrate_contacts(old, ["First Name", "LinkedIn URL", "Status", "Priority", "Reply Channel", "Other"]).collect()
    assert [tuple(r) for r in got] == [("", "https://www.x.org/a", "Paused", "Medium", "", ""), ("A", "", "Active", "Medium", "", "")]
    typed = files.typed_contacts(spark.createDataFrame([(None, None, None, None, None, None)], "first_name string, email string, sequence string, status string, priority string, reply_channel string")).first()
    assert typed["display_name"] == "Unknown Contact" and typed["status"] == "Active" and not typed["is_valid"] and not typed["paused"]


def test_short_and_long_rows(spark, tmp_path):
    (tmp_path / "t.tsv").write_text('"patent_id"\tassignee_id\t"disambig_assignee_organization"\tassignee_type\n"1"\ta\t"' + "x" * 600 + '"\t2\n2\tb\n3\tc\t""\t4\n4\td\tAcme\t\n')
    got = files.read_organisations(spark, str(tmp_path / "t.tsv")).orderBy("patent_id").collect()
    assert [(r["patent_id"], len(r["name"]), r["type"]) for r in got] == [("1", 500, "2"), ("4", 4, None)]
    rows = spark.createDataFrame([(k,) for k in range(3)], "id long")
    lines = files.markdown_report(rows, "T", "id", {"n": F.col("id").cast("string")}).orderBy("section", "line").collect()
    assert [r["text"] for r in lines] == ["# T", "## 0", "- **n**: 0", "## 1", "- **n**: 1", "## 2", "- **n**: 2"]
