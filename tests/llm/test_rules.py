import re
from collections import Counter

from pyspark.sql import functions as F

from tessera.llm import licenses, line_rules


def base(text):
    text = text or ""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = Counter(grams)
    hit = {i + j for i, g in enumerate(grams) if n[g] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def test_base_counts(spark, awkward):
    more = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", F.lit(1).alias("n_words"), F.lit("").alias("kept"), "source")
    docs = awkward.unionByName(more.withColumn("doc_id", F.col("doc_id") + 1000).withColumn("n_words", F.col("n_words").cast("long")))
    rows = line_rules.quality(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        want = base(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r["kept"] in (True, False)
    assert line_rules.quality(awkward.limit(0)).count() == 0


def letters(k):
    return "".join("abcdefghij"[int(c)] for c in str(k))


def own(k, n=60):
    return " ".join(f"w{letters(k)}x{letters(j)}" for j in range(10, 10 + n))


def depletion(rows, max_docs=20, min_left=0.25):
    """Brute force: (n_frequent_lines, left_chars, line_chars, depleted) of each (host, text)."""
    def lines(text):
        low = [re.sub("[0-9]", "0", re.sub("[ \t\x0b\x0c\r]+", " ", x.lower())).strip(" ") for x in (text or "").split("\n")]
        return frozenset(x for x in low if x)

    holders = {}
    for host, text in rows:
        for x in lines(text):
            holders.setdefault((host or "", x), set()).add(lines(text))
    out = []
    for host, text in rows:
        all_ = lines(text)
        hit = [x for x in all_ if len(holders[host or "", x]) > max_docs]
        total = sum(map(len, all_))
        left = total - sum(map(len, hit))
        out.append((len(hit), left, total, left < min_left * total))
    return out


def test_line_frequency(spark):
    """Distinct documents are counted: different pages with one menu, near copies too; copies of whole line sets are one document."""
    menu = "Home  Contact Imprint 2024 " + "nav " * 40
    rows = [(k, "h", own(k) + "\n" + menu) for k in range(40)]
    rows += [(100 + k, "h", "tiny tail\n" + menu.lower().replace("2024", "2025")) for k in range(3)]
    rows += [(200 + k, "h", "\n".join(own(1000 + j) for j in range(5))) for k in range(60)]  # exact copies
    rows += [(300 + k, "near", "\n".join(own(2000 + j) if j != k % 5 else own(5000 + k) for j in range(5))) for k in range(60)]
    rows += [(400, "other", "tiny tail\n" + menu), (401, None, None), (402, None, "\n")]
    rows += [(1000 + k, "twelve", "\n".join([*("menu " * 5 + letters(j) * 3 for j in range(10)), own(8000 + k, 2), own(9000 + k, 2)])) for k in range(500)]
    rows += [(2000, "twice", own(7000, 60) + "\n" + "nav " * 20)] * 30
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    for limit in (500_000, 0):  # both ways of the join
        got = line_rules.quality(docs, counts=True, broadcast_rows=limit).collect()
        want = depletion([(r["source"], r["text"]) for r in got])
        assert [(r["n_frequent_lines"], r["left_chars"], r["line_chars"], r["depleted"]) for r in got] == want
        assert {r["doc_id"] for r in got if r["depleted"]} == {100, 101, 102, *range(300, 360), *range(1000, 1500)}
        assert all(r["kept"] for r in got if r["doc_id"] < 40 or 200 <= r["doc_id"] < 300 or r["doc_id"] == 2000)
    lean = line_rules.quality(docs).groupBy("doc_id").agg(F.max("depleted").alias("x")).where("x").collect()
    assert {r["doc_id"] for r in lean} == {100, 101, 102, *range(300, 360), *range(1000, 1500)}


def test_frequent_lines_removed(spark):
    menu = "Home  Contact 2024"
    rows = [(k, "h", f"{menu}\n{own(k)}\n \n{menu.lower()}\nend {letters(k)}") for k in range(30)] + [(50, "o", menu), (51, "h", None), (52, "h", menu), (53, "h", "")] + [(54, "h", "x\n" + menu)] * 2
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, source string, text string, k long")
    got = line_rules.without_frequent_lines(docs)
    assert got.columns == docs.columns
    want = [(k, f"{own(k)}\n \nend {letters(k)}") for k in range(30)] + [(50, menu), (51, None), (52, ""), (53, ""), (54, "x"), (54, "x")]
    assert sorted((r["doc_id"], r["text"]) for r in got.collect() if r["text"] is not None) == sorted(x for x in want if x[1] is not None)


def test_long_text(spark):
    """Ten megabytes in one row, in many lines and in one."""
    lines = "\n".join(f"line {letters(k)} of many words here" for k in range(300_000))
    docs = spark.createDataFrame([(1, "h", lines), (2, "h", "w " * 2_000_000)], "doc_id long, source string, text string")
    got = {r["doc_id"]: r for r in line_rules.quality(docs).drop("text").collect()}
    assert got[1]["n_words"] == 1_800_000 and got[1]["n_dup_lines"] == 0 and got[2]["n_repeat_words"] == 2_000_000
    assert not got[1]["depleted"] and not got[2]["kept"]


def places(text):
    w = [x for x in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({i: i + 32 for i in range(65, 91)})) if x]
    found = [(i, label) for label, p in licenses.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    return len(w), found


def scanned(text, k=4, slack=3):
    """Brute force: labels and score by comparing every place with every template."""
    w = [x for x in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({i: i + 32 for i in range(65, 91)})) if x]
    spans, long = [], []
    for label, t in licenses.known():
        t = t.split()
        n = min(k, len(t))
        hits = [(p - a, a, p) for p in range(len(w) - n + 1) for a in range(len(t) - n + 1) if w[p : p + n] == t[a : a + n]]
        bands, last = [], None
        for d in sorted({d for d, _, _ in hits}):
            if last is None or d - last > slack or len(t) < k:
                bands.append([])
            bands[-1] += [(a, p) for x, a, p in hits if x == d]
            last = d
        for b in bands:
            share, first, end = len({a for a, _ in b}) / (len(t) - n + 1), min(p for _, p in b), max(p for _, p in b) + n
            if len(t) > 16 and share >= 0.5:
                long.append((first, end, label, share))
            elif len(t) <= 16 and share == 1 and end - first <= len(t) + slack:
                spans.append((label, share))
    groups, far = [], -1
    for x in sorted(long):
        if x[0] >= far:
            groups.append([])
        groups[-1].append(x)
        far = max(far, x[1])
    for g in groups:
        spans += [(label, share) for _, _, label, share in g if share == max(x[3] for x in g)]
    return ",".join(sorted({x for x, _ in spans})), max((0.5 if x in licenses.PHRASES else min(s, 1.0) for x, s in spans), default=0.0)


#: Written by hand, from what the sentences say.
SAID = {
    "licensed under the GNU General Public License, version 3.": "gpl,gpl-3",
    "licensed under the GNU General Public License, version 2.": "gpl,gpl-2",
    "licensed under the GNU General Public License": "gpl",
    "You may choose the GNU General Public License version 2 or the GNU General Public License version 3": "gpl,gpl-2,gpl-3",
    "under the GNU Lesser General Public License, version 3": "gpl,lgpl",
    "This work is licensed under a Creative Commons Attribution-ShareAlike International License": "cc-by-sa",
    "This work is licensed under a Creative Commons Attribution International License": "cc-notice",
    "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License": "cc-by-sa-4.0",
    "licensed under a Creative Commons Attribution 4.0 International License": "cc-by-4.0",
    "licensed under CC BY-NC 4.0": "cc-by,cc-by-nc-4.0",
    "licensed under CC BY-SA 4.0": "cc-by,cc-by-sa-4.0",
    "licensed under CC BY 4.0": "cc-by,cc-by-4.0",
    "licensed under CC BY": "cc-by",
    "he was licensed under the bsd scheme": "",
    "released under the BSD 3-Clause License": "bsd",
    "the driver was licensed under the road act, version 2": "",
    "Licensed under the Apache License, Version 2.0": "apache-2.0",
    "licensed under the Mozilla Public License": "",
    "Released under the MIT License.": "mit",
    "he studied at MIT; License plates were sold there": "mit",
    "the general public was here": "",
}


def test_labels_say_what_the_text_says(spark):
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(SAID)], "doc_id long, text string")
    got = {r["doc_id"]: r["labels"] for r in licenses.digest(licenses.scan(rows)).collect()}
    assert {t: got[k] for k, t in enumerate(SAID)} == SAID


def test_look_alike_long_templates(spark):
    """Of two long templates that share most of their words the one that the text has is named."""
    words = [f"w{k}" for k in range(30)]
    a, b = " ".join(words), " ".join([*words[:24], *[f"x{k}" for k in range(6)]])
    rows = spark.createDataFrame([(1, a), (2, "so " + b + " end"), (3, a + " between them " + b), (4, " ".join(words[:20]))], "doc_id long, text string")
    got = {r["doc_id"]: sorted(s["label"] for s in r["spans"]) for r in licenses.scan(rows, [("a", a), ("b", b)]).collect()}
    assert got == {1: ["a"], 2: ["b"], 3: ["a", "b"], 4: ["a", "b"]}


def test_gpl_rows_of_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lower(text) like '%general public license%'")
    labels = [r["labels"].split(",") for r in licenses.digest(licenses.scan(docs)).collect()]
    assert len(labels) == 9 and all("gpl" in x and "gpl-3" in x and "gpl-2" not in x for x in labels)


def test_licenses(spark, awkward):
    mit = licenses.NOTICES["mit"]
    texts = [
        "CC BY! cc-by cc  by", "x All Rights RESERVED. all rights reserved", "GNU General Public License", "Permission is " + mit[len("permission is "):], "intro words here " + mit.upper().replace(" ", ", ") + " outro",
        mit.replace("without restriction", "with no restriction"), mit[:60], "cc by" * 3 + " cc by cc by", "Kpermission cc by",
    ]
    docs = awkward.select("doc_id", "text").unionByName(spark.createDataFrame([(50 + k, t) for k, t in enumerate(texts)], "doc_id long, text string"))
    docs = docs.unionByName(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("doc_id + 1000", "text").toDF("doc_id", "text"))
    rows = licenses.digest(licenses.scan(docs)).join(docs.dropDuplicates(["doc_id"]), "doc_id").collect()
    for r in rows:
        n, found = places(r["text"])
        at = [i for i, _ in found]
        assert (r["n_words"], r["n_base"]) == (n, len(found)), r
        assert (r["first_word"], r["last_word"]) == ((min(at), max(at)) if at else (None, None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in found}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    by = {r["doc_id"]: r for r in rows}
    assert all(tuple(r[c] for c in ("labels", "score")) == scanned(r["text"]) for r in rows)
    assert by[53]["labels"] == by[54]["labels"] == by[55]["labels"] == "mit" and by[53]["score"] == 1.0 and 0.5 < by[55]["score"] < 1
    assert by[56]["labels"] == ""
    assert licenses.scan(docs).count() == docs.count()
    assert licenses.scan(docs.limit(0)).count() == 0


def test_long_license_text(spark):
    """Ten megabytes take time in proportion to the text; hits at both ends are found."""
    text = "cc by " + "word another thing here " * 450_000 + licenses.NOTICES["isc"]
    r = licenses.digest(licenses.scan(spark.createDataFrame([(1, text), (1, text), (2, "cc by " * 300_000)], "doc_id long, text string"))).orderBy("doc_id").collect()
    assert [x["doc_id"] for x in r] == [1, 1, 2] and r[0]["labels"] == "cc-by,isc" and r[0]["last_word"] == 0 and r[0]["n_words"] == 1_800_002 + len(licenses.NOTICES["isc"].split())
    assert r[2]["n_base"] == 300_000 and r[2]["last_word"] == 599_998
