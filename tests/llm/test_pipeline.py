import os

import pytest

import corpus_pipeline as cp


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory, awkward):
    """The awkward rows beside good documents, near and exact copies and toxic ones, in files like the driver's."""
    d = str(tmp_path_factory.mktemp("sf"))
    base = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    odd = awkward.selectExpr("doc_id + 100000 AS doc_id", "text", "'en' AS lang", "source", "7L AS n_chars")
    base.unionByName(odd).write.parquet(f"{d}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.01/labels.parquet").write.parquet(f"{d}/labels.parquet")
    return d


def test_stages(spark, small):
    """Every stage against a plain version of its decision on what the one before kept."""
    from test_jaccard import classes
    from test_rules import base

    docs = spark.read.parquet(f"{small}/documents.parquet")
    names, frames = docs.columns, [docs]
    for name, stage in cp.STAGES:
        frames.append(cp.staged(stage(spark, frames[-1], small), "test"))
    for f in frames[1:-1]:
        assert f.columns == names
    rows = [[tuple(r) for r in f.select("doc_id", "text").collect()] for f in frames[:-1]]
    label = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    gone = {d for d, _ in rows[0]} - {d for d, _ in rows[1]}
    known = [label[d] for d in gone if d in label]
    assert sum(known) >= 0.9 * max(1, len(known)) and sum(known) >= 0.7 * sum(label.values())
    passed = [(d, t) for d, t in rows[1] if not (base(t)[0] < 50 or 100 * base(t)[4] > 50 * base(t)[0])]
    assert set(rows[2]) <= set(passed) and len(rows[2]) >= 0.95 * len(passed)
    import test_jaccard

    five = test_jaccard.shingles
    test_jaccard.shingles = lambda t, n=5: five(t, 5)
    try:
        want = classes([r for r in rows[2] if r[0] is not None], 80, 100)
    finally:
        test_jaccard.shingles = five
    assert sorted((d for d, _ in rows[3] if d is not None)) == sorted({c for _, c in want.values()})
    tokens = {}
    for r in frames[-1].collect():
        tokens.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["doc_tokens"]))
    for own in tokens.values():
        assert sum(n for _, n, _ in own) == own[0][2]
    assert set(tokens) == {d for d, _ in rows[3]}


def test_run_and_empty(spark, small, tmp_path):
    assert cp.run(spark, small).count() > 0
    d = str(tmp_path)
    for t in ("documents", "labels"):
        spark.read.parquet(f"{small}/{t}.parquet").limit(0).write.parquet(os.path.join(d, f"{t}.parquet"))
    assert cp.run(spark, d).count() == 0
