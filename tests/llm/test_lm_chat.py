import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import lm_scores, preferences


@pytest.mark.parametrize("places", [1_000_000, 3])
def test_losses_equal_brute_force(spark, monkeypatch, places):
    monkeypatch.setattr(lm_scores, "PLACES", places)
    docs = [(1, "the cat sat on the mat"), (2, "The dog sat"), (3, ""), (4, None), (5, "zebra zebra the cat"), (6, "a b c d e f g")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_words", F.lit("clash"))
    rows = {r["doc_id"]: r for r in lm_scores.cross_entropy_difference(df, spark.createDataFrame([(1,), (5,), (None,)], "doc_id long"), vocabulary_size=10).collect()}
    words = Counter(w for _, t in docs for w in (t or "").lower().split())
    names = [w for w, n in words.items() if n > 1]  # 4 words; all 13 are too many
    code = {w: k for k, w in enumerate(names)}
    seqs = {d: [5, *[code.get(w, 4) for w in (t or "").lower().split()]] for d, t in docs}

    def model(ids):
        uni, bi = np.zeros(6), Counter()
        for d in ids:
            for a, b in zip(seqs[d], seqs[d][1:]):
                uni[b] += 1
                bi[a, b] += 1
            uni[5] += len(seqs[d]) > 1
        p = (uni + 0.5) / (uni.sum() + 3)
        return lambda a, b: -math.log((bi[a, b] + 4 * p[b]) / (uni[a] + 4))

    for name, ids in (("target_loss", {1, 5}), ("background_loss", set(seqs))):
        for d, s in seqs.items():
            m = model(ids - {d})  # no document scores itself
            want = sum(m(a, b) for a, b in zip(s, s[1:])) / max(1, len(s) - 1)
            assert math.isclose(rows[d][name], want, rel_tol=1e-6, abs_tol=1e-12), (name, d)
    assert rows[5]["loss_difference"] < rows[6]["loss_difference"] and rows[3]["n_words"] == 0
    assert [r["in_target"] for _, r in sorted(rows.items())] == [True, False, False, False, True, False]


def test_long_and_repeated(spark):
    """A text of 10 MB is one document; a repeated row gains nothing by its twin."""
    long = " ".join(f"w{k % 50_000}" for k in range(1_600_000))
    df = spark.createDataFrame([(1, long), (2, "only here once"), (3, "said two times"), (3, "said two times")], "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_words"], r["background_loss"]) for r in lm_scores.cross_entropy_difference(df, df.where("doc_id = 1").select("doc_id")).collect())
    assert [x[:2] for x in got] == [(1, 1_600_000), (2, 3), (3, 3), (3, 3)] and got[2] == got[3] and math.isclose(got[3][2], got[1][2], rel_tol=1e-2)


def test_copies_score_without_each_other(spark):
    """A copy, in the target or not, has its twin's losses, and both have those of the twin in a table without the copies."""
    rng = np.random.default_rng(8)
    docs = [(d, " ".join(f"w{int(x)}" for x in rng.integers(0, 60, 80))) for d in range(40)]
    target = spark.createDataFrame([(x,) for x in (0, 5, 9, 901)], "doc_id long")

    def losses(rows):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        return {r["doc_id"]: (r["target_loss"], r["background_loss"]) for r in lm_scores.cross_entropy_difference(df, target).collect()}

    alone, copied = losses(docs), losses([*docs, (900, docs[0][1]), (901, docs[0][1])])
    for d in (0, 900, 901):
        assert all(math.isclose(x, y, rel_tol=1e-9) for x, y in zip(copied[d], alone[0])), d
    outside = losses([*docs, (902, docs[7][1])])
    assert outside[902] == outside[7] and math.isclose(outside[7][1], alone[7][1], rel_tol=1e-9)


def test_awkward(spark, awkward):
    assert lm_scores.cross_entropy_difference(awkward, awkward.select("doc_id").limit(0)).count() == awkward.count()
    assert lm_scores.cross_entropy_difference(awkward.limit(0), awkward.select("doc_id")).count() == 0


def show(t):
    return f"<|{t[0]}|>\n{t[1]}<|end|>\n"


def test_preferences_equal_brute_force(spark):
    rng = np.random.default_rng(6)
    rows, convs = [], {}
    for c in range(60):
        n = int(rng.integers(1, 6))
        turns = [("user" if k % 2 == 0 else "assistant", f"t{rng.integers(0, 2)}" * int(rng.integers(1, 3))) for k in range(n)]
        convs[c] = turns
        rows += [(c, k, r, t) for k, (r, t) in enumerate(turns)]
    rows += [(100, 0, None, None), (100, 1, "assistant", None), (101, None, "user", "x"), (None, 0, "user", "no id")]
    convs |= {100: [("user", ""), ("assistant", "")], 101: [("user", "x")], None: [("user", "no id")]}
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("chosen", F.lit(1)).repartition(3)
    got = preferences.preference_rows(preferences.by_opening(preferences.gather(df))).collect()
    groups = {}
    for c, t in convs.items():
        groups.setdefault(t[0], []).append(c)
    want = {}
    for own in groups.values():
        best = min(own, key=lambda c: (-len(convs[c]), -sum(len(t) for _, t in convs[c]), -1 if c is None else c))
        for c in own:
            if c != best or len(own) == 1:
                want[best, c if len(own) > 1 else None] = (convs[best], convs[c] if len(own) > 1 else None)
    assert {(r["chosen"], r["rejected"]) for r in got} == set(want) and len(got) == len(want)
    for r in got:
        a, b = want[r["chosen"], r["rejected"]]
        if b is None:
            back = [k for k, t in enumerate(a) if t[0] == "assistant"]
            n = back[-1] if back else len(a)
        else:
            n = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert r["prompt_turns"] == n and r["prompt"] == "".join(map(show, a[:n]))
        for side, turns in (("chosen", a), ("rejected", b)):
            if turns is None:
                assert r[f"{side}_text"] is None and r[f"{side}_spans"] is None
                continue
            whole = r["prompt"] + r[f"{side}_text"]
            assert whole == "".join(map(show, turns))
            assert [whole[s["start"] : s["start"] + s["length"]] for s in r[f"{side}_spans"]] == [t + "<|end|>" for role, t in turns[n:] if role == "assistant"]
    assert preferences.preference_rows(preferences.by_opening(preferences.gather(df.limit(0)))).count() == 0


def test_preferences_of_long_and_repeated_turns(spark):
    """A turn of 10 MB is kept whole in prompts and completions; a repeated row is a turn of its own."""
    long = "many words " * 1_000_000
    turns = {1: [("user", "q"), ("assistant", long)], 2: [("user", "q"), ("assistant", "short")], 3: [("user", "q"), ("assistant", long), ("user", "again"), ("assistant", "yes")], 4: [("user", long)], 5: [("user", "twice"), ("user", "twice"), ("assistant", "once")]}
    rows = [(c, min(k, 1) if c == 5 else k, r, t) for c, own in turns.items() for k, (r, t) in enumerate(own)]
    rows[-3:] = [(5, 0, "user", "twice"), (5, 0, "user", "twice"), (5, 1, "assistant", "once")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r["chosen"], r["rejected"]): r for r in preferences.preference_rows(preferences.by_opening(preferences.gather(df))).collect()}
    assert {k: r["prompt_turns"] for k, r in got.items()} == {(3, 1): 2, (3, 2): 1, (4, None): 1, (5, None): 2}
    assert got[3, 1]["prompt"] == show(("user", "q")) + show(("assistant", long)) and got[3, 1]["rejected_text"] == ""
    assert got[3, 2]["chosen_text"] == "".join(map(show, turns[3][1:])) and got[3, 2]["chosen_spans"][0]["length"] == len(long) + 7
    assert got[4, None]["prompt"] == show(("user", long)) and got[5, None]["prompt"] == show(("user", "twice")) * 2


def test_losses_of_all_words_equal_brute_force(spark):
    """More words and pairs than fixed tables held: every one is counted by itself, in both models and over parts."""
    rng = np.random.default_rng(3)
    docs = [(d, " ".join(f"w{int(x)}" for x in rng.integers(0, 90_000, 2_000))) for d in range(120)] + [(500, "rare words rare words"), (501, "words rare words rare")]
    target = set(range(0, 120, 3)) | {500}
    seqs = {d: [None, *t.split()] for d, t in docs}

    def model(ids):
        uni, bi = Counter(), Counter()
        for d in ids:
            uni.update(seqs[d][1:])
            uni[None] += 1
            bi.update(zip(seqs[d], seqs[d][1:]))
        total, n = sum(uni.values()), len({w for s in seqs.values() for w in s})

        def loss(d):
            s, out = seqs[d], 0.0
            mine = d in ids  # no document scores itself
            own, both = Counter(s), Counter(zip(s, s[1:]))
            for a, b in zip(s, s[1:]):
                p = (uni[b] - mine * own[b] + 0.5) / (total - mine * len(s) + n / 2)
                out -= math.log((bi[a, b] - mine * both[a, b] + 4 * p) / (uni[a] - mine * own[a] + 4))
            return out / (len(s) - 1)

        return loss

    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = {r["doc_id"]: r for r in lm_scores.cross_entropy_difference(df, spark.createDataFrame([(x,) for x in target], "doc_id long")).collect()}
    assert len({w for s in seqs.values() for w in s}) > 1 << 16
    for name, m in (("target_loss", model(target)), ("background_loss", model(set(seqs)))):
        for d in seqs:
            assert math.isclose(rows[d][name], m(d), rel_tol=1e-9), (name, d)
