"""The byte network against plain steps and numeric gradients; language ID against labels that it never saw."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import language as L
from tessera.llm.queries import QUERIES


def plain(model, text):
    """Mean probabilities of one text, byte by byte."""
    H, raw = model.hidden, text.encode()
    sigmoid = lambda v: 1 / (1 + np.exp(-v))
    total, n = np.zeros(len(model.labels)), 0
    for lo in range(0, len(raw), L.WINDOW):
        x = raw[lo : lo + L.WINDOW].ljust(L.WINDOW, b"\0")
        states = {}
        for way, order in (("f", range(L.WINDOW)), ("b", range(L.WINDOW - 1, -1, -1))):
            e, u, v = (model.w[k + way].astype(float) for k in "euv")
            h = np.zeros(H)
            for t in order:
                i, g = e[x[t]], h @ u
                z, r = sigmoid(i[:H] + g[:H]), sigmoid(i[H : 2 * H] + g[H : 2 * H])
                m = np.tanh(i[2 * H :] + r * (g[2 * H :] + v))
                h = (1 - z) * m + z * h
                states[way, t] = h
        for t, b in enumerate(x):
            if b >= 128 or chr(b).isalpha():
                logit = np.concatenate([states["f", t], states["b", t]]) @ model.w["o"] + model.w["c"]
                total += np.exp(logit) / np.exp(logit).sum()
                n += 1
    return total / max(n, 1)


def test_equals_plain_steps():
    model = L.Network(["a", "b", "c"], 5, 3)
    texts = ["x", "été, " * 40, "", "Straße und 12 " * 30, "\n" * 300, "a" * 128, "b" * 129]
    got = model.documents(*L.flat_bytes(texts))
    for t, p in zip(texts, got):
        assert p == pytest.approx(plain(model, t), abs=1e-5)


def test_gradients_are_numeric_ones():
    rng = np.random.default_rng(1)
    model = L.Network(["a", "b", "c"], 4, 3)
    model.w = {k: v.astype(np.float32) for k, v in model.w.items()}
    x, y = rng.integers(60, 140, (9, 6)).astype(np.uint8), np.array([0, 1, 2, 0, 1, 2])
    _, grad = model.gradients(x, y)
    for k, g in grad.items():
        for at in rng.choice(np.flatnonzero(np.abs(g) > 1e-3), 4):
            kept = model.w[k].flat[at]
            sides = []
            for d in (1e-2, -1e-2):
                model.w[k].flat[at] = kept + d
                sides.append(model.gradients(x, y)[0])
            model.w[k].flat[at] = kept
            assert g.flat[at] == pytest.approx((sides[0] - sides[1]) / 2e-2, rel=0.05, abs=2e-4), k


def test_windows_hold_every_byte_once():
    raw, lens = L.flat_bytes(["", "abc", "x" * 300, None, "ü" * 64])
    x, owner = L.windows_of(raw, lens)
    assert owner.tolist() == [1, 2, 2, 2, 4] and b"".join(r.tobytes().rstrip(b"\0") for r in x) == raw.tobytes()


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    rows = QUERIES["op13_language"](spark, d).collect()
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    assert len(rows) == len(truth)
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_awkward_rows(spark, awkward):
    docs = awkward.withColumn("lang", F.when(F.length("text") % 2 == 0, "odd").otherwise("even")).withColumn("score", F.lit("z")).withColumn("lang_pred", F.lit(None).cast("string"))
    got = L.identify(docs, F.col("doc_id") % 5 != 0, steps=3, full=True).collect()
    assert len(got) == 16 and {r["lang_pred"] for r in got} <= {"odd", "even", "und"}
    und = sorted((r["doc_id"] for r in got if r["lang_pred"] == "und"), key=str)
    assert und == [0, 1, 2, None]  # null, empty, blank, line ends
    assert all(r["held_out"] == (r["doc_id"] is None or r["doc_id"] % 5 == 0) for r in got)
    assert all(abs(sum(r["probabilities"].values()) - 1) < 1e-3 for r in got if r["lang_pred"] != "und")
    nothing = L.identify(docs.withColumn("lang", F.lit(None).cast("string")), F.lit(True)).collect()
    assert len(nothing) == 16 and all(r["lang_pred"] == "und" and r["score"] == 0 for r in nothing)
    assert L.identify(docs.limit(0), F.lit(True)).count() == 0


def test_label_is_no_input(spark):
    """The label of a held-out row moves nothing; a long text counts whole."""
    rows = [(k, ("the cat and dog " if k % 2 else "der hund und die ") * 5, "en" if k % 2 else "de") for k in range(40)]
    rows += [(40, "the cat and dog " + "der hund und die " * 20_000, "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learn = F.col("doc_id") < 20
    a = sorted(map(tuple, L.identify(df, learn, steps=60).collect()))
    b = sorted(map(tuple, L.identify(df.withColumn("lang", F.when(learn, F.col("lang")).otherwise("zz")), learn, steps=60).collect()))
    assert a == b and [r[2] for r in a] == ["en" if k % 2 else "de" for k in range(40)] + ["de"]
