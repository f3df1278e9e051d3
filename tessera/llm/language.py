"""Language ID: a bidirectional gated recurrent network over bytes that labels every position and pools them by document."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import id_in, id_out, small_batches
from .pieces import text_chunks

#: Bytes that the network reads in a row: a text is cut into windows of so many, each read from both ends.
WINDOW = 128
#: Windows that go through the network at once.
AT_ONCE = 2048
#: Bytes whose position counts in a document's result: ASCII letters, and all parts of other characters.
LETTER = np.array([b >= 128 or chr(b).isalpha() for b in range(256)])


def windows_of(raw: np.ndarray, lens: np.ndarray, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a batch of texts in rows of ``size`` (short ends filled with 0), and the text of each row; every byte stands once."""
    n = -(-lens // size)
    owner = np.repeat(np.arange(len(lens)), n)
    out = np.zeros(len(owner) * size, np.uint8)
    begin = (np.cumsum(n) - n) * size
    out[np.arange(len(raw)) + np.repeat(begin - (np.cumsum(lens) - lens), lens)] = raw
    return out.reshape(-1, size), owner


class Network:
    """Weights of two gated recurrent layers, one a direction, and of the output; all computations for whole batches of windows.

    z, r = sigmoid(input + h U), n = tanh(input + r * (h V + b)), h' = n + z (h - n). Sigmoids are written as tanh, so gates share a call.
    """

    def __init__(self, labels: list, hidden: int, seed: int):
        rng = np.random.default_rng(seed)
        self.labels, self.hidden = labels, hidden
        draw = lambda *shape, by: (rng.normal(size=shape) * by).astype(np.float32)
        self.w = {}
        for way in "fb":
            self.w[f"e{way}"] = draw(256, 3 * hidden, by=0.5)
            self.w[f"u{way}"] = draw(hidden, 3 * hidden, by=hidden**-0.5)
            self.w[f"v{way}"] = np.zeros(hidden, np.float32)  # inside the reset gate
        self.w["o"], self.w["c"] = draw(2 * hidden, len(labels), by=hidden**-0.5), np.zeros(len(labels), np.float32)

    def layer(self, x: np.ndarray, way: str) -> tuple[np.ndarray, list]:
        """States (time, window, hidden) of the bytes x (time, window) in one direction, and what each step computed."""
        H, steps, n = self.hidden, *x.shape
        e, u, v = self.w[f"e{way}"], self.w[f"u{way}"], self.w[f"v{way}"]
        out, h = np.empty((steps, n, H), np.float32), np.zeros((n, H), np.float32)
        kept = []
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            i, g = e[x[t]], h @ u
            gates = 0.5 + 0.5 * np.tanh(0.5 * (i[:, : 2 * H] + g[:, : 2 * H]))
            s = g[:, 2 * H :] + v
            m = np.tanh(i[:, 2 * H :] + gates[:, H:] * s)
            kept.append((t, h, gates, s, m))
            h = m + gates[:, :H] * (h - m)
            out[t] = h
        return out, kept

    def states(self, x: np.ndarray, way: str) -> np.ndarray:
        """The states of ``layer`` alone, in buffers that are used again; the halves of the sigmoids are in the weights."""
        H, steps, n = self.hidden, *x.shape
        half = np.float32(0.5)
        e, u, v = self.w[f"e{way}"], self.w[f"u{way}"], self.w[f"v{way}"]
        e_gate, e_new, u_gate, u_new = (np.ascontiguousarray(w) for w in (e[:, : 2 * H] * half, e[:, 2 * H :], u[:, : 2 * H] * half, u[:, 2 * H :]))
        out, h = np.empty((steps, n, H), np.float32), np.zeros((n, H), np.float32)
        i, g, j, m = (np.empty((n, w), np.float32) for w in (2 * H, 2 * H, H, H))
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            np.take(e_gate, x[t], axis=0, out=i, mode="clip")
            np.matmul(h, u_gate, out=g)
            g += i
            np.tanh(g, out=g)
            g += 1
            g *= half
            np.matmul(h, u_new, out=m)
            m += v
            m *= g[:, H:]
            np.take(e_new, x[t], axis=0, out=j, mode="clip")
            m += j
            np.tanh(m, out=m)
            np.subtract(h, m, out=j)
            j *= g[:, :H]
            h = np.add(m, j, out=out[t])
        return out

    def positions(self, forth: np.ndarray, back: np.ndarray) -> np.ndarray:
        """Probability of each label at each position (label, time, window)."""
        H, steps, n = self.hidden, *forth.shape[:2]
        p = self.w["o"][:H].T @ forth.reshape(-1, H).T
        p += self.w["o"][H:].T @ back.reshape(-1, H).T
        p += self.w["c"][:, None]
        p -= p.max(axis=0)
        np.exp(p, out=p)
        p /= p.sum(axis=0)
        return p.reshape(-1, steps, n)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean cross-entropy of the letters' positions, windows labelled y, and its gradient by backpropagation through time."""
        (forth, a), (back, b) = self.layer(x, "f"), self.layer(x, "b")
        p = np.moveaxis(self.positions(forth, back), 0, 2)
        H, mask = self.hidden, LETTER[x]
        total = max(1, int(mask.sum()))
        loss = -np.log(p[:, np.arange(len(y)), y] + 1e-9)[mask].sum() / total
        d = p.copy()
        d[:, np.arange(len(y)), y] -= 1
        d *= (mask / total)[:, :, None].astype(np.float32)
        flat = lambda z: z.reshape(-1, z.shape[2])
        grad = {"o": np.concatenate([flat(forth).T @ flat(d), flat(back).T @ flat(d)]), "c": flat(d).sum(axis=0)}
        for way, kept, rows in (("f", a, slice(0, H)), ("b", b, slice(H, 2 * H))):
            from_out = d @ self.w["o"][rows].T
            u = self.w[f"u{way}"]
            by_input, du, dv = np.empty((*x.shape, 3 * H), np.float32), np.zeros_like(u), np.zeros(H, np.float32)
            dh = np.zeros((x.shape[1], H), np.float32)
            for t, h, gates, s, m in reversed(kept):
                dh = dh + from_out[t]
                z, r = gates[:, :H], gates[:, H:]
                dm = dh * (1 - z) * (1 - m * m)
                di, ds = by_input[t], dm * r
                di[:] = np.concatenate([dh * (h - m) * z * (1 - z), dm * s * r * (1 - r), dm], axis=1)  # by the inputs of the gates
                dg = np.concatenate([di[:, : 2 * H], ds], axis=1)  # by h U
                du += h.T @ dg
                dv += ds.sum(axis=0)
                dh = dh * z + dg @ u.T
            grad |= {f"e{way}": self.by_byte(x, flat(by_input)), f"u{way}": du, f"v{way}": dv}
        return float(loss), grad

    @staticmethod
    def by_byte(x: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Sums of the rows of each byte of x."""
        order = np.argsort(x, axis=None, kind="stable")
        n = np.bincount(x.ravel(), minlength=256)
        out = np.zeros((256, rows.shape[1]), np.float32)
        some = np.flatnonzero(n)
        out[some] = np.add.reduceat(rows[order], (np.cumsum(n) - n)[some], axis=0)
        return out

    def train(self, x: np.ndarray, y: np.ndarray, steps: int, batch: int, rate: float, seed: int) -> list[float]:
        """Adam over batches of windows (rows of x) with every label as likely; returns the losses."""
        rng = np.random.default_rng(seed)
        of = [np.flatnonzero(y == k) for k in range(len(self.labels))]
        first, second, losses = {k: np.zeros_like(v) for k, v in self.w.items()}, {k: np.zeros_like(v) for k, v in self.w.items()}, []
        for step in range(1, steps + 1):
            label = rng.integers(0, len(of), batch)
            rows = np.array([of[k][rng.integers(len(of[k]))] for k in label])
            loss, grad = self.gradients(np.ascontiguousarray(x[rows].T), label)
            losses.append(loss)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            now = rate * (1 - (step - 1) / steps)
            for k, g in grad.items():
                g = g * min(1.0, 1.0 / max(norm, 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                self.w[k] = (self.w[k] - now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return losses

    def documents(self, raw: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """(text, label): mean probability over all positions of letters; rows of texts without one are nought."""
        x, owner = windows_of(raw, lens)
        total, n = np.zeros((len(lens), len(self.labels))), np.zeros(len(lens))
        for lo in range(0, len(x), AT_ONCE):
            part, own = np.ascontiguousarray(x[lo : lo + AT_ONCE].T), owner[lo : lo + AT_ONCE]
            mask = LETTER[part]
            p = self.positions(self.states(part, "f"), self.states(part, "b"))
            p *= mask
            for k, sums in enumerate(p.sum(axis=1)):
                total[:, k] += np.bincount(own, sums, minlength=len(lens))
            n += np.bincount(own, mask.sum(axis=0), minlength=len(lens))
        return total / np.maximum(n, 1)[:, None]


def flat_bytes(texts: list) -> tuple[np.ndarray, np.ndarray]:
    raw = [(t or "").encode("utf-8", "replace") for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.fromiter(map(len, raw), np.int64, len(raw))


def sample_windows(docs: DataFrame, per_label: int, per_text: int) -> tuple[np.ndarray, np.ndarray, list]:
    """Training windows (row, WINDOW), the number of each row's label, and the labels in order, from docs(d, t, lang).

    Of each label the ``per_label`` texts with the smallest hash, of each of them at most ``per_text`` windows, evenly over the whole
    text; Spark picks them, so the driver gets at most per_label * per_text * WINDOW bytes a label.
    """
    known = docs.where("lang is not null and length(t) > 0").withColumn("_h", F.xxhash64("d", "t", F.lit("language")))
    # a label's rows are first thinned by their hash to about twice what is asked for, so that the ranking gets no more than that
    size = known.groupBy("lang").agg(F.count("*").alias("_size"))  # a row a label
    near = F.pmod("_h", F.lit(1 << 40)) * F.col("_size") < F.lit(2 * per_label + 200) * F.lit(float(1 << 40))
    by = Window.partitionBy("lang").orderBy(F.pmod("_h", F.lit(1 << 40)), "_h", "d")
    some = known.join(F.broadcast(size), "lang").where(near).withColumn("_n", F.row_number().over(by)).where(F.col("_n") <= per_label)

    def cut(batches):
        for pdf in batches:
            texts = pdf["t"].tolist()
            for lo, hi in text_chunks(texts):
                raw, lens = flat_bytes(texts[lo:hi])
                x, owner = windows_of(raw, lens)
                n = np.bincount(owner, minlength=hi - lo)
                first = np.cumsum(n) - n
                at = [first[k] + np.unique(np.linspace(0, n[k] - 1, min(per_text, n[k])).round().astype(int)) for k in range(hi - lo)]
                yield pd.DataFrame({"lang": pdf["lang"].iloc[lo:hi].values, "x": [x[i].tobytes() for i in at]})

    rows = some.select("lang", "t").mapInPandas(cut, "lang string, x binary").toPandas()
    rows = rows.sort_values(["lang", "x"])  # the same order whatever the partitions
    labels = sorted(set(rows["lang"]))
    x = np.frombuffer(b"".join(rows["x"]), np.uint8).reshape(-1, WINDOW)
    y = np.repeat(np.searchsorted(labels, rows["lang"].to_numpy(object)), [len(b) // WINDOW for b in rows["x"]]) if labels else np.zeros(0, np.int64)
    mask = LETTER[x].any(axis=1)
    return x[mask], y[mask], labels


def fit(docs: DataFrame, hidden: int = 8, per_label: int = 500, per_text: int = 8, steps: int = 400, batch: int = 192, rate: float = 0.02, seed: int = 7) -> Network | None:
    """A network trained on docs(d, t, lang), at most ``per_label`` texts of each label; None where there is nothing to learn from."""
    x, y, labels = sample_windows(docs, per_label, per_text)
    seen = sorted(set(y.tolist()))
    if not seen:
        return None
    model = Network([labels[k] for k in seen], hidden, seed)
    model.train(x, np.searchsorted(seen, y), steps if len(seen) > 1 else 0, batch, rate, seed)
    return model


def identify(docs: DataFrame, learn_from, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", full: bool = False, **settings) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, and with ``full`` probabilities (map of label to mean probability).

    ``learn_from`` is a Column over the documents: true where a row's text and label may be learned from; the others are held out.
    The label is never an input of a prediction, nor is any other column but the text. Every byte of every text goes through the
    network, in windows of 128 bytes; each position of a letter gets a probability of each label, and a document the means over
    them: lang_pred is the likeliest (ties to the smaller label), score its mean probability. Null, empty and letterless texts, and
    all texts where there is nothing to learn from, are 'und' with score 0. Repeated rows and null ids are rows of their own. The
    sample is bounded (``fit``); training takes the same time at every size. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(id_in(id_col).alias("d"), F.col(text_col).cast("string").alias("t"), F.col(label_col).cast("string").alias("lang"), F.coalesce(learn_from, F.lit(False)).alias("may"))
    model = fit(rows.where("may").select("d", "t", "lang"), **settings)
    some = rows.select("d", "may", F.coalesce(F.col("t").rlike(r"\p{L}"), F.lit(False)).alias("letters"), "t")

    def run(batches):
        for pdf in batches:
            texts = [t if ok else "" for t, ok in zip(pdf["t"], pdf["letters"])]
            for lo, hi in text_chunks(texts, 1_000_000):
                part = pdf.iloc[lo:hi]
                n, real = hi - lo, part["letters"].to_numpy() & (model is not None)
                p = model.documents(*flat_bytes(texts[lo:hi])) if model else np.zeros((n, 1))
                best, names = p.argmax(axis=1), np.array(model.labels if model else ["und"], object)
                out = {"doc_id": part["d"].values, "held_out": ~part["may"].to_numpy(), "lang_pred": np.where(real, names[best], "und"), "score": np.where(real, np.clip(p[np.arange(n), best], 0, 1), 0.0)}
                if full:
                    out["probabilities"] = [dict(zip(names, map(float, q))) if ok else {} for q, ok in zip(p, real)]
                yield pd.DataFrame(out)

    schema = "doc_id long, held_out boolean, lang_pred string, score double" + ", probabilities map<string, double>" * full
    return some.mapInPandas(run, schema).withColumn("doc_id", id_out("doc_id"))
