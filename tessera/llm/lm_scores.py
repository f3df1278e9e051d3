"""Cross-entropy difference of a target and a background bigram model that count every word and every word pair."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_in, id_out, settle, small_batches, staged
from .pieces import text_chunks

#: Keys that stand for a document's beginning, for all words outside a limited vocabulary, and for no left word (counts of single words).
BEGIN, OTHER, SINGLE = 0, 1, 2
#: Bytes of a word's key. That no two words of the corpus share one is checked when they are counted; if two do, all are dealt anew.
KEY_BYTES = 7
#: Characters of a part: within it, each word and pair is counted and looked up once.
PART_CHARS = 16_000_000
#: Places that are scored at once.
PLACES = 1_000_000
#: Words and pairs of parts that are summed at once.
GROUP_ROWS = 2_000_000


def _coded(texts: list):
    """Distinct lower-case words of a batch, every document's words as indices into them, and where its words end."""
    import pyarrow as pa
    import pyarrow.compute as pc

    cut = pc.ascii_split_whitespace(pc.utf8_lower(pc.fill_null(pa.array(texts, pa.string()), "")))
    coded = cut.flatten().dictionary_encode()
    at, bounds = coded.indices.to_numpy(), cut.offsets.to_numpy() - cut.offsets[0].as_py()
    real = ~pc.equal(coded.dictionary, "").to_numpy(zero_copy_only=False)[at]  # empty ones stand before and after white space
    return coded.dictionary, at[real], np.concatenate([[0], np.cumsum(real)])[bounds]


def vocabulary(texts: DataFrame, size: int) -> list[str]:
    """The frequent words of all documents, at most ``size``: those from the least sixteenth of a power of two on that leaves
    so few. Counts are summed over the whole corpus; the driver gets the sizes of count classes, then the words."""

    def count(batches):
        total: Counter = Counter()
        for pdf in batches:
            t = pdf["t"].tolist()
            for lo, hi in text_chunks(t):
                names, at, _ = _coded(t[lo:hi])
                total.update(dict(zip(names.to_pylist(), np.bincount(at, minlength=len(names)).tolist())))
                if len(total) > 500_000:
                    yield pd.DataFrame({"w": list(total), "n": list(total.values())})
                    total = Counter()
        if total:
            yield pd.DataFrame({"w": list(total), "n": list(total.values())})

    counts = texts.select("t").mapInPandas(count, "w string, n long").groupBy("w").agg(F.sum("n").alias("n"))
    counts = staged(counts.where("n > 0").withColumn("class", F.floor(F.log2("n") * 16).cast("int")), "word-counts")
    total, least = 0, None
    for r in sorted(counts.groupBy("class").agg(F.count("*").alias("words")).collect(), reverse=True):
        if total + r["words"] > size:
            break
        total, least = total + r["words"], r["class"]
    return [] if least is None else sorted(counts.where(F.col("class") >= least).select("w").toArrow().to_pandas()["w"])


def _keys(words: list, seed: int) -> np.ndarray:
    raw = pd.util.hash_array(np.array(words, object), hash_key=f"tessera-{seed:08d}", categorize=False)
    return (raw % np.uint64((1 << 8 * KEY_BYTES) - 3) + np.uint64(3)).astype(np.int64)


def _pack(values: np.ndarray, width: int) -> bytes:
    """Whole numbers in zstd, each of their ``width`` bytes in a row of its own."""
    import pyarrow as pa

    plane = np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return pa.Codec("zstd", 1).compress(plane.tobytes(), asbytes=True)


def _unpack(raw: bytes, n: int, width: int) -> np.ndarray:
    import pyarrow as pa

    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(pa.Codec("zstd").decompress(raw, n * width), np.uint8).reshape(width, n).T
    return out.reshape(-1).view("<i8")


def _times(keys: np.ndarray) -> np.ndarray:
    """How often each key occurs, at each of its places."""
    _, at, n = np.unique(keys, return_inverse=True, return_counts=True)
    return n[at]


def _digest(row: dict, groups: int):
    """Of one part: the words of each document, the number of each place's pair, the words of each pair, and keys, group and
    order of all that is counted, the pairs first and then the words with the beginning as the last one."""
    keys, right = np.append(np.frombuffer(row["keys"], np.int64), BEGIN), _unpack(row["ids"], row["n"], 4)
    lens, begin = np.frombuffer(row["lens"], np.int64), len(keys) - 1
    left = np.concatenate([[begin], right[:-1]]) if len(right) else right.copy()
    left[(np.cumsum(lens) - lens)[lens > 0]] = begin
    both, pair = np.unique(left * (begin + 1) + right, return_inverse=True)
    left, right = both // (begin + 1), both % (begin + 1)
    l, r = np.concatenate([keys[left], np.full(begin + 1, SINGLE)]), np.concatenate([keys[right], keys])
    mixed = (l.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ r.astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
    group = ((mixed >> np.uint64(32)) % np.uint64(groups)).astype(np.int64)
    return lens, pair, left, right, l, r, group, np.lexsort((l, group))


def _parts(texts: DataFrame, seed: int, names: list[str] | None) -> DataFrame:
    """Texts(d, t, hit, twins, targets) in parts, one a row: ids, hits, rows of the same text and numbers of words of its documents, their words as numbers, and each
    number's word and key."""
    shared = None if names is None else texts.sparkSession.sparkContext.broadcast(names)

    def part(k: int, d: list, hit: list, twins: list, targets: list, texts: list, known):
        import pyarrow as pa
        import pyarrow.compute as pc

        words, at, bounds = _coded(texts)
        words = words.to_pylist()
        if "" in words:  # it stands at no place
            gone = words.index("")
            words, at = words[:gone] + words[gone + 1 :], at - (at > gone)
        keys = _keys(words, seed)
        if known is not None:
            outside = ~pc.is_in(pa.array(words, pa.string()), value_set=known).to_numpy(zero_copy_only=False)
            keys[outside] = OTHER
            words = ["" if x else w for w, x in zip(words, outside)]
        row = {"part": k, "n": len(at), "d": np.array(d, np.int64).tobytes(), "hit": np.array(hit, bool).tobytes(), "twins": np.array(twins, np.int64).tobytes(), "targets": np.array(targets, np.int64).tobytes(), "lens": np.diff(bounds).astype(np.int64).tobytes(), "ids": _pack(at, 4), "keys": keys.tobytes(), "words": "\n".join(words).encode()}
        return pa.RecordBatch.from_pylist([row], pa.schema([(c, pa.int64() if c in ("part", "n") else pa.binary()) for c in row]))

    def encode(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        known = None if shared is None else pa.array(shared.value, pa.string())
        k, held, chars = TaskContext.get().partitionId() << 32, [[], [], [], [], []], 0
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for lo, hi in text_chunks(columns[1]):
                more = sum(len(x or "") for x in columns[1][lo:hi])
                if held[0] and chars + more > PART_CHARS:
                    yield part(k, *held, known)
                    k, held, chars = k + 1, [[], [], [], [], []], 0
                chars += more
                for rows, c in zip(held, (columns[0], columns[2], columns[3], columns[4], columns[1])):
                    rows += c[lo:hi]
        if held[0]:
            yield part(k, *held, known)

    return texts.select("d", "t", "hit", "twins", "targets").mapInArrow(encode, "part long, n long, d binary, hit binary, twins binary, targets binary, lens binary, ids binary, keys binary, words binary")


def _counted(parts: DataFrame, groups: int) -> DataFrame:
    """For each part and group the corpus's counts of the part's words and pairs of the group, in their order, and for each group
    its distinct words, their counts and the words that share a key."""
    import pyarrow as pa

    sent = pa.schema([("group", pa.int64()), ("part", pa.int64()), ("n", pa.int64()), *[(c, pa.binary()) for c in ("l", "r", "b", "t", "words")]])

    def own(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                lens, pair, left, right, l, r, group, order = _digest(row, groups)
                hit, n, begin = np.frombuffer(row["hit"], bool), len(left), len(l) - len(left) - 1
                words, at = np.array([*(row["words"].decode().split("\n") if begin else []), ""], object), _unpack(row["ids"], row["n"], 4)
                counts = []
                for mine, docs in ((slice(None), lens > 0), (np.repeat(hit, lens), hit & (lens > 0))):
                    c = np.concatenate([np.bincount(pair[mine], minlength=n), np.bincount(at[mine], minlength=begin + 1)])
                    c[-1] = docs.sum()
                    counts.append(c)
                ends = np.searchsorted(group[order], np.arange(groups + 1))
                out = []
                for g in np.flatnonzero(np.diff(ends)):
                    o = order[ends[g] : ends[g + 1]]
                    text = pa.compress("\n".join(words[o[o >= n] - n]).encode(), "zstd", asbytes=True) if (o >= n).any() else b""
                    size = sum(len(w.encode()) + 1 for w in words[o[o >= n] - n]) - 1
                    out.append({"group": int(g), "part": row["part"], "n": len(o), "l": _pack(l[o], KEY_BYTES), "r": _pack(r[o], KEY_BYTES), "b": _pack(counts[0][o], 5), "t": _pack(counts[1][o], 5), "words": size.to_bytes(8, "little") + text if text else b""})
                yield pa.RecordBatch.from_pylist(out, sent)

    def total(table):
        rows = table.to_pylist()
        sizes = [x["n"] for x in rows]
        l, r = (np.concatenate([_unpack(x[c], x["n"], KEY_BYTES) for x in rows]) for c in "lr")
        order = np.lexsort((r, l))
        new = np.concatenate([[True], (l[order][1:] != l[order][:-1]) | (r[order][1:] != r[order][:-1])])
        same = np.empty(len(l), np.int64)
        same[order] = np.cumsum(new) - 1
        first = order[new]
        single = l == SINGLE
        text = np.array([w for x in rows if x["words"] for w in pa.decompress(x["words"][8:], int.from_bytes(x["words"][:8], "little"), "zstd", asbytes=True).decode().split("\n")], object)
        place = np.cumsum(single) - 1
        clashes = int((text != text[place[first[same[single]]]]).sum()) if len(text) else 0
        out = {"part": [x["part"] for x in rows], "group": [x["group"] for x in rows], "n": sizes}
        sums = {}
        ends = np.cumsum([0, *sizes])
        for c in "bt":
            n = np.bincount(same, np.concatenate([_unpack(x[c], x["n"], 5) for x in rows]), minlength=len(first)).astype(np.int64)
            sums[c] = int(n[single[first]].sum())
            n = n[same]
            out[c] = [_pack(n[x:y], 6) for x, y in zip(ends, ends[1:])]
        rest = [None] * (len(rows) - 1)
        return pa.table({**out, "words": pa.array([int(single[first].sum()), *rest], pa.int64()), "all_b": pa.array([sums["b"], *rest], pa.int64()), "all_t": pa.array([sums["t"], *rest], pa.int64()), "clashes": pa.array([clashes, *rest], pa.int64())})

    rows = parts.mapInArrow(own, "group long, part long, n long, l binary, r binary, b binary, t binary, words binary")
    return rows.groupBy("group").applyInArrow(total, "part long, group long, n long, b binary, t binary, words long, all_b long, all_t long, clashes long")


def cross_entropy_difference(docs: DataFrame, target: DataFrame, vocabulary_size: int | None = None, id_col: str = "doc_id", text_col: str = "text", small: int = 2_000_000, lean: float = 4.0) -> DataFrame:
    """One row per document: doc_id, n_words, in_target, target_loss, background_loss, loss_difference (mean nats a word).

    ``target`` holds the ids of the target documents; the background is all documents. Every word and every pair of
    neighbours (a document's beginning counts as a word) is counted exactly; the counts stay in tables that grow with the
    corpus. A pair's probability leans on its word's by ``lean`` counts:
    p(w | v) = (c(v, w) + lean * p(w)) / (c(v) + lean), with p(w) = (c(w) + 1/2) / (N + V / 2).
    Both models have the same V words, order and smoothing, so their difference is not moved by unknown words. No document
    scores itself or a copy of itself: its words and pairs are taken off the counts of the models as often as its text was counted in
    them, so neither target documents nor copies are favoured for being known. A given ``vocabulary_size``
    makes one word of all but the most frequent ones; without it no word is dropped.
    Lower differences are more like the target. No words (null, empty): 0 words and losses 0. An empty target leaves
    its model with the smoothing alone. Null ids are never in the target; repeated rows are scored each.
    """
    small_batches(docs.sparkSession)
    ids = staged(target.select(F.col(target.columns[0]).cast("long").alias("d")).where("d is not null").distinct(), "target").withColumn("hit", F.lit(True))
    texts = docs.select(id_in(id_col).alias("d"), F.col(text_col).cast("string").alias("t"))
    names = None if vocabulary_size is None else vocabulary(texts, vocabulary_size - 2)
    texts = texts.join(F.broadcast(ids) if ids.count() <= small else ids, "d", "left").select("d", "t", F.coalesce("hit", F.lit(False)).alias("hit"))
    # rows of one text, itself included, and those of them in the target; texts that stand once need no row
    texts = texts.withColumns({"h": F.xxhash64("t"), "g": F.xxhash64("t", F.lit(1))})
    same = staged(texts.groupBy("h", "g").agg(F.count("*").alias("twins"), F.count(F.when(F.col("hit"), 1)).alias("targets")).where("twins > 1"), "twins")
    own = {"twins": F.coalesce("twins", F.lit(1)).cast("long"), "targets": F.coalesce("targets", F.col("hit").cast("long"))}
    texts = texts.join(F.broadcast(same) if same.count() <= small else same, ["h", "g"], "left").withColumns(own).drop("h", "g")
    for seed in range(8):
        parts = staged(_parts(texts, seed, names), "word-ids")
        groups = max(64, -(-(parts.agg(F.sum("n")).first()[0] or 0) // (2 * GROUP_ROWS)))  # a part has about half as many words and pairs as places
        counts = staged(_counted(parts, groups), "word-counts")
        settle(docs.sparkSession)  # the pairs sent to be counted are the largest part of the disk
        n_words, n_background, n_target, clashes = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("words", "all_b", "all_t", "clashes")]).first()
        if not clashes:
            break
    else:
        raise RuntimeError("cross_entropy_difference: words share a key under every seed")
    n_words = n_words if names is None else len(names) + 2

    def score(own, counts):
        import pyarrow as pa

        row, rows = own.to_pylist()[0], sorted(counts.to_pylist(), key=lambda x: x["group"])
        lens, pair, left, right, l, r, group, order = _digest(row, groups)
        hit, out, totals = np.frombuffer(row["hit"], bool), {n: np.zeros(len(lens)) for n in "tb"}, []
        times = {"t": np.frombuffer(row["targets"], np.int64), "b": np.frombuffer(row["twins"], np.int64)}
        for name, total in (("t", n_target), ("b", n_background)):
            n = np.empty(len(order), np.int64)
            n[order] = np.concatenate([_unpack(x[name], x["n"], 6) for x in rows])
            totals.append((name, total, n[: len(left)], n[len(left) :]))
        # words of one key (those outside a limited vocabulary) are one word
        code = np.unique(np.append(np.frombuffer(row["keys"], np.int64), BEGIN), return_inverse=True)[1]
        pair_code = np.unique(code[left] * len(code) + code[right], return_inverse=True)[1]
        ends = np.cumsum(lens)
        first = 0
        while first < len(lens):  # some documents at a time, so that what stands for each place stays small
            last = max(first + 1, int(np.searchsorted(ends, ends[first] - lens[first] + PLACES, side="right")))
            mine, size = pair[ends[first] - lens[first] : ends[last - 1]], lens[first:last]
            doc = np.repeat(np.arange(len(size)), size)
            a, b = left[mine], right[mine]
            both_own, word_own = _times(doc * len(left) + pair_code[mine]), _times(doc * len(code) + code[b])
            left_own = np.concatenate([[1], word_own[:-1]])[: len(mine)]
            left_own[(np.cumsum(size) - size)[size > 0]] = 1  # the beginning
            for name, total, both, word in totals:
                self = times[name][first:last][doc]  # how often this text was counted
                p = (word[b] - self * word_own + 0.5) / (total - self * (size[doc] + 1) + 0.5 * n_words)
                loss = -np.log((both[mine] - self * both_own + lean * p) / (word[a] - self * left_own + lean))
                out[name][first:last] = np.bincount(doc, loss, minlength=len(size)) / np.maximum(size, 1)
            first = last
        return pa.table({"doc_id": np.frombuffer(row["d"], np.int64), "n_words": lens, "in_target": pa.array(hit), "target_loss": out["t"], "background_loss": out["b"], "loss_difference": out["t"] - out["b"]})

    schema = "doc_id long, n_words long, in_target boolean, target_loss double, background_loss double, loss_difference double"
    own = parts.select("part", "n", "d", "hit", "twins", "targets", "lens", "ids", "keys")
    scored = own.groupBy("part").cogroup(counts.select("part", "group", "n", "b", "t").groupBy("part")).applyInArrow(score, schema)
    return scored.withColumn("doc_id", id_out("doc_id"))
