"""N-gram Jaccard join by prefix trees of globally ordered n-gram sets.

1. Documents with equal n-gram sets form one class; only its representative goes on.
2. A set's prefix is its first |s| - ceil(t |s|) + 1 n-grams in a global order, rare ones first; two sets that reach
   the threshold share an n-gram of their prefixes, and the more the nearer their sizes are. Representatives that share
   enough, directly or through others, form a block; so every link lies within a block.
3. Each block (in pairs of bounded chunks, if it is large) is joined in a trie of its sets: a probing set goes down
   the tree, partial overlaps are counted once for all sets below a node, and subtrees that the remaining lengths rule
   out, or whose sets are already connected with the probing one, are not entered.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import NULL_ID, components, id_in, pick, small_batches, staged

_WORDS: dict[bytes, int] = {}
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list, n: int = 4) -> list[np.ndarray]:
    """The ascending distinct 64-bit hashes of each text's n-word shingles; fewer words are one shingle, none is an empty set."""
    import pyarrow as pa
    import pyarrow.compute as pc
    import xxhash

    if len(_WORDS) > 150_000:
        _WORDS.clear()
    t = pc.fill_null(pa.array(texts, pa.string()), "")
    words = pc.ascii_split_whitespace(pc.ascii_lower(t))  # blank and \x09-\x0D
    coded = words.flatten().dictionary_encode()
    names = coded.dictionary.cast(pa.binary()).to_pylist()
    for w in names:
        if w not in _WORDS:
            _WORDS[w] = xxhash.xxh3_64_intdigest(w)
    h = np.fromiter(map(_WORDS.__getitem__, names), np.uint64, len(names))[coded.indices.to_numpy()]
    empty = np.array([w == b"" for w in names], bool)[coded.indices.to_numpy()]  # before leading and after trailing white space
    bounds = words.offsets.to_numpy() - words.offsets[0].as_py()
    doc = np.repeat(np.arange(len(texts)), np.diff(bounds))[~empty]
    h = h[~empty]
    count = np.bincount(doc, minlength=len(texts))
    end = np.cumsum(count)
    out: list[np.ndarray] = []
    if len(h) >= n:
        rolled = np.zeros(len(h) - n + 1, np.uint64)
        for k in range(n):
            rolled = _mix(rolled + h[k : len(h) - n + 1 + k] * _ODD[k % 4] + np.uint64(k + 1))
    for a, b in zip((end - count).tolist(), end.tolist()):
        if b - a >= n:
            out.append(np.unique(rolled[a : b - n + 1]))
        elif b > a:
            v = np.zeros(1, np.uint64)
            for k in range(b - a):
                v = _mix(v + h[a + k : a + k + 1] * _ODD[k % 4] + np.uint64(k + 1))
            out.append(_mix(v + np.full(1, b - a, np.uint64) * _ODD[0]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def prefix_length(size: int, num: int, den: int) -> int:
    return size - -(-num * size // den) + 1 if size else 0


class SetTrie:
    """A radix tree of ascending token sequences, in arrays by levels (parents first, siblings together).

    A node has the documents lo..hi in sorted order, the label between the depths begin and end (a slice of ``labels``
    from ``at``), its children, and the least and greatest set size below.
    """

    def __init__(self, seqs: list[np.ndarray]):
        self.order = sorted(range(len(seqs)), key=lambda k: seqs[k].tobytes())  # big-endian, so bytes sort as tokens
        self.seqs = [seqs[k].astype(np.int64) for k in self.order]
        n = len(seqs)
        self.size = np.array([len(s) for s in self.seqs])
        shared = np.zeros(n + 1, np.int64)  # common prefix with the sequence before
        for k in range(1, n):
            a, b = self.seqs[k - 1], self.seqs[k]
            m = min(len(a), len(b))
            d = np.flatnonzero(a[:m] != b[:m])
            shared[k] = d[0] if len(d) else m
        nodes, first, labels, level = [], [], [], [(0, n, 0)]
        while level:
            below = []
            base = len(nodes) + len(level)
            for lo, hi, begin in level:
                end = len(self.seqs[lo]) if hi - lo == 1 else int(shared[lo + 1 : hi].min())
                nodes.append((lo, hi, end, self.size[lo:hi].min(), self.size[lo:hi].max()))
                labels.append(self.seqs[lo][begin:end])
                cuts = [lo, *(np.flatnonzero(shared[lo + 1 : hi] == end) + lo + 1).tolist(), hi] if hi - lo > 1 else []
                first.append((base + len(below), max(0, len(cuts) - 1)))
                below += [(a, b, end) for a, b in zip(cuts, cuts[1:])]
            level = below
        self.lo, self.hi, self.end, self.least, self.most = (np.array(x, np.int64) for x in zip(*nodes))
        self.child, self.children = (np.array(x, np.int64) for x in zip(*first))
        self.length = np.array([len(x) for x in labels], np.int64)
        self.labels = np.concatenate([*labels, np.zeros(1, np.int64)])
        self.at = np.cumsum(self.length) - self.length
        self.last = np.array([x[-1] if len(x) else -1 for x in labels], np.int64)


def _spread(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All positions of the slices, one after another."""
    ends = np.cumsum(length)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - length), length)


def trie_links(sets: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    """Pairs (i, j) that link and together connect all sets that links connect: a spanning forest of the exact join.

    Two sets link when den * |a & b| >= num * |a | b|. A probing set goes down the tree level by level; the overlap of
    a path is counted once for all sets below it. Subtrees end where remaining lengths rule links out, where only
    earlier probes are left, or where all sets are connected with the probe already.
    """
    n = len(sets)
    if n < 2:
        return []
    flat = np.concatenate(sets)
    names, code, times = np.unique(flat, return_inverse=True, return_counts=True)
    rank = np.empty(len(names), np.int64)
    rank[np.argsort(-times, kind="stable")] = np.arange(len(names))  # frequent first: the tree then shares long paths
    code = rank[code]
    cut = np.cumsum([0, *[len(s) for s in sets]])
    t = SetTrie([np.sort(code[a:b]).astype(">u4") for a, b in zip(cut, cut[1:])])
    comp, member, out = np.arange(n), np.zeros(len(names) + 1, np.int64), []
    for x in range(n):
        own = t.seqs[x]
        nx = len(own)
        if not nx:
            continue
        member[own] = 1
        mine = np.concatenate([[0], np.cumsum(comp == comp[x])])
        f, shared = np.zeros(1, np.int64), np.zeros(1, np.int64)
        while len(f):
            lo, hi, most, least = t.lo[f], t.hi[f], t.most[f], t.least[f]
            good = (hi > x + 1) & (mine[hi] - mine[lo] < hi - lo) & (most > 0) & (den * np.minimum(nx, most) >= num * np.maximum(nx, least))
            f, shared = f[good], shared[good]
            if not len(f):
                break
            length = t.length[f]
            seen = np.concatenate([[0], np.cumsum(member[t.labels[_spread(t.at[f], length)]])])
            ends = np.cumsum(length)
            hit = shared + seen[ends] - seen[ends - length]
            passed = np.where(length > 0, np.searchsorted(own, t.last[f], side="right"), shared)
            # at most so many common tokens for every set below; a link needs (num + den) * |x & y| >= num * (|x| + |y|)
            bound = hit + np.minimum(nx - passed, t.most[f] - t.end[f])
            good = (num + den) * bound >= num * (nx + t.least[f])
            f, hit = f[good], hit[good]
            leaf = t.children[f] == 0
            ends = f[leaf]
            linked = t.lo[ends][den * hit[leaf] >= num * (nx + t.most[ends] - hit[leaf])]
            for y in linked.tolist():
                if comp[y] != comp[x]:
                    out.append((t.order[x], t.order[y]))
                    comp[comp == comp[y]] = comp[x]
                    mine = np.concatenate([[0], np.cumsum(comp == comp[x])])
            f, hit = f[~leaf], hit[~leaf]
            shared = np.repeat(hit, t.children[f])
            f = _spread(t.child[f], t.children[f])
        member[own] = 0
    return out


def _place(s: np.ndarray, bits: int) -> np.ndarray:
    return ((s * _ODD[0]) >> np.uint64(64 - bits)).astype(np.int64)


def _tables(seen: DataFrame, table_bits: int) -> list[np.ndarray]:
    """Bit tables of n-grams (token, n) by how often they are repeated; where one would fill up, its least count rises.

    They are made in slices, one job for all: the driver gets the slices, never the n-grams.
    """
    sizes = seen.groupBy(F.least("n", F.lit(1000)).alias("n")).agg(F.count("*").alias("tokens")).orderBy(F.desc("n")).toArrow().to_pandas()
    all_bits = [table_bits, table_bits - 2, table_bits - 4, table_bits - 6]
    totals = list(zip(sizes["n"][::-1].tolist(), sizes["tokens"].cumsum()[::-1].tolist()))
    least = [next((n for n, total in totals if n >= count and total <= (1 << bits) // 8), 1 << 62) for count, bits in zip((2, 8, 64, 512), all_bits)]

    def places(batches):
        for pdf in batches:
            s, n = pdf["token"].to_numpy(np.int64).view(np.uint64), pdf["n"].to_numpy()
            for k, (bits, low) in enumerate(zip(all_bits, least)):
                p = _place(s[n >= low], bits)
                yield pd.DataFrame({"level": np.full(len(p), k), "slice": p >> max(bits - 7, 3), "p": p & ((1 << max(bits - 7, 3)) - 1)})

    def mark(pdf: pd.DataFrame) -> pd.DataFrame:
        k = int(pdf["level"].iloc[0])
        on = np.zeros(1 << max(all_bits[k] - 7, 3), np.uint8)
        on[pdf["p"].to_numpy()] = 1
        return pd.DataFrame({"level": [k], "slice": [pdf["slice"].iloc[0]], "table": [np.packbits(on, bitorder="little").tobytes()]})

    out = [np.zeros(1 << (bits - 3), np.uint8) for bits in all_bits]
    marks = seen.select("token", "n").mapInPandas(places, "level long, slice long, p long").groupBy("level", "slice").applyInPandas(mark, "level long, slice long, table binary")
    for r in marks.collect():  # at most 2 ** table_bits bits and a third more
        own = np.frombuffer(r["table"], np.uint8)
        out[r["level"]][r["slice"] * len(own) : (r["slice"] + 1) * len(own)] = own
    return out


def _levels(s: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    """How many of the tables, each of more often repeated n-grams than the one before, have each hash."""
    level = np.zeros(len(s), np.int8)
    for t in tables:
        at = _place(s, (8 * len(t)).bit_length() - 1)
        level += ((t[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(np.int8)
    return level


def _by_order(s: np.ndarray, tables: list[np.ndarray]) -> tuple[np.ndarray, int]:
    """Ascending hashes in the global order, rare ones first, and how many are in no table."""
    level = _levels(s, tables)
    return s[np.argsort(level, kind="stable")], int((level == 0).sum())


def _passes(rows: DataFrame, n: int, num: int, den: int, what: str, common=None) -> DataFrame:
    """One pass over texts (rid, t). what: digests (with the lowest hashes of each set), the rest of the hashes, prefixes or
    whole sets."""

    def run(batches):
        import hashlib

        from .pieces import text_chunks, tidy

        for pdf in batches:
            texts, rid = pdf["t"].tolist(), pdf["rid"].to_numpy()
            for lo, hi in text_chunks(texts, 1_500_000):
                sets, own = shingle_sets(texts[lo:hi], n), rid[lo:hi]
                if what == "digests":
                    low = [s[: 2 * prefix_length(len(s), num, den)].tobytes() for s in sets]
                    yield pd.DataFrame({"doc_id": own, "n_shingles": [len(s) for s in sets], "digest": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], "low": low})
                elif what == "rest":
                    yield _tokens(own, [s[2 * prefix_length(len(s), num, den) :] for s in sets])
                elif what == "prefixes":
                    parts = [_by_order(s, common.value)[0][: prefix_length(len(s), num, den)] for s in sets]
                    yield _tokens(own, parts)
                else:
                    yield pd.DataFrame({"rid": own, "tokens": [s.tobytes() for s in sets]})
        _WORDS.clear()  # the worker lives on
        tidy()

    schema = {"digests": "doc_id long, n_shingles long, digest binary, low binary", "rest": "rid long, token long", "prefixes": "rid long, token long", "sets": "rid long, tokens binary"}[what]
    return rows.select("rid", "t").mapInPandas(run, schema)


def _tokens(rid, parts: list[np.ndarray]) -> pd.DataFrame:
    return pd.DataFrame({"rid": np.repeat(np.asarray(rid, np.int64), [len(p) for p in parts]), "token": np.concatenate([*parts, np.zeros(0, np.uint64)]).view(np.int64)})


def _low_prefixes(reps: DataFrame, num: int, den: int, common=None) -> DataFrame:
    """Without ``common``, the lowest hashes of each set; with it, prefixes from them in the final order where they
    suffice, and for the other sets a row with no token."""

    def run(batches):
        for pdf in batches:
            for i in range(0, len(pdf), 500):
                part = pdf.iloc[i : i + 500]
                rid, parts, lacking = part["rid"].to_numpy(), [], []
                for r, size, low in zip(rid, part["n_shingles"].tolist(), part["low"]):
                    p, s = prefix_length(size, num, den), np.frombuffer(low, np.uint64)
                    if common is not None:
                        whole = len(s) == size
                        s, rare = _by_order(s, common.value)
                        if rare < p and not whole:
                            lacking.append(r)
                            s = s[:0]
                        s = s[:p]
                    parts.append(s)
                out = _tokens(rid, parts)
                out["token"] = out["token"].astype("Int64")
                yield pd.concat([out, pd.DataFrame({"rid": lacking, "token": pd.array([None] * len(lacking), "Int64")})]) if lacking else out

    return reps.select("rid", "n_shingles", "low").mapInPandas(run, "rid long, token long")


def _candidates(prefixes: DataFrame, size: DataFrame, num: int, den: int, few: int = 8) -> DataFrame:
    """Edges (a, b) that connect all sets that may link, from prefixes (rid, token) and sizes (rid, size, one: of one text or of equally large ones).

    Of an n-gram in ``few`` prefixes at most each pair is looked at, and how many n-grams their prefixes share: two linking sets have o common
    n-grams at least, so the prefix of p n-grams that ends first in the global order shares all but |s| - o of them with the other prefix.
    Chance n-grams, of which a larger corpus has more, then connect nothing. An n-gram in more prefixes connects those that have it in the
    order of their sizes, where one is not too small for the next.
    """
    heads = prefixes.groupBy("token").agg(F.min("rid").alias("head"), F.count("*").alias("n")).where("n > 1")
    shared = staged(prefixes.join(heads, "token").select("token", "rid", "head", "n"), "shared")
    held = F.sort_array(F.collect_set("rid"))
    pairs = F.flatten(F.transform(held, lambda x: F.transform(F.filter(held, lambda y: y > x), lambda y: F.struct(x.alias("a"), y.alias("b")))))
    pairs = shared.where(F.col("n") <= few).groupBy("token").agg(pairs.alias("p")).select(F.explode("p").alias("p")).groupBy("p.a", "p.b").agg(F.count("*").alias("n"))
    pairs = pairs.join(size.select(F.col("rid").alias("a"), F.col("size").alias("s"), F.col("one").alias("s_one")), "a").join(size.select(F.col("rid").alias("b"), F.col("size").alias("t"), F.col("one").alias("t_one")), "b")
    up = lambda x, y: F.floor((x + y - 1) / y).cast("long")
    prefix = lambda x: x - up(F.lit(num) * x, F.lit(den)) + 1
    s, t = F.col("s"), F.col("t")
    common = up(F.lit(num) * (s + t), F.lit(num + den))
    least = F.greatest(F.lit(1), F.least(prefix(s) - (s - common), prefix(t) - (t - common)))
    maybe = (F.least(s, t) * den >= F.greatest(s, t) * num) & (F.col("n") >= least)
    near = pairs.where(maybe | ~F.col("s_one") | ~F.col("t_one")).select("a", "b")
    many = shared.where(F.col("n") > few).join(size, "rid")
    by_size = Window.partitionBy("token").orderBy("size", "rid")
    many = many.withColumns({"before": F.lag("rid").over(by_size), "less": F.lag("size").over(by_size), "plain": F.min("one").over(Window.partitionBy("token"))})
    chain = many.where(F.col("plain") & (F.col("less") * den >= F.col("size") * num)).select(F.col("before").alias("a"), F.col("rid").alias("b"))
    star = many.where(~F.col("plain")).select(F.col("rid").alias("a"), F.col("head").alias("b"))
    return near.unionByName(chain).unionByName(star).where("a <> b").distinct()


def ngram_classes(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text", chunk_tokens: int = 250_000, table_bits: int = 27, small: int = 1_000_000) -> DataFrame:
    """(doc_id, n_shingles, component_id): smallest doc_id reachable by links, itself included; exact.

    No words: n_shingles 0 and a component of its own (null text counts as empty). Null ids: a component of their own
    with a null id. Repeated ids: rows of one document; they stay, and their texts' classes are one component.
    ``table_bits`` is the size of the largest bit table of repeated n-grams that every task gets (16 MB, 22 with the
    smaller ones); they only order n-grams and may mark others too, so links never depend on them. ``small`` bounds the id lists that are broadcast to pick documents.
    """
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    texts = docs.select(id_in(id_col).alias("rid"), F.col(text_col).cast("string").alias("t"))
    digests = staged(_passes(texts, n, num, den, "digests"), "digests")
    real = digests.where(F.col("digest").isNotNull() & (F.col("doc_id") != NULL_ID))
    classes = real.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("rows")).where("rows > 1")
    copies = staged(real.select("doc_id", "digest").join(classes, "digest").where("doc_id <> rep").select("doc_id", "digest", "rep"), "copies")

    reps = pick(real, copies.select("doc_id", "digest"), ["doc_id", "digest"], "left_anti", small).select(F.col("doc_id").alias("rid"), "n_shingles", "low")
    repeats = lambda rows, name: staged(rows.groupBy("token").agg(F.count("*").alias("n")).where("n > 1"), name)
    tables = _tables(repeats(_low_prefixes(reps, num, den), "repeated"), table_bits)
    # sets whose lowest hashes are mostly repeated reach for higher ones, so among these sets the higher ones count too
    first = spark.sparkContext.broadcast(tables)
    short = staged(_low_prefixes(reps, num, den, first).where("token is null").select("rid").distinct(), "short")
    first.unpersist()
    more = repeats(_passes(pick(texts, short, ["rid"], "left_semi", small), n, num, den, "rest"), "repeated-more")
    tables = [a | b for a, b in zip(tables, _tables(more, table_bits), strict=True)]
    common = spark.sparkContext.broadcast(tables)
    partly = staged(_low_prefixes(reps, num, den, common), "prefixes")
    rest = pick(texts, partly.where("token is null").select("rid"), ["rid"], "left_semi", small)
    prefixes = partly.where("token is not null").unionByName(staged(_passes(rest, n, num, den, "prefixes", common), "more-prefixes"))
    common.unpersist()  # both uses are written
    size = real.groupBy(F.col("doc_id").alias("rid")).agg(F.max("n_shingles").alias("size"), (F.min("n_shingles") == F.max("n_shingles")).alias("one"))
    stars = _candidates(prefixes, size, num, den)
    blocks = staged(components(stars, "blocks").select(F.col("node").alias("rid"), F.col("component").alias("block")), "members")

    weights = blocks.join(size, "rid").groupBy("block").agg(F.sum("size").alias("weight"))
    chunks = F.greatest(F.lit(1), F.ceil(F.col("weight") / chunk_tokens)).cast("int")
    placed = staged(blocks.join(weights, "block").select("rid", "block", "weight", chunks.alias("chunks"), F.pmod(F.xxhash64("rid"), chunks).cast("int").alias("c")), "placed")
    # a chunk meets itself and every other of its block
    meets = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda k: F.struct(F.least("c", k).alias("i"), F.greatest("c", k).alias("j")))
    sets = _passes(pick(texts, blocks.select("rid"), ["rid"], "left_semi", small), n, num, den, "sets")
    tasks = sets.join(placed, "rid").select("rid", "tokens", "block", "chunks", F.explode(meets).alias("m")).select("rid", "tokens", "block", "chunks", "m.i", "m.j")
    # blocks of one chunk share tasks, so that a task has about chunk_tokens n-grams either way
    light = placed.where("chunks = 1").select("block", "weight").distinct().agg(F.sum("weight")).first()[0] or 0
    buckets = max(1, int(light) // chunk_tokens)
    task = F.when(F.col("chunks") == 1, F.struct(F.lit(None).cast("long").alias("block"), F.pmod(F.xxhash64("block"), F.lit(buckets)).cast("int").alias("i"), F.lit(0).alias("j"))).otherwise(F.struct("block", "i", "j"))

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        from .pieces import tidy

        a, b = [], []
        for _, own in pdf.groupby("block", sort=False):
            rid = own["rid"].to_numpy()
            got = trie_links([np.frombuffer(x, np.uint64) for x in own["tokens"]], num, den)
            a += [rid[i] for i, _ in got]
            b += [rid[j] for _, j in got]
        tidy()
        return pd.DataFrame({"a": a, "b": b}, dtype="int64")

    links = tasks.select(task.alias("task"), "rid", "tokens", "block").groupBy("task").applyInPandas(link, "a long, b long")
    found = components(links.unionByName(copies.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))), "links")
    out = digests.select("doc_id", "n_shingles").join(found, F.col("doc_id") == F.col("node"), "left")
    return out.select(F.nullif("doc_id", F.lit(NULL_ID)).alias("doc_id"), "n_shingles", F.nullif(F.coalesce("component", "doc_id"), F.lit(NULL_ID)).alias("component_id"))
