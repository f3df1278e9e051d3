"""Cross-tokenizer alignment: whole batches of texts cut where the tokens of both tokenizers end, and links counted over the corpus."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pieces
from .common import id_in, id_out, small_batches, staged
from .lm_scores import _pack, _unpack
from .pieces import PieceStore, text_chunks

#: Characters of a part: within it, each linked id pair is counted and looked up once.
PART_CHARS = 6_000_000
#: Pairs of parts that are summed at once.
GROUP_ROWS = 2_000_000
#: Above all ids of the second vocabulary: a pair of ids is one number.
BASE = 1 << 20
#: Where the piece tokenizer can be cut: no entry of its vocabulary holds these neighbours (checked when it is loaded).
_PIECE_STOP = r"([A-Za-z])([.,])"


def byte_tokens(path: str) -> tuple[list[bytes], PieceStore]:
    """The bytes of each id of a byte-level vocabulary, and a store that encodes pieces; special tokens' strings are plain text."""
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(path)
    plain.no_padding()
    plain.no_truncation()
    plain.encode_special_tokens = True
    back = {c: b for b, c in enumerate(pieces.byte_chars())}
    names = {k: t for t, k in plain.get_vocab(with_added_tokens=True).items()}
    special = {t.content for t in plain.get_added_tokens_decoder().values()}
    raw = [b"" if names.get(k) is None else names[k].encode() if names[k] in special else bytes(map(back.__getitem__, names[k])) for k in range(max(names) + 1)]
    library = pieces.library_store(path).encode_new

    def encode_new(parts: list[str]) -> list:
        odd = [k for k, p in enumerate(parts) if "<|" in p]
        out = list(library(parts))
        if odd:
            for k, e in zip(odd, plain.encode_batch_fast([parts[k] for k in odd], add_special_tokens=False), strict=True):
                out[k] = e.ids
        return out

    return raw, PieceStore(encode_new, 300_000)


def piece_tokens(path: str) -> tuple[list[bytes], PieceStore]:
    """The same for a sentencepiece vocabulary, which puts a blank before each text; pieces are parts of blank + text."""
    import re

    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path)
    names = [sp.id_to_piece(k) for k in range(sp.get_piece_size())]
    raw = [b"" if sp.is_control(k) or sp.is_unknown(k) else bytes([int(n[3:5], 16)]) if sp.is_byte(k) else n.replace("\u2581", " ").encode() for k, n in enumerate(names)]
    spanning = [n for k, n in enumerate(names) if not (sp.is_byte(k) or sp.is_control(k) or sp.is_unknown(k)) and (re.search("[^\u2581]\u2581|\n", n) or re.search(_PIECE_STOP, n))]
    if spanning:
        raise ValueError(f"tokens span the places where texts are cut: {spanning[:5]}")

    def encode_new(parts: list[str]) -> list:
        # after a line end, which no token spans; the library's own blank and the line end are the first two tokens
        return [x[2:] for x in sp.encode(["\n" + p for p in parts], num_threads=1)]

    return raw, PieceStore(encode_new, 300_000)


def piece_cuts(texts: list):
    """Cuts of blank + text before each run of blanks, around line ends and between a word and its full stop or comma, which no
    token of the piece vocabulary spans. Texts with the mark itself stay whole."""
    import pyarrow as pa
    import pyarrow.compute as pc

    t = pa.array(texts, pa.string())
    marked = pc.replace_substring_regex(pc.replace_substring_regex(t, r"([^ \n])( )", "\\1\x00\\2"), _PIECE_STOP, "\\1\x00\\2")
    marked = pc.replace_substring_regex(marked, r"(\n)", "\x00\\1\x00")
    odd = pc.match_substring(t, "\x00")
    if not pc.any(odd).as_py():
        return pc.split_pattern(marked, "\x00")
    return pa.array([[x] if w else m.split("\x00") for x, m, w in zip(texts, marked.to_pylist(), odd.to_pylist())], pa.list_(pa.string()))


def _flat(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lens = np.array([len(t) for t in tokens], np.int64)
    return np.frombuffer(b"".join(tokens) or b"\0", np.uint8), np.cumsum(lens) - lens, lens


def _faithful(ids: np.ndarray, per_text: np.ndarray, table, raw: np.ndarray, raw_lens: np.ndarray) -> np.ndarray:
    """Whether each text's joined token bytes are its own bytes: lengths first, then all bytes of the texts that agree."""
    flat, start, lens = table
    n = lens[ids]
    ends = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(per_text)])]
    good = np.diff(ends) == raw_lens
    mine = np.repeat(good, per_text)
    n, first = n[mine], start[ids[mine]]
    at = np.arange(int(n.sum()), dtype=np.int64) + np.repeat(first - (np.cumsum(n) - n), n)
    own = raw[np.repeat(good, raw_lens)]
    wrong = flat[at] != own
    if wrong.any():
        texts = np.repeat(np.flatnonzero(good), raw_lens[good])
        good[texts[wrong]] = False
    return good


class Aligner:
    """Both tokenizers, the bytes of their tokens, and the strings of ids with each mark that may follow them."""

    def __init__(self, a_path: str, b_path: str):
        import pyarrow as pa

        (a, self.a_store), (b, self.b_store) = byte_tokens(a_path), piece_tokens(b_path)
        self.a_table, self.b_table = _flat(a), _flat(b)
        self.strings = pa.array([f"{k}{mark}".encode() for k in range(max(len(a), len(b))) for mark in (",", "|", ";", "")], pa.binary())

    def align(self, texts: list) -> dict:
        """Of a batch of texts: faithful, n_a, n_b, n_groups and groups_sha256 by text, and links as pair numbers a * BASE + b with their
        number by text. All texts stand in one row of bytes, a text's tokens end where it ends, so one count of ends serves all."""
        spaced = [" " + t if t else "" for t in texts]
        a, n_a = self.a_store.ids_of(pieces.blank_cuts(spaced))
        b, n_b = self.b_store.ids_of(piece_cuts(spaced))
        encoded = [t.encode("utf-8") for t in spaced]
        raw_lens = np.fromiter(map(len, encoded), np.int64, len(encoded))
        raw = np.frombuffer(b"".join(encoded), np.uint8)
        good = _faithful(a, n_a, self.a_table, raw, raw_lens) & _faithful(b, n_b, self.b_table, raw, raw_lens) & (raw_lens > 0)
        a, b = a[np.repeat(good, n_a)].astype(np.int64), b[np.repeat(good, n_b)].astype(np.int64)
        n_a, n_b, size = n_a * good, n_b * good, raw_lens * good
        bounds, total = np.concatenate([[0], np.cumsum(size)]), int(size.sum())
        a_end, b_end = np.cumsum(self.a_table[2][a]), np.cumsum(self.b_table[2][b])
        # how many tokens end at each byte offset: 2 is a cut, 1 or 2 an end of a stretch that one token of either side covers
        ends_a, ends_b = (np.bincount(e, minlength=total + 1) for e in (a_end, b_end))
        both = ends_a + ends_b
        cuts_until = np.cumsum(both == 2)
        n_groups = cuts_until[bounds[1:]] - cuts_until[bounds[:-1]]
        at = np.flatnonzero(both)
        a_of, b_of = np.cumsum(ends_a)[at - 1], np.cumsum(ends_b)[at - 1]  # tokens that ended before: the number of the one that covers
        links = a[a_of] * BASE + b[b_of]
        stretches = np.cumsum(both > 0)
        n_links = stretches[bounds[1:]] - stretches[bounds[:-1]]
        return {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "groups_sha256": self._digests(a, b, a_end, b_end, n_a, n_b, bounds, both, cuts_until), "links": links, "n_links": n_links}

    def _digests(self, a, b, a_end, b_end, n_a, n_b, bounds, both, cuts_until) -> list[str]:
        """Of each text the sha256 of ``a1,a2|b1;a3|b2,b3``: in each group its A ids, then its B ids; '' without tokens."""
        group_a, group_b = cuts_until[a_end - 1], cuts_until[b_end - 1]
        groups = int(cuts_until[-1]) if len(cuts_until) else 0
        a_in, b_in = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
        a_last, b_last = both[a_end] == 2, both[b_end] == 2
        whole = np.zeros(len(both), bool)
        whole[bounds[1:]] = True
        place_a = np.arange(len(a)) + (np.cumsum(b_in) - b_in)[group_a]
        place_b = np.arange(len(b)) + np.cumsum(a_in)[group_b]
        code = np.empty(len(a) + len(b), np.int64)
        code[place_a] = a * 4 + a_last
        code[place_b] = b * 4 + np.where(whole[b_end], 3, np.where(b_last, 2, 0))
        joined = self.strings.take(code)
        offsets = np.frombuffer(joined.buffers()[1], np.int32)[joined.offset : joined.offset + len(code) + 1]
        data, at = memoryview(joined.buffers()[2] or b""), offsets[np.concatenate([[0], np.cumsum(n_a + n_b)])].tolist()
        return [hashlib.sha256(data[x:y]).hexdigest() if y > x else "" for x, y in zip(at, at[1:])]


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """Kept by the Python worker."""
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
    return _ALIGNERS[a_path, b_path]


def _part(k: int, ids: list, found: list[dict]) -> dict:
    """One row: what is known of the part's documents, its distinct pairs, in how many of its documents each is linked, and each
    link as a number among them."""
    links, per = np.concatenate([f["links"] for f in found]), np.concatenate([f["n_links"] for f in found])
    pairs, at = np.unique(links, return_inverse=True)
    doc = np.repeat(np.arange(len(per)), per)
    once = np.sort(doc * (len(pairs) + 1) + at)
    once = once[np.concatenate([[True], once[1:] != once[:-1]])] if len(once) else once
    docs = np.bincount(once % (len(pairs) + 1), minlength=len(pairs))
    return {
        "part": k, "n": len(ids), "n_links": len(links), "pairs": len(pairs), "d": np.array(ids, np.int64).tobytes(), "per": per.astype(np.int64).tobytes(),
        **{c: np.concatenate([f[c] for f in found]).astype(np.int64).tobytes() for c in ("n_a", "n_b", "n_groups")}, "sha": "\n".join(x for f in found for x in f["groups_sha256"]),
        "at": _pack(at, 4), "pair": _pack(pairs, 5), "docs": _pack(docs, 5),
    }


PART = "part long, n long, n_links long, pairs long, d binary, per binary, n_a binary, n_b binary, n_groups binary, sha string, at binary, pair binary, docs binary"


def _parts(texts: DataFrame, a_path: str, b_path: str) -> DataFrame:
    import pyarrow as pa

    kind = pa.schema([(c, {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}[t]) for c, t in (x.split() for x in PART.split(", "))])

    def run(batches):
        from pyspark import TaskContext

        both, k, ids, found, chars = aligner(a_path, b_path), TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            d, t = (c.to_pylist() for c in batch.columns)
            for lo, hi in text_chunks(t, 1_000_000):
                more = sum(len(x or "") for x in t[lo:hi])
                if ids and chars + more > PART_CHARS:
                    yield pa.RecordBatch.from_pylist([_part(k, ids, found)], kind)
                    k, ids, found, chars = k + 1, [], [], 0
                chars += more
                ids += d[lo:hi]
                found.append(both.align([x or "" for x in t[lo:hi]]))
        if ids:
            yield pa.RecordBatch.from_pylist([_part(k, ids, found)], kind)
        pieces.tidy()

    return texts.mapInArrow(run, PART)


def _group_of(pairs: np.ndarray, groups: int) -> np.ndarray:
    mixed = pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.uint64(groups)).astype(np.int64)


def _counted(parts: DataFrame, groups: int) -> DataFrame:
    """For each part and group the corpus's document counts of the part's pairs of the group, in their order, and for each group the
    highest count of each A id in it."""
    import pyarrow as pa

    sent = pa.schema([("group", pa.int64()), ("part", pa.int64()), ("n", pa.int64()), ("pair", pa.binary()), ("docs", pa.binary())])

    def own(batches):
        for batch in batches:
            for row in batch.to_pylist():
                pairs, docs = _unpack(row["pair"], row["pairs"], 5), _unpack(row["docs"], row["pairs"], 5)
                group = _group_of(pairs, groups)
                order = np.argsort(group, kind="stable")
                ends = np.searchsorted(group[order], np.arange(groups + 1))
                out = [{"group": g, "part": row["part"], "n": int(ends[g + 1] - ends[g]), "pair": _pack(pairs[o := order[ends[g] : ends[g + 1]]], 5), "docs": _pack(docs[o], 5)} for g in np.flatnonzero(np.diff(ends)).tolist()]
                yield pa.RecordBatch.from_pylist(out, sent)

    def total(table):
        rows = table.to_pylist()
        sizes = [x["n"] for x in rows]
        pairs = np.concatenate([_unpack(x["pair"], x["n"], 5) for x in rows])
        names, same = np.unique(pairs, return_inverse=True)
        n = np.bincount(same, np.concatenate([_unpack(x["docs"], x["n"], 5) for x in rows])).astype(np.int64)
        a = names // BASE
        first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
        most, ends, rest = np.maximum.reduceat(n, first), np.cumsum([0, *sizes]), [None] * (len(rows) - 1)
        n = n[same]
        return pa.table({"part": [x["part"] for x in rows], "group": [x["group"] for x in rows], "n": sizes, "docs": [_pack(n[x:y], 6) for x, y in zip(ends, ends[1:])], "a": pa.array([a[first].tolist(), *rest], pa.list_(pa.int64())), "most": pa.array([most.tolist(), *rest], pa.list_(pa.int64()))})

    rows = parts.select("part", "pairs", "pair", "docs").mapInArrow(own, "group long, part long, n long, pair binary, docs binary")
    return rows.groupBy("group").applyInArrow(total, "part long, group long, n long, docs binary, a array<long>, most array<long>")


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A blank and the text are encoded without special tokens by a byte-level file (A) and a sentencepiece file (B). Byte offsets where
    tokens of both end cut them into groups; each two tokens of A and B whose bytes overlap are a link. The count of a pair of ids
    is the number of documents of the table that hold it linked. n_best: links whose count is the highest of their A id in the
    table, ties included; count_sum: the sum over links. Null and empty texts, and texts whose joined token bytes of either
    side are not the blank and the text, have no tokens: noughts and ''. Repeated rows are documents each, null ids stay. The
    distinct pairs of a part of a few million characters go by hash to groups that sum them over all parts, and their counts come
    back to the part; only the highest count of each A id, no more than its vocabulary has, goes to every task. A long text is
    one part's work. An empty table gives no rows. Other columns are not read.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(id_in(id_col).alias("d"), F.col(text_col).cast("string").alias("t"))
    parts = staged(_parts(texts, a_path, b_path), "aligned")
    groups = max(64, -(-(parts.agg(F.sum("pairs")).first()[0] or 0) // GROUP_ROWS))
    counts = staged(_counted(parts, groups), "pair-counts")
    each = counts.where("a is not null").select(F.explode(F.arrays_zip("a", "most")).alias("x")).groupBy("x.a").agg(F.max("x.most").alias("most")).toArrow()  # a row an id of A
    best = np.zeros((max(each["a"].to_pylist(), default=0)) + 1, np.int64)
    best[each["a"].to_numpy()] = each["most"].to_numpy()

    def score(own, counts):
        import pyarrow as pa

        row, rows = own.to_pylist()[0], sorted(counts.to_pylist(), key=lambda x: x["group"])
        per = np.frombuffer(row["per"], np.int64)
        pairs = _unpack(row["pair"], row["pairs"], 5)
        n = np.empty(len(pairs), np.int64)
        if rows:
            n[np.argsort(_group_of(pairs, groups), kind="stable")] = np.concatenate([_unpack(x["docs"], x["n"], 6) for x in rows])
        top = n == best[pairs // BASE]
        at, ends = _unpack(row["at"], row["n_links"], 4), np.concatenate([[0], np.cumsum(per)])
        sums = [np.concatenate([[0], np.cumsum(x[at])])[ends] for x in (top, n)]
        column = lambda c: np.frombuffer(row[c], np.int64)
        return pa.table({"doc_id": column("d"), "n_a": column("n_a"), "n_b": column("n_b"), "n_groups": column("n_groups"), "n_links": per, "n_best": np.diff(sums[0]), "count_sum": np.diff(sums[1]), "groups_sha256": row["sha"].split("\n")})

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    own = parts.drop("docs").groupBy("part").cogroup(counts.select("part", "group", "n", "docs").groupBy("part"))
    return own.applyInArrow(score, schema).withColumn("doc_id", id_out("doc_id"))
