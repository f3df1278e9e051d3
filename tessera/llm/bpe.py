"""BPE encoding and decoding with word ends by batched numpy merge rounds."""

from __future__ import annotations

import hashlib
import json
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pieces
from .common import id_in, id_out, small_batches


class WordBpe:
    """Encoder and decoder of a vocabulary file with an end-of-word suffix, byte-level characters and lower case."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.base = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self.base + vocab[b] for a, b in merges], np.int64)
        ids = np.array([vocab[a + b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        order = order[np.concatenate([[True], np.diff(keys[order]) > 0])]
        self.keys, self.ranks, self.merged = keys[order], order.astype(np.int64), ids[order]
        chars = pieces.byte_chars()
        self.inner = np.array([vocab[c] for c in chars], np.int64)
        self.final = np.array([vocab[c + suffix] for c in chars], np.int64)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {k: t for t, k in vocab.items()} | {k: t for t, k in self.added.items()}
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(split)
        self.marks = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))))

    def pre_tokens(self, piece: str) -> list:
        """Words as UTF-8 bytes, and ids of added tokens as they stand."""
        if piece.isascii() and piece.isalpha():
            return [piece.lower().encode()]
        out: list = []
        at = 0
        for m in [*self.marks.finditer(piece), None]:
            plain = piece[at : m.start() if m else len(piece)]
            low = "".join(c.lower() for c in unicodedata.normalize("NFC", plain)) if not plain.isascii() else plain.lower()
            out += [w.encode("utf-8") for w in self.words.findall(low)]
            if m:
                out.append(self.added[m[0]])
                at = m.end()
        return out

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another and the number of ids of each: in each round every word's lowest-ranked pair."""
        lens = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(lens)
        sym = self.inner[data]
        sym[ends - 1] = self.final[data[ends - 1]]
        word = np.repeat(np.arange(len(words)), lens)
        done_sym, done_word = [], []
        rank_none = np.int64(1 << 40)
        while len(sym):
            pair = word[1:] == word[:-1]
            key = sym[:-1] * self.base + sym[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where(pair & (self.keys[at] == key), self.ranks[at], rank_none)
            # words whose least rank is none are finished and leave the array
            first = np.flatnonzero(np.concatenate([[True], ~pair]))
            least = np.minimum.reduceat(np.append(rank, rank_none), first)
            size = np.diff(np.append(first, len(sym)))
            # a word's last symbol carries the pair to the next word, which is none
            open_word = least < rank_none
            each = np.repeat(least, size)
            hit = np.append((rank == each[:-1]) & (rank < rank_none), False)
            run = hit.copy()
            if (hit[1:] & hit[:-1]).any():  # x x x: the pairs that start at even places of a run
                start = hit & ~np.concatenate([[False], hit[:-1]])
                where = np.flatnonzero(hit)
                begin = np.maximum.accumulate(np.where(start, np.arange(len(hit)), 0))[where]
                run[where[(where - begin) % 2 == 1]] = False
            left = np.flatnonzero(run)
            sym[left] = self.merged[at[left]]
            keep = np.ones(len(sym), bool)
            keep[left + 1] = False
            going = np.repeat(open_word, size)
            out = ~going
            if out.any():
                done_sym.append(sym[out])
                done_word.append(word[out])
            keep &= going
            sym, word = sym[keep], word[keep]
        if not done_sym:
            return np.zeros(0, np.int64), lens * 0
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return sym[order], np.bincount(word, minlength=len(words))

    def encode_pieces(self, parts: list[str]) -> list:
        """Ids of each piece; a piece is text between white space."""
        tokens = [self.pre_tokens(p) for p in parts]
        words = list({w for t in tokens for w in t if isinstance(w, bytes)})
        ids, n = self.merge(words) if words else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        cut = np.concatenate([[0], np.cumsum(n)]).tolist()
        ids = ids.tolist()
        known = {w: ids[a:b] for w, a, b in zip(words, cut, cut[1:])}
        return [known[t[0]] if len(t) == 1 and isinstance(t[0], bytes) else [x for w in t for x in (known[w] if isinstance(w, bytes) else [w])] for t in tokens]

    def decode_table(self) -> list[bytes]:
        return [self.names.get(k, "").encode("utf-8") for k in range(max(self.names) + 1)]

    def encode(self, text: str) -> list[int]:
        """One text; the library's ids with add_special_tokens=False, no truncation and no padding."""
        return [x for ids in self.encode_pieces(pieces.space_cuts([text])[0].as_py()) for x in ids]

    def decode(self, ids) -> str:
        """As the library decodes with special tokens where the file names no decoder: the entries joined by blanks."""
        return " ".join(self.names[k] for k in ids if k in self.names)


def _store(path: str) -> tuple[WordBpe, pieces.PieceStore, list[bytes]]:
    if ("merge rounds", path) not in pieces._STORES:
        bpe = WordBpe(path)
        pieces._STORES["merge rounds", path] = (bpe, pieces.PieceStore(bpe.encode_pieces), bpe.decode_table())
    return pieces._STORES["merge rounds", path]


def encode_decode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", full: bool = False) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256 and with ``full`` also ids and decoded.

    Null text: empty, no ids. Null or repeated doc_ids stay. Whole texts; a long one is one row's work.
    """
    small_batches(docs.sparkSession)

    def run(batches):
        _, store, names = _store(tokenizer)
        for pdf in batches:
            texts = pdf["t"].tolist()
            for lo, hi in pieces.text_chunks(texts):
                ids, lens = store.ids_of(pieces.space_cuts(texts[lo:hi]))
                cut = [0, *np.cumsum(lens).tolist()]
                raw, strings = ids.astype("<u4").tobytes(), list(map(names.__getitem__, ids.tolist()))
                decoded = [b" ".join(strings[a:b]) for a, b in zip(cut, cut[1:])]
                own = [raw[4 * a : 4 * b] for a, b in zip(cut, cut[1:])]
                out = {"doc_id": pdf["d"].iloc[lo:hi].values, "n_tokens": lens, "ids_sha256": [hashlib.sha256(x).hexdigest() for x in own], "decoded_sha256": [hashlib.sha256(x).hexdigest() for x in decoded]}
                yield pd.DataFrame(out | ({"ids": own, "decoded": [x.decode("utf-8") for x in decoded]} if full else {}))

    rows = docs.select(id_in(id_col).alias("d"), F.col(text_col).cast("string").alias("t"))
    return rows.mapInPandas(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary, decoded string" * full).withColumn("doc_id", id_out("doc_id"))
