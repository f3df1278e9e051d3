"""Encoding through the tokenizers library with a bounded cache of pieces between safe cuts."""

from __future__ import annotations

import unicodedata
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space in any reading of it.
_WS = r"[\t\n\v\f\r \x{1c}-\x{1f}\x{85}\p{Z}]"
#: A blank not directly before a visible character, or white space before a line end: such texts are encoded whole.
_LOOSE = rf" ({_WS}|\z)|[\t\v\f\r \x{{1c}}-\x{{1f}}\x{{85}}\p{{Z}}]\n|\x{{0}}"
#: A full stop or comma between a letter and white space, which no pre-token spans.
_STOP = r"([a-z])([.,])([ \n]|\z)"


class PieceStore:
    """Grows one flat array of ids; a piece's ids are a slice of it. Emptied when max_pieces is passed."""

    def __init__(self, encode_new, max_pieces: int = 450_000):
        self.encode_new, self.max_pieces, self.vocabulary = encode_new, max_pieces, dict
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.n_flat = np.zeros(1 << 16, np.uint32), 0
        self.start, self.length = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _put(self, pieces: list[str], ids: list) -> None:
        lens = np.fromiter(map(len, ids), np.int64, len(ids))
        joined = np.fromiter(chain.from_iterable(ids), np.uint32, int(lens.sum()))
        n, total = len(self.index), int(lens.sum())
        while self.n_flat + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + len(ids) > len(self.start):
            self.start, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length))
        self.flat[self.n_flat : self.n_flat + total] = joined
        self.start[n : n + len(ids)] = self.n_flat + np.cumsum(lens) - lens
        self.length[n : n + len(ids)] = lens
        self.n_flat += total
        self.index.update(zip(pieces, range(n, n + len(pieces))))

    def ids_of(self, cut: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents' pieces one after another, and the number of ids of each document."""
        if len(self.index) > self.max_pieces:
            self.clear()
        coded = cut.flatten().dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # far faster than to_pylist for strings
        known = np.fromiter(map(self.index.get, names, repeat(-1)), np.int64, len(names))
        missing = np.flatnonzero(known < 0)
        for i in range(0, len(missing), 20_000):
            part = missing[i : i + 20_000]
            known[part] = len(self.index) + np.arange(len(part))
            new = [names[k] for k in part.tolist()]
            self._put(new, self.encode_new(new))
        at = known[coded.indices.to_numpy()]
        lens = self.length[at]
        ends = np.cumsum(lens)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.arange(total) + np.repeat(self.start[at] - (ends - lens), lens)] if total else np.zeros(0, np.uint32)
        bounds = np.concatenate([[0], ends])[cut.offsets.to_numpy() - cut.offsets[0].as_py()]
        return ids, np.diff(bounds)


def _as_array(texts: list) -> pa.Array:
    return pc.fill_null(pa.array(texts, pa.string()), "")


def blank_cuts(texts: list) -> pa.ListArray:
    """Cut before each blank that stands before a visible character, before line ends, and between a word and its full stop
    or comma: the byte-level pre-tokenizer always cuts there. Texts with other white space stay whole."""
    t = _as_array(texts)
    marked = pc.replace_substring_regex(t, _STOP, "\\1\x00\\2\\3")
    marked = pc.replace_substring(pc.replace_substring_regex(marked, r"(\n+)", "\x00\\1"), " ", "\x00 ")
    loose = pc.match_substring_regex(t, _LOOSE)
    if not pc.any(loose).as_py():
        return pc.split_pattern(marked, "\x00")
    # one pass for both: in whole texts the mark is a character that is not cut at
    whole = loose.to_pylist()
    return pa.array([[x] if w else m.split("\x00") for x, m, w in zip(t.to_pylist(), marked.to_pylist(), whole)], pa.list_(pa.string()))


def space_cuts(texts: list) -> pa.ListArray:
    """Cut at ASCII white space, which the word-end tokenizer drops, and between a word and its full stop or comma; no merge
    or normal form crosses these. Capitals A-Z go first, unless the text may name an added token in capitals."""
    t = _as_array(texts)
    if not pc.any(pc.match_substring(t, "<|")).as_py():
        t = pc.ascii_lower(t)
    return pc.ascii_split_whitespace(pc.replace_substring_regex(t, _STOP, "\\1 \\2\\3"))


def byte_chars() -> list[str]:
    """The visible character that byte-level vocabularies write for each byte: itself if printable, else the next from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return [chr(b) if b in set(shown) else chr(256 + b - sum(x < b for x in shown)) for b in range(256)]


_STORES: dict[tuple[str, str], PieceStore] = {}


def library_store(path: str) -> PieceStore:
    """A store, kept by the Python worker, whose new pieces the tokenizers library encodes."""
    if ("library", path) not in _STORES:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.no_padding()
        tok.no_truncation()

        model, lower, lead = tok.model, tok.normalizer is not None, "\u0120"
        as_chars = {b: c for b, c in enumerate(byte_chars())}

        def encode_new(pieces: list[str]) -> list:
            """A piece of letters alone (with a blank before it) is one pre-token and goes to the library's model straight."""
            out, hard = [], []
            for k, p in enumerate(pieces):
                blank = not lower and p[:1] == " "
                w = p[1:] if blank else p
                if lower:
                    w = w.lower() if w.isalpha() and "\u03a3" not in w and unicodedata.is_normalized("NFC", w) else ""
                if not w.isalpha():
                    hard.append(k)
                    out.append(())
                    continue
                if not w.isascii():
                    w = w.encode("utf-8").decode("latin-1").translate(as_chars)
                out.append([x.id for x in model.tokenize(lead + w if blank else w)])
            if hard:
                for k, e in zip(hard, tok.encode_batch_fast([pieces[k] for k in hard], add_special_tokens=False), strict=True):
                    out[k] = e.ids
            return out

        _STORES["library", path] = PieceStore(encode_new)
        _STORES["library", path].vocabulary = tok.get_vocab
    return _STORES["library", path]


def tidy() -> None:
    """Give memory that Arrow and the C library keep for later back; Python workers live as long as their executor."""
    import ctypes
    import sys

    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def text_chunks(texts: list, most_chars: int = 3_000_000):
    """Slices of the rows with a bounded number of characters each (a longer single text stands alone)."""
    lo = size = 0
    for k, t in enumerate(texts):
        n = len(t or "")
        if k > lo and size + n > most_chars:
            yield lo, k
            lo, size = k, 0
        size += n
    if lo < len(texts):
        yield lo, len(texts)
    tidy()
