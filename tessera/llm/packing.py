"""Packing token streams into fixed windows by order-preserving dynamic programming."""

from __future__ import annotations

from bisect import bisect_left
from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pieces
from .common import id_in, id_out, small_batches


#: What a sequence costs in padding ids: of equal cuts the ones with fewer sequences win. Equal paths then soon meet in one place.
A_SEQUENCE = 2.0**-20


class Cutter:
    """The cheapest cuts of a stream whose places come a part at a time, as if all had come at once.

    cost[j] = penalty[j] + min over i with places[j] - places[i] <= window of cost[i] + padding of that window.
    Padding is window - length, or 0 for a length that is a power of two, and ``A_SEQUENCE``; the later i wins ties. The first form is least where
    cost[i] + places[i] is, which a monotone queue holds for a sliding range of i; the powers are looked up.

    Only the places of the last window can still be cut before; where the back pointers of all of them agree, cuts are settled, and what
    stands before is dropped. So neither cuts nor memory depend on the sizes of the parts. Paths mostly meet within a few windows; over texts
    of a few ids each, whose ends are free places everywhere, they may meet late: some 100 bytes a place are kept until then.
    """

    def __init__(self, window: int, start: int = 0):
        self.window = window
        self.powers = [1 << k for k in reversed(range(window.bit_length())) if 1 << k < window and 1 << k >= window // 8]
        self.at, self.cost, self.back = [start], [0.0], [0]
        self.queue: deque = deque([(start, 0)])  # (cost + place, index), ascending in both

    def add(self, places: list[int], penalties: list[float]) -> None:
        """Further places, ascending, with gaps of at most the window."""
        at, cost, back, queue, window, powers = self.at, self.cost, self.back, self.queue, self.window, self.powers
        j, first = len(at), bisect_left(at, at[-1] + 1 - window)
        at += places
        where = {p: k for k, p in enumerate(at[first:], first)}
        for p, pen in zip(places, penalties):
            low = p - window
            while at[queue[0][1]] < low:
                queue.popleft()
            best, i = queue[0]
            best += window - p
            for q in powers:
                k = where.get(p - q)
                if k is not None and cost[k] <= best:
                    best, i = cost[k], k
            best += pen + A_SEQUENCE
            cost.append(best)
            back.append(i)
            key = best + p
            while queue and queue[-1][0] >= key:
                queue.pop()
            queue.append((key, j))
            j += 1

    def _drop(self, k: int) -> None:
        self.at, self.cost, self.back = self.at[k:], self.cost[k:], [max(0, x - k) for x in self.back[k:]]
        self.queue = deque((key, x - k) for key, x in self.queue if x >= k)

    def settled(self, last: bool = False) -> list[int]:
        """Cuts after the last settled one that no further place can change; with ``last`` all, the last place among them."""
        top = len(self.at) - 1
        if last:
            end = top
        else:
            first = bisect_left(self.at, self.at[top] + 1 - self.window)
            while self.queue and self.queue[0][1] < first:
                self.queue.popleft()
            open_ = bytearray(len(self.at))  # places that lie on a path from one which can be cut before
            open_[first:] = b"\1" * (top + 1 - first)
            n, end = top + 1 - first, top
            while n > 1:
                if open_[end]:
                    k = self.back[end]
                    n -= open_[k]
                    open_[k] = 1
                end -= 1
            while not open_[end]:
                end -= 1
        out, k = [], end
        while k:
            out.append(self.at[k])
            k = self.back[k]
        self._drop(end)
        return out[::-1]


def best_cuts(places: np.ndarray, penalties: np.ndarray, window: int) -> np.ndarray:
    """Indices of the cheapest cuts among ascending ``places`` (first and last always chosen; gaps at most ``window``)."""
    c = Cutter(window, int(places[0]))
    c.add(places[1:].tolist(), penalties[1:].tolist())
    return np.searchsorted(places, [int(places[0]), *c.settled(last=True)])


def cut_places(ids: np.ndarray, ends: np.ndarray, sentence_end: np.ndarray, window: int, sentence_cost: float, inner_cost: float) -> tuple[np.ndarray, np.ndarray]:
    """Where a stream may be cut: at document ends for nothing, at sentence ends and, in runs over a window, inside for a penalty."""
    cost = np.full(len(ids) + 1, np.inf)
    cost[1:][sentence_end[ids]] = sentence_cost
    cost[0] = cost[len(ids)] = 0
    cost[ends] = 0
    at = np.flatnonzero(np.isfinite(cost))
    long = np.flatnonzero(np.diff(at) > window // 16)
    for k in long:  # sentences so long that whole ones would leave gaps: every 16th id is a place too
        cost[at[k] + 16 : at[k + 1] : 16] = inner_cost
    at = np.flatnonzero(np.isfinite(cost))
    return at, cost[at]


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, window: int = 2048, sentence_cost: float = 2.0, inner_cost: float = 8.0, order_by: str | None = None, id_col: str = "doc_id", text_col: str = "text", chunk_chars: int = 3_000_000, cache_pieces: int = 450_000) -> DataFrame:
    """One row per piece of a document in a sequence of at most ``window`` ids, documents in input order.

    Each input partition is one stream (give order_by for a global order at the price of a shuffle), so nothing is
    shuffled and a lost task is redone alone. One program runs over the whole stream: a piece is put out once no later text can change its
    cuts. Texts are encoded ``chunk_chars`` at a time with the ids of at most ``cache_pieces`` pieces kept: less
    of both takes less memory and more time and gives the same cuts. Null text: the end id alone. Null doc_ids and repeated rows are documents like others.
    sequence_id is partition << 32 | number; the columns are doc_id, start, length, ids, doc_tokens, sequence_id, offset.
    """
    small_batches(docs.sparkSession)
    if order_by:
        docs = docs.repartitionByRange(order_by).sortWithinPartitions(order_by)

    def run(batches):
        from pyspark import TaskContext

        store = pieces.library_store(tokenizer)
        store.max_pieces = cache_pieces
        ends_sentence = _sentence_ends(tokenizer)
        sequence = TaskContext.get().partitionId() << 32
        cutter = Cutter(window)
        # the stream not yet cut, from ``base`` on: its ids, and for each document in it (id, ids before this part, ids here, all its ids)
        base, ids, parts = 0, np.zeros(0, np.uint32), []

        def put_out(last: bool):
            nonlocal base, ids, parts, sequence
            cuts = np.array([base, *cutter.settled(last)]) - base
            if len(cuts) == 1:
                return None
            sizes = np.array([p[2] for p in parts])
            ends = np.cumsum(sizes)
            bounds = np.union1d(cuts, ends[ends <= cuts[-1]])
            lo, hi = bounds[:-1], bounds[1:]
            doc = np.searchsorted(ends, lo, side="right")
            begins = ends - sizes
            seq = np.searchsorted(cuts, lo, side="right") - 1
            before = np.array([p[1] for p in parts])
            raw = ids.astype("<u4").tobytes()
            out = pd.DataFrame(
                {
                    "doc_id": [parts[k][0] for k in doc], "start": before[doc] + lo - begins[doc], "length": hi - lo, "ids": [raw[4 * a : 4 * b] for a, b in zip(lo.tolist(), hi.tolist())],
                    "doc_tokens": np.array([p[3] for p in parts])[doc], "sequence_id": sequence + seq, "offset": lo - cuts[seq],
                }
            )
            sequence += len(cuts) - 1
            done = int(cuts[-1])
            first = int(np.searchsorted(ends, done, side="right"))
            if first < len(parts):
                used = max(0, int(done - begins[first]))
                d, b, n, total = parts[first]
                parts = [(d, b + used, n - used, total), *parts[first + 1 :]]
            else:
                parts = []
            base, ids = base + done, ids[done:]
            return out

        for pdf in batches:
            texts, names = pdf["t"].tolist(), pdf["d"].tolist()
            for lo, hi in pieces.text_chunks(texts, chunk_chars):
                new, lens = store.ids_of(pieces.blank_cuts(texts[lo:hi]))
                ends = np.cumsum(lens)
                new = np.insert(new, ends, end_id)
                # a chunk begins and ends with documents, so its places are those of the whole stream
                at, pen = cut_places(new, ends + np.arange(1, len(ends) + 1), ends_sentence, window, sentence_cost, inner_cost)
                cutter.add((at[1:] + base + len(ids)).tolist(), pen[1:].tolist())
                ids = np.concatenate([ids, new])
                parts += [(d, 0, n + 1, n + 1) for d, n in zip(names[lo:hi], lens.tolist())]
                if (out := put_out(False)) is not None:
                    yield out
        if parts and (out := put_out(True)) is not None:
            yield out

    rows = docs.select(id_in(id_col).alias("d"), F.col(text_col).cast("string").alias("t")).mapInPandas(run, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
    return rows.withColumn("doc_id", id_out("doc_id"))


_ENDS: dict[str, np.ndarray] = {}


def _sentence_ends(tokenizer: str) -> np.ndarray:
    """For each id, whether its string closes a sentence or a line."""
    if tokenizer not in _ENDS:
        vocabulary = pieces.library_store(tokenizer).vocabulary()
        line = pieces.byte_chars()[10]
        out = np.zeros(max(vocabulary.values()) + 2, bool)
        for t, k in vocabulary.items():
            out[k] = t[-1:] in (".", "!", "?", line) or line in t
        _ENDS[tokenizer] = out
        pieces.tidy()
    return _ENDS[tokenizer]
