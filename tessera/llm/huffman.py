"""Token-ID output: canonical length-limited Huffman coding of ids from global counts.

A dataset is a folder of Parquet files, so Spark's committers, any Hadoop file system and lost executors are
handled: ``codebook`` has (id, n_bits); ``blocks`` has one row per independent block (shard, block, first,
n_tokens, payload). Shards follow ascending doc_id. A payload is

    magic "TSH1" | n_docs u32 | n_tokens u32 | step u32 | doc_id i64 * n_docs (null: minimum of i64)
    | doc length u32 * n_docs | bit offset u32 of every step-th id | code bits, most significant first, 4 zero bytes

so any step-th id can be reached without decoding what stands before it. Canonical codes follow from the lengths.
"""

from __future__ import annotations

import struct
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import pieces
from .common import id_in, id_out, NULL_ID, own_dir, small_batches, staged

MAGIC = b"TSH1"


def code_lengths(counts: np.ndarray, limit: int = 16) -> np.ndarray:
    """Lengths of an optimal prefix code of at most ``limit`` bits (package-merge); 0 where the count is 0."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        out[used] = 1
        return out
    limit = max(limit, int(np.ceil(np.log2(len(used)))))
    order = used[np.argsort(counts[used], kind="stable")]
    leaf = counts[order].astype(np.float64)
    levels, packed = [], np.zeros(0)
    for _ in range(limit):
        weight = np.concatenate([leaf, packed])
        by = np.argsort(weight, kind="stable")
        levels.append(by < len(leaf))
        w = weight[by]
        n = len(w) // 2
        packed = w[0 : 2 * n : 2] + w[1 : 2 * n : 2]
    take, lengths = 2 * len(leaf) - 2, np.zeros(len(leaf), np.int64)
    for is_leaf in reversed(levels):  # of the first `take` items, the leaves count one bit each, the packages open up below
        n_leaf = int(is_leaf[:take].sum())
        lengths[:n_leaf] += 1
        take = 2 * (take - n_leaf)
    out[order] = lengths
    return out


class Codebook:
    """Canonical codes: by length, then id. table[next n bits] has the id and its length."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        self.n = max(1, int(self.lengths.max(initial=1)))
        used = np.flatnonzero(self.lengths)
        self.order = used[np.lexsort((used, self.lengths[used]))]
        span = 1 << (self.n - self.lengths[self.order])
        first = np.cumsum(span) - span
        self.code = np.zeros(len(lengths), np.int64)
        self.code[self.order] = first >> (self.n - self.lengths[self.order])
        self.table = np.zeros(1 << self.n, np.uint32)
        full = np.repeat(self.order, span)
        self.table[: len(full)] = full

    def encode(self, ids: np.ndarray, step: int) -> tuple[np.ndarray, bytes]:
        n = self.lengths[ids]
        if len(ids) and n.min() == 0:
            raise ValueError("an id without a code")
        at = np.cumsum(n) - n
        total = int(n.sum())
        words = np.zeros((total >> 5) + 2)
        value = self.code[ids] << (64 - n - (at & 31))  # within 64 bits from the start of its 32-bit word; n + 31 < 64
        value = value.view(np.uint64)
        k = at >> 5
        words += np.bincount(k, (value >> np.uint64(32)).astype(np.float64), len(words))
        words += np.bincount(k + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), len(words))
        return at[::step].astype("<u4"), words.astype(np.uint32).astype(">u4").tobytes()[: (total + 7) // 8] + bytes(4)

    def decode(self, bits: bytes, offsets: np.ndarray, n_tokens: int, step: int) -> np.ndarray:
        """All runs between checkpoints advance together, one table look-up per id."""
        data = np.frombuffer(bits, np.uint8).astype(np.int64)
        runs = len(offsets)
        out = np.zeros((runs, step), np.uint32)
        at, limit = offsets.astype(np.int64), 8 * (len(data) - 4)
        mask, drop = (1 << self.n) - 1, 32 - self.n
        for j in range(min(step, n_tokens)):
            b = np.minimum(at, limit) >> 3
            window = (data[b] << 24) | (data[b + 1] << 16) | (data[b + 2] << 8) | data[b + 3]
            ids = self.table[(window >> (drop - (at & 7))) & mask]
            out[:, j] = ids
            at = at + self.lengths[ids]
        return out.reshape(-1)[:n_tokens] if runs else out.reshape(-1)


def pack_block(book: Codebook, doc_ids: np.ndarray, lens: np.ndarray, ids: np.ndarray, step: int) -> bytes:
    offsets, bits = book.encode(ids, step)
    return MAGIC + struct.pack("<III", len(doc_ids), len(ids), step) + doc_ids.astype("<i8").tobytes() + lens.astype("<u4").tobytes() + offsets.tobytes() + bits


def open_block(book: Codebook, payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if payload[:4] != MAGIC:
        raise ValueError("not a block")
    n_docs, n_tokens, step = struct.unpack_from("<III", payload, 4)
    at = 16
    doc_ids = np.frombuffer(payload, "<i8", n_docs, at)
    lens = np.frombuffer(payload, "<u4", n_docs, at + 8 * n_docs)
    at += 12 * n_docs
    runs = -(-n_tokens // step)
    offsets = np.frombuffer(payload, "<u4", runs, at)
    return doc_ids, lens.astype(np.int64), book.decode(payload[at + 4 * runs :], offsets, n_tokens, step)


def width(vocabulary: int) -> np.dtype:
    """Of ids between the steps: 16 bits where the vocabulary allows it."""
    return np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")


def token_rows(docs: DataFrame, tokenizer: str, end_id: int, cut: str, vocabulary: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids): ids of whole texts by the tokenizers library and end_id, little-endian, of width(vocabulary).

    A null text counts as empty; a null doc_id stays null; repeated rows stay.
    """
    small_batches(docs.sparkSession)

    def run(batches):
        store, cuts, kind = pieces.library_store(tokenizer), getattr(pieces, cut), width(vocabulary)
        for pdf in batches:
            texts = pdf["t"].tolist()
            for lo, hi in pieces.text_chunks(texts):
                ids, lens = store.ids_of(cuts(texts[lo:hi]))
                ends = np.cumsum(lens)
                ids = np.insert(ids, ends, end_id).astype(kind)
                ends += np.arange(1, len(lens) + 1)
                raw, b = ids.tobytes(), [0, *(kind.itemsize * ends).tolist()]
                yield pd.DataFrame({"doc_id": pdf["d"].iloc[lo:hi].values, "n_tokens": lens + 1, "ids": [raw[x:y] for x, y in zip(b, b[1:])]})

    rows = docs.select(id_in(id_col).alias("d"), F.col(text_col).cast("string").alias("t")).mapInPandas(run, "doc_id long, n_tokens long, ids binary")
    return rows.withColumn("doc_id", id_out("doc_id"))


def write_dataset(tokens: DataFrame, vocabulary: int, limit: int = 16, block_tokens: int = 1 << 17, step: int = 128, shard_bytes: int = 32 << 20) -> str:
    """Code rows (doc_id, n_tokens, ids) in ascending doc_id order (nulls first, ties in any order); returns the folder."""
    spark = tokens.sparkSession

    def count(batches):
        total = np.zeros(vocabulary, np.int64)
        for pdf in batches:
            for i in range(0, len(pdf), 512):
                total += np.bincount(np.frombuffer(b"".join(pdf["ids"].iloc[i : i + 512]), width(vocabulary)), minlength=vocabulary)
        used = np.flatnonzero(total)
        yield pd.DataFrame({"id": used, "n": total[used]})

    # at most one row per id of the vocabulary reaches the driver
    counts = tokens.select("ids").mapInPandas(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    n = np.zeros(vocabulary, np.int64)
    n[counts["id"].to_numpy(np.int64)] = counts["n"].to_numpy(np.int64)
    lengths = code_lengths(n, limit)
    folder = f"{own_dir(spark)}/ids-{uuid.uuid4().hex}"
    used = np.flatnonzero(lengths)
    spark.createDataFrame(pd.DataFrame({"id": used, "n_bits": lengths[used].astype(np.int64)}), "id long, n_bits long").coalesce(1).write.parquet(f"{folder}/codebook")

    def shard(batches):
        from pyspark import TaskContext

        book, k, first, kind = Codebook(lengths), TaskContext.get().partitionId(), 0, width(vocabulary)
        docs, lens, raw, size, block = [], [], [], 0, 0

        def close():
            ids = np.frombuffer(b"".join(raw), kind).astype(np.int64)
            return pd.DataFrame({"shard": [k], "block": [block], "first": [first], "n_tokens": [len(ids)], "payload": [pack_block(book, np.array(docs, np.int64), np.array(lens, np.int64), ids, step)]})

        for pdf in batches:
            for d, x in zip(pdf["doc_id"].tolist(), pdf["ids"]):
                docs.append(int(d))
                lens.append(len(x) // kind.itemsize)
                raw.append(x)
                size += lens[-1]
                if size >= block_tokens:
                    yield close()
                    first, block = first + size, block + 1
                    docs, lens, raw, size = [], [], [], 0
        if docs:
            yield close()

    shards = max(1, -(-int(n.sum()) * width(vocabulary).itemsize // shard_bytes))
    ordered = tokens.select(id_in("doc_id").alias("doc_id"), "ids").repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id")
    # Arrow batches by rows: ids of some hundred documents at a time, not of ten thousand
    ordered.mapInPandas(shard, "shard long, block long, first long, n_tokens long, payload binary").write.option("compression", "none").parquet(f"{folder}/blocks")
    return folder


def read_dataset(spark: SparkSession, folder: str, vocabulary: int) -> DataFrame:
    """(doc_id, start, n_tokens, ids) from the files alone; start counts the ids of all documents before."""
    bits = spark.read.parquet(f"{folder}/codebook").toArrow().to_pandas()  # one row per id of the vocabulary at most
    lengths = np.zeros(vocabulary, np.uint8)
    lengths[bits["id"].to_numpy(np.int64)] = bits["n_bits"].to_numpy(np.int64)
    blocks = spark.read.parquet(f"{folder}/blocks")
    totals = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").toArrow().to_pandas()  # one row per output file
    base = dict(zip(totals["shard"].tolist(), (totals["n"].cumsum() - totals["n"]).tolist(), strict=True))

    def run(batches):
        book = Codebook(lengths)
        for pdf in batches:
            for shard, first, payload in zip(pdf["shard"], pdf["first"], pdf["payload"]):
                docs, lens, ids = open_block(book, payload)
                ends = np.cumsum(lens)
                raw, b = ids.astype("<u4").tobytes(), [0, *(4 * ends).tolist()]
                yield pd.DataFrame({"doc_id": docs, "start": base[shard] + first + ends - lens, "n_tokens": lens, "ids": [raw[x:y] for x, y in zip(b, b[1:])]})

    return blocks.select("shard", "first", "payload").mapInPandas(run, "doc_id long, start long, n_tokens long, ids binary").withColumn("doc_id", id_out("doc_id"))


def with_crc(rows: DataFrame) -> DataFrame:
    """ids_crc32: Spark's crc32 of the little-endian bytes, unsigned in a long."""
    return rows.select(*[c for c in rows.columns if c != "ids"], F.crc32("ids").alias("ids_crc32"))


def token_file(docs: DataFrame, tokenizer: str, end_id: int = 2, vocabulary: int = 49408, cut: str = "space_cuts") -> DataFrame:
    """Encode, write the coded files in ascending doc_id order and read them back: (doc_id, start, n_tokens, ids).

    No rows: an empty dataset. Null text: the end id alone. Null doc_id: first, in the order null documents arrive.
    """
    tokens = staged(token_rows(docs, tokenizer, end_id, cut, vocabulary), "ids")
    return read_dataset(docs.sparkSession, write_dataset(tokens, vocabulary), vocabulary)


__all__ = ["Codebook", "code_lengths", "open_block", "pack_block", "read_dataset", "token_file", "token_rows", "with_crc", "write_dataset"]
