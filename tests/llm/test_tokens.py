import zlib

import numpy as np
import pytest

from tessera.llm import bpe, huffman, packing
from tessera.llm.queries import vocabulary_file

tokenizers = pytest.importorskip("tokenizers")
WORD, BYTE = vocabulary_file("word_bpe_49k.json"), vocabulary_file("byte_bpe_50k.json")


def sample():
    import pyarrow.parquet as pq

    t = pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pydict()
    return t["doc_id"], t["text"]


def test_numpy_rounds_equal_library():
    tok, own = tokenizers.Tokenizer.from_file(WORD), bpe.WordBpe(WORD)
    from conftest import AWKWARD

    for t in [*filter(None, AWKWARD), *sample()[1]]:
        ids = tok.encode(t, add_special_tokens=False).ids
        assert own.encode(t) == ids, t[:60]
        assert own.decode(ids) == tok.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("name,cut", [(WORD, "space_cuts"), (BYTE, "blank_cuts")])
def test_pieces_equal_library(name, cut):
    from conftest import AWKWARD

    from tessera.llm import pieces

    texts = [*filter(None, AWKWARD), "a \n b", " x", "x ", "a b  c", "end.\n\nNext, one.\n two\n", "a\t\n\nb", "a\r\nb.", "x.\n\n", "Mr., (a), b.). c", "don't. we'll, 5. a5, nul\x00l x.", "<|ENDOFTEXT|> A", "nb\u00a0sp \u00a0x", *sample()[1][:60]]
    ids, lens = pieces.library_store(name).ids_of(getattr(pieces, cut)(texts))
    tok, at = tokenizers.Tokenizer.from_file(name), 0
    for t, n in zip(texts, lens):
        assert ids[at : at + n].tolist() == tok.encode(t, add_special_tokens=False).ids, t[:60]
        at += n


@pytest.mark.parametrize("name,cut", [(WORD, "space_cuts"), (BYTE, "blank_cuts")])
def test_pieces_equal_library_on_odd_texts(name, cut):
    """Random texts of marks, added tokens, odd white space, combining and control characters."""
    from tessera.llm import pieces

    rng = np.random.default_rng(29)
    bits = [" ", "  ", "\n", "\n\n", "\t", "\r\n", "\u00a0", "\u2003", "\u200b", "\u0301", "\x00", "\x85", "\ufeff", ".", ",", "'", "'s", "'LL", "(", ")", "?!", "\u2019t", "<|endoftext|>", "<|startoftext|>", "<|", "_", "12", "3", "\u0663", "\u00bd", "a", "Word", "the", "\u00c4r", "\u0130", "\u03a3\u03b1\u03c2", "\u65e5\u672c", "\U0001f600", "e\u0301"]
    texts = ["".join(bits[i] for i in rng.integers(0, len(bits), rng.integers(1, 25))) for _ in range(3000)]
    ids, lens = pieces.library_store(name).ids_of(getattr(pieces, cut)(texts))
    tok, at = tokenizers.Tokenizer.from_file(name), 0
    for t, n in zip(texts, lens):
        assert ids[at : at + n].tolist() == tok.encode(t, add_special_tokens=False).ids, ascii(t)
        at += n
    assert at == len(ids)


@pytest.fixture(scope="module")
def long(spark):
    """A text of 10 MB between short ones, with its copy."""
    text = " ".join(f"w{k * k % 50_021}" + (".", "")[k % 7 > 0] for k in range(1_650_000))
    assert len(text) > 10_000_000
    rows = [(1, "before it."), (2, text), (3, None), (4, text), (5, "after it.")]
    return text, rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(2, "doc_id")


def test_long_text_in_token_file_and_back(spark, long):
    import hashlib

    text, rows, df = long
    tok = tokenizers.Tokenizer.from_file(WORD)
    own = {t: tok.encode(t or "", add_special_tokens=False).ids for t in {t for _, t in rows}}
    at = 0
    got = {r["doc_id"]: r for r in huffman.with_crc(huffman.token_file(df, WORD)).collect()}
    for d, t in rows:
        ids = np.array(own[t] + [2], "<u4")
        assert (got[d]["start"], got[d]["n_tokens"], got[d]["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    back = {r["doc_id"]: r for r in bpe.encode_decode(df, WORD).collect()}
    for d, t in rows:
        assert back[d]["ids_sha256"] == hashlib.sha256(np.array(own[t], "<u4").tobytes()).hexdigest()
        assert back[d]["decoded_sha256"] == hashlib.sha256(tok.decode(own[t], skip_special_tokens=False).encode()).hexdigest()


def test_long_text_packed(spark, long):
    text, rows, df = long
    tok = tokenizers.Tokenizer.from_file(BYTE)
    own = {t: np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for t in {t for _, t in rows}}
    filled, at = {}, dict.fromkeys([d for d, _ in rows], 0)
    for r in sorted(packing.pack(df, BYTE).collect(), key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled.get(r["sequence_id"], 0) and r["start"] == at[r["doc_id"]]
        filled[r["sequence_id"]] = r["offset"] + r["length"]
        piece = own[dict(rows)[r["doc_id"]]][r["start"] : r["start"] + r["length"]]
        assert r["ids"] == piece.tobytes()
        at[r["doc_id"]] += r["length"]
    assert at == {d: len(own[t]) for d, t in rows} and max(filled.values()) <= 2048


def test_code_is_optimal_and_limited():
    rng = np.random.default_rng(5)
    for n, limit in ((1, 4), (2, 4), (13, 5), (300, 16), (1000, 10)):
        counts = np.concatenate([[0], (1e6 / np.arange(1, n + 1) ** 2).astype(int) + 1, [0]])
        lengths = huffman.code_lengths(counts, limit)
        used = lengths[counts > 0].astype(int)
        assert used.max() <= limit and lengths[0] == lengths[-1] == 0
        assert sum(2.0 ** -used) <= 1
        if limit == 16:
            import heapq

            h, total = list(map(int, counts[counts > 0])), 0
            heapq.heapify(h)
            while len(h) > 1:
                a = heapq.heappop(h) + heapq.heappop(h)
                total += a
                heapq.heappush(h, a)
            assert (counts * lengths).sum() == pytest.approx(total, rel=0.02)
        book = huffman.Codebook(lengths)
        ids = rng.choice(np.flatnonzero(counts), 3001)
        docs, lens, back = huffman.open_block(book, huffman.pack_block(book, np.array([4, -9]), np.array([1, 3000]), ids, 256))
        assert docs.tolist() == [4, -9] and lens.tolist() == [1, 3000] and (back == ids).all()


def test_token_file(spark, awkward):
    rows = huffman.with_crc(huffman.token_file(awkward, WORD)).collect()
    tok = tokenizers.Tokenizer.from_file(WORD)
    assert len(rows) == awkward.count()
    at = 0
    for r in sorted(rows, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    assert sorted(rows, key=lambda r: r["start"])[0]["doc_id"] is None
    want = {}
    for d, t in awkward.select("doc_id", "text").collect():
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        want.setdefault(d, (len(ids), zlib.crc32(ids.tobytes())))
    assert all(want[r["doc_id"]] == (r["n_tokens"], r["ids_crc32"]) for r in rows)
    assert huffman.token_file(awkward.limit(0), WORD).count() == 0


def test_encode_decode(spark, awkward):
    import hashlib

    tok = tokenizers.Tokenizer.from_file(WORD)
    got = {r["doc_id"]: r for r in bpe.encode_decode(awkward, WORD).collect()}
    for d, t in awkward.select("doc_id", "text").collect():
        ids = tok.encode(t or "", add_special_tokens=False).ids
        assert got[d]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[d]["decoded_sha256"] == hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.encode_decode(awkward.limit(0), WORD).count() == 0


def brute(places, pen, window):
    cost = [0.0] + [1e18] * (len(places) - 1)
    for j in range(1, len(places)):
        for i in range(j):
            n = places[j] - places[i]
            if n <= window:
                pad = 0 if n & (n - 1) == 0 and n >= window // 8 else window - n
                cost[j] = min(cost[j], cost[i] + pad + pen[j])
    return cost[-1]


def test_cuts_are_optimal():
    rng = np.random.default_rng(3)
    for _ in range(60):
        places = np.cumsum(np.concatenate([[0], rng.integers(1, 20, 60)]))
        pen = rng.integers(0, 9, 61).astype(float)
        pen[0] = pen[-1] = 0
        chosen = packing.best_cuts(places, pen, 64)
        cost = sum((0 if (n := places[b] - places[a]) & (n - 1) == 0 and n >= 8 else 64 - n) + pen[b] for a, b in zip(chosen, chosen[1:]))
        assert cost == brute(places.tolist(), pen.tolist(), 64)


def test_cuts_do_not_depend_on_parts():
    """Places that come a few at a time give the cuts, and the cost, of all at once; settled ones are dropped."""
    rng = np.random.default_rng(17)
    for trial in range(60):
        n = int(rng.integers(2, 3000))
        gaps = np.full(n, 16) if trial % 6 == 0 else rng.integers(1, int(rng.choice([3, 20, 64])) + 1, n)
        places = np.concatenate([[0], np.cumsum(gaps)])
        pen = rng.choice([0.0, 2.0, 8.0], n + 1) if trial % 4 else np.zeros(n + 1)
        want = places[packing.best_cuts(places, pen, 64)].tolist()
        cutter, got, k, most = packing.Cutter(64), [0], 1, 0
        while k <= n:
            m = int(rng.integers(1, 200 if trial % 2 else 4))
            cutter.add(places[k : k + m].tolist(), pen[k : k + m].tolist())
            got += cutter.settled()
            most, k = max(most, len(cutter.at)), k + m
        got += cutter.settled(last=True)
        assert got == want
        assert most <= 64 * 20


@pytest.mark.parametrize("sizes", [(1, 30), (5000, 700), (3_000_000, 2000)])
def test_packing_equals_one_program(spark, awkward, sizes):
    """Pieces and padding of a stream are those of one program over all its ids, for every size of chunk and batch."""
    docs = awkward.unionByName(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), allowMissingColumns=True).coalesce(1)
    tok, ends = tokenizers.Tokenizer.from_file(BYTE), packing._sentence_ends(BYTE)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(sizes[1]))
    try:
        rows = packing.pack(docs, BYTE, window=256, chunk_chars=sizes[0]).select("doc_id", "start", "length", "sequence_id", "offset").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    each = [tok.encode(r["text"] or "", add_special_tokens=False).ids + [1] for r in docs.select("text").collect()]
    ids, lens = np.concatenate(each), np.cumsum([len(x) for x in each])
    at, pen = packing.cut_places(ids, lens, ends, 256, 2.0, 8.0)
    cuts = at[packing.best_cuts(at, pen, 256)]
    bounds = np.union1d(cuts, lens)
    assert [r["length"] for r in rows] == np.diff(bounds).tolist()
    seq = np.searchsorted(cuts, bounds[:-1], side="right") - 1
    assert [r["sequence_id"] for r in rows] == seq.tolist() and [r["offset"] for r in rows] == (bounds[:-1] - cuts[seq]).tolist()
    # least total cost, found by the plain recursion
    cost, price = {0: 0.0}, dict(zip(at.tolist(), pen.tolist()))
    order = at.tolist()
    lo = 0
    for j, p in enumerate(order[1:], 1):
        while p - order[lo] > 256:
            lo += 1
        cost[p] = price[p] + packing.A_SEQUENCE + min(cost[q] + (0 if (n := p - q) & (n - 1) == 0 and n >= 32 else 256 - n) for q in order[lo:j])
    filled = np.diff(cuts)
    total = sum(0 if n & (n - 1) == 0 and n >= 32 else 256 - n for n in filled.tolist()) + sum(price[c] for c in cuts[1:].tolist()) + len(filled) * packing.A_SEQUENCE
    assert total == cost[order[-1]]


def test_pack(spark, awkward):
    rows = packing.pack(awkward, BYTE, window=256).collect()
    tok = tokenizers.Tokenizer.from_file(BYTE)
    seqs, docs = {}, {}
    for r in rows:
        seqs.setdefault(r["sequence_id"], []).append(r)
        docs.setdefault(r["doc_id"], []).append(r)
        assert r["length"] * 4 == len(r["ids"]) and r["length"] > 0
    for own in seqs.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 256
    for d, t in awkward.dropDuplicates(["doc_id"]).select("doc_id", "text").collect():
        if d == 14:
            continue
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        own = sorted(docs[d], key=lambda r: r["start"])
        assert b"".join(r["ids"] for r in own) == np.array(ids, "<u4").tobytes()
        assert {r["doc_tokens"] for r in own} == {len(ids)}
    assert packing.pack(awkward.limit(0), BYTE).count() == 0


def test_release(spark, awkward):
    from pathlib import Path

    from tessera.llm import common

    df = common.staged(awkward, "rows")
    here = Path(common.own_dir(spark).removeprefix("file://"))
    assert df.count() == awkward.count() and list(here.glob("rows-*"))
    common.release(spark)
    assert not here.exists()
