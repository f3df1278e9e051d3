"""Alignment against the libraries on whole texts and plain loops over all token pairs."""

import collections
import hashlib
import random

import pytest
import public_tokenizers as P

from tessera.llm import alignment
from tessera.llm.queries import QUERIES

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    return t, SentencePieceProcessor(model_file=B)


def byte_names():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def plain(texts, libraries):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, digest) of each text."""
    tok, sp = libraries
    names, rows = byte_names(), []
    for t in texts:
        none = ([], [], [], "")
        if not t:
            rows.append(none)
            continue
        want = (" " + t).encode()
        a = [(i, bytes(names[c] for c in tok.id_to_token(i))) for i in tok.encode(" " + t, add_special_tokens=False).ids]
        b = [(i, bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("\u2581", " ").encode()) for i in sp.encode(t)]
        if b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            rows.append(none)
            continue
        spans = []
        for side in (a, b):
            at, out = 0, []
            for i, x in side:
                out.append((at, at + len(x), i))
                at += len(x)
            spans.append(out)
        links = [(i, j) for x, y, i in spans[0] for u, v, j in spans[1] if x < v and u < y]
        cuts = sorted({y for _, y, _ in spans[0]} & {y for _, y, _ in spans[1]})
        groups = []
        for lo, hi in zip([0, *cuts], cuts):
            groups.append("|".join(",".join(str(i) for x, y, i in side if lo <= x and y <= hi) for side in spans))
        rows.append((spans[0], spans[1], links, hashlib.sha256(";".join(groups).encode()).hexdigest(), len(groups)))
    count = collections.Counter(p for r in rows for p in set(r[2]))
    most = collections.defaultdict(int)
    for (i, _), n in count.items():
        most[i] = max(most[i], n)
    return [(len(r[0]), len(r[1]), r[4] if len(r) > 4 else 0, len(r[2]), sum(count[p] == most[p[0]] for p in r[2]), sum(count[p] for p in r[2]), r[3]) for r in rows]


def odd_texts(n, seed=2):
    rng = random.Random(seed)
    parts = ["the", "Straße", " ", "  ", "   ", "\n", "\n\n", "\r\n", "\t", ".", ",", "...", "a", "été", "日本", "<|endoftext|>", "<s>", "</s>", "<0x0A>", "don't", "12345", "\u2581", "\x00", "\u00a0", "\u2028", "e\u0301", "🙂", "x.y", "A.", "ZZ,", "ﬁ", "-", "(", "\u200b", "\x1c", "\x85"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 25))) for _ in range(n)]


def test_stores_equal_libraries(libraries):
    tok, sp = libraries
    texts = odd_texts(3000) + ["word " * 2000, "a", " ", "\n", "  x", "x  "]
    texts = [t for t in texts if "\u2581" not in t]  # such texts have no tokens, however they are cut
    both = alignment.aligner(A, B)
    spaced = [" " + t for t in texts]
    for (ids, n), want in ((both.a_store.ids_of(alignment.pieces.blank_cuts(spaced)), [tok.encode(t, add_special_tokens=False).ids for t in spaced]), (both.b_store.ids_of(alignment.piece_cuts(spaced)), sp.encode(texts))):
        at = [0, *n.cumsum().tolist()]
        for t, x, y, w in zip(texts, at, at[1:], want):
            assert ids[x:y].tolist() == w, repr(t)


def test_equals_plain_pairs(spark, libraries, monkeypatch):
    texts = odd_texts(150, 5) + [None, "", "same text here.", "same text here.", "same text here.", "\u2581", "The quick brown fox, and the lazy dog."] * 2
    want = sorted(((k if k != 3 else None, *w) for k, w in enumerate(plain(texts, libraries))), key=repr)
    df = spark.createDataFrame([(k if k != 3 else None, t, "z", "z") for k, t in enumerate(texts)], "doc_id long, text string, n_links string, part string").repartition(3)
    for chars in (alignment.PART_CHARS, 400):  # one part a task, and many
        monkeypatch.setattr(alignment, "PART_CHARS", chars)
        assert sorted(map(tuple, alignment.align(df, A, B).collect()), key=repr) == want
    assert any(w[1] == 0 for w in want) and any(w[5] < w[4] for w in want)


def test_empty_and_long(spark, libraries):
    df = spark.createDataFrame([(1, "ab, cd.\n" * 300_000)], "doc_id long, text string")
    assert alignment.align(df.limit(0), A, B).count() == 0
    r = alignment.align(df, A, B).collect()[0]
    small = alignment.align(spark.createDataFrame([(1, "ab, cd.\n" * 3)], "doc_id long, text string"), A, B).collect()[0]
    per = lambda c: (r[c] - small[c]) / 299_997
    assert per("n_a") == int(per("n_a")) and per("n_groups") == int(per("n_groups")) and r["count_sum"] == r["n_links"] >= r["n_best"] > 0


def test_query_equals_plain(spark, libraries):
    d = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    short = [i for i, t in docs.items() if len(t or "") < 3000]  # loops over all pairs take long; n_links and digests of the others below
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op11_alignment"](spark, d).collect()}
    want = plain([docs[i] for i in short], libraries)
    assert len(got) == len(docs)
    for i, w in zip(short, want):
        assert got[i][:4] == w[:4] and got[i][6] == w[6]
