import random
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from panelwright.llm.byte_bpe import VOCABULARY, Merges, decode, encode, n_ids, read_ranks
from panelwright.llm.hashing import KeyTable
from panelwright.llm.token_counts import VOCABULARY as PIECES
from panelwright.llm.token_counts import Pieces, token_counts

PATH = public_tokenizers.path(VOCABULARY)
RANKS = read_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
TEXTS = [
    None,
    "",
    " ",
    "Hello there, it's 2024!\n\n  Größe – naïve",
    "日本語のテキスト 🎉👩‍👩‍👧 ﷽",
    "<|endoftext|> is text",
    "a" * 5000,
    " " * 3000 + "x",
    "-=" * 700,
    "word " * 30_000,
    "é" * 400,
    "\x00﻿ ",
]


def test_merges_equal_the_library():
    merges, rng = Merges(RANKS, public_tokenizers.PATTERN), random.Random(1)
    words = ["ab" * 200, "é" * 400, "a", "", "z" * 255, "z" * 256, "z" * 257, "z" * 258]
    for n in [1, 2, 3, 5, 8, 50, 200, 300, 900]:
        for _ in range(10):
            text = "".join(rng.choice('ab ché日本🎉\n"=-_0') for _ in range(n))
            words += regex.findall(public_tokenizers.PATTERN, text)
    words = [w for w in words if w]
    flat, sizes = merges.encode([w.encode() for w in words])
    ends = np.cumsum(sizes)
    for w, a, b in zip(words, ends - sizes, ends):
        assert flat[a:b].tolist() == LIBRARY._core_bpe.encode_single_piece(w.encode()), w[:40]
    assert [len(x) for x in merges.encode([])] == [0, 0]


def test_encode_and_decode(spark, documents):
    docs = documents(TEXTS + TEXTS[:4])
    rows = docs.select("doc_id", "text", encode(spark, docs["text"], PATH).alias("out"))
    rows = rows.select("*", n_ids(rows["out"]).alias("size"), decode(spark, rows["out"], PATH).alias("back"))
    for r in rows.collect():
        want = LIBRARY.encode_ordinary(r["text"] or "")
        assert np.frombuffer(r["out"], "<u4").tolist() == want
        assert r["size"] == len(want)
        assert bytes(r["back"]) == (r["text"] or "").encode()
    empty = documents([])
    assert empty.select(encode(spark, empty["text"], PATH)).collect() == []


def test_query_against_the_library(spark):
    from panelwright.llm import CORPUS

    folder = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in CORPUS["op4_byte_bpe"].run(spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids, r = LIBRARY.encode_ordinary(d["text"] or ""), got[d["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == sha256((d["text"] or "").encode()).hexdigest()


def brute_count(pieces, word):
    best = [(0.0, 0)]
    for j in range(1, len(word) + 1):
        octets = len(word[j - 1].encode())
        options = [(best[j - 1][0] + pieces.fallback * octets, -best[j - 1][1] - octets)]
        for k in range(1, min(j, pieces.longest) + 1):
            if word[j - k : j] in pieces.scores:
                options.append((best[j - k][0] + pieces.scores[word[j - k : j]], -best[j - k][1] - 1))
        score, number = max(options)
        best.append((score, -number))
    return best[-1][1]


@pytest.fixture(scope="module")
def pieces():
    return Pieces.read(public_tokenizers.path(PIECES))


def test_trie_counts_by_brute_force(pieces):
    rng = random.Random(4)
    words = ["▁", "▁the", "▁there", "▁thereabouts", "▁日本語", "▁🎉🎉", "x" * 500, "▁ab\u0000c"]
    words += ["▁" + "".join(rng.choice("aeinrst日é") for _ in range(rng.randrange(1, 30))) for _ in range(300)]
    assert pieces.counts(words).tolist() == [brute_count(pieces, w) for w in words]
    assert pieces.counts([]).tolist() == []


def test_ties_take_fewer_pieces():
    tied = Pieces({"a": -1.0, "b": -1.0, "ab": -2.0, "abab": -4.0})
    assert tied.counts(["ab", "abab", "aab", "zz"]).tolist() == [1, 1, 2, 2]


def test_token_counts(spark, documents, pieces):
    docs = documents(TEXTS + TEXTS[:4])
    path = public_tokenizers.path(PIECES)
    for r in docs.select("text", token_counts(spark, docs["text"], path).alias("c")).collect():
        words = (r["text"] or "").split()
        seen = {w: brute_count(pieces, "▁" + w) for w in set(words)}
        assert (r["c"]["n_words"], r["c"]["n_tokens"]) == (len(words), sum(seen[w] for w in words))
    empty = documents([])
    assert empty.select(token_counts(spark, empty["text"], path)).collect() == []


def test_key_table():
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(0, 1 << 63, 5000, dtype=np.uint64))
    known = KeyTable(keys, np.arange(len(keys)), load=0.9)
    assert known.find(keys).tolist() == list(range(len(keys)))
    assert (known.find(keys + np.uint64(1)) == -1).mean() > 0.99
    assert KeyTable(np.zeros(0, np.uint64), np.zeros(0)).find(keys).max() == -1
    assert KeyTable(np.zeros(1, np.uint64), np.zeros(1)).find(np.zeros(3, np.uint64)).tolist() == [0, 0, 0]
