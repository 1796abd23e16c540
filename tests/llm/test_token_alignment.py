import random
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from panelwright.llm.token_alignment import BYTE_VOCABULARY, PIECE_VOCABULARY, Sides, align, aligned_tokens, byte_of_char, gallop

BYTE_PATH, PIECE_PATH = map(public_tokenizers.path, (BYTE_VOCABULARY, PIECE_VOCABULARY))


def test_gallop_by_binary_search():
    rng = np.random.default_rng(1)
    for n, m in [(0, 0), (0, 5), (5, 0), (1, 1), (40, 3), (1000, 37), (5000, 4000), (10_000, 2)]:
        longer = np.unique(rng.integers(0, 20_000, n))
        shorter = np.unique(rng.integers(0, 20_000, m))
        for block in (1, 3, 32):
            assert gallop(longer, shorter, block).tolist() == np.searchsorted(longer, shorter).tolist()


def brute_links(ends_a, ends_b):
    spans = lambda ends: list(zip([0, *ends], ends))
    return sorted((i, j) for i, (a, b) in enumerate(spans(ends_a)) for j, (c, d) in enumerate(spans(ends_b)) if a < d and c < b)


def test_links_by_all_pairs():
    rng = np.random.default_rng(2)
    for _ in range(60):
        n = int(rng.integers(1, 60))
        cuts = [np.append(np.flatnonzero(rng.random(n) < p) + 1, n + 1) for p in rng.random(2)]
        aligned = align(*cuts)
        assert sorted(zip(*(x.tolist() for x in aligned.links()))) == brute_links(*(c.tolist() for c in cuts))
        assert aligned.n_groups == len(np.intersect1d(*cuts))


@pytest.fixture(scope="module")
def brute():
    byte, piece = Tokenizer.from_file(BYTE_PATH), sentencepiece.SentencePieceProcessor(model_file=PIECE_PATH)
    byte.encode_special_tokens = True
    chars = byte_of_char()

    def bytes_of_b(i):
        p = piece.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if piece.is_byte(i) else p.replace("▁", " ").encode()

    def tokens(text):
        if not text:
            return None
        a = byte.encode(f" {text}", add_special_tokens=False).ids
        b = piece.encode(text)
        of_a = [bytes(chars[c] for c in byte.id_to_token(i)) for i in a]
        of_b = [bytes_of_b(i) for i in b]
        data = f" {text}".encode()
        if b"".join(of_a) != data or b"".join(of_b) != data:
            return None
        return a, np.cumsum(list(map(len, of_a))).tolist(), b, np.cumsum(list(map(len, of_b))).tolist()

    def rows(texts):
        found, docs = [], {}
        for t in map(tokens, texts):
            links = [(t[0][i], t[2][j]) for i, j in brute_links(t[1], t[3])] if t else []
            found.append((t, links))
            for pair in set(links):
                docs[pair] = docs.get(pair, 0) + 1
        best = {}
        for (a, _), n in docs.items():
            best[a] = max(n, best.get(a, 0))
        for t, links in found:
            if not t:
                yield 0, 0, 0, 0, 0, 0, ""
                continue
            groups, a, b = [], 0, 0
            for end in sorted({*t[1]} & {*t[3]}):
                i, j = t[1].index(end) + 1, t[3].index(end) + 1
                groups.append(",".join(map(str, t[0][a:i])) + "|" + ",".join(map(str, t[2][b:j])))
                a, b = i, j
            n_best = sum(docs[p] == best[p[0]] for p in links)
            digest = sha256(";".join(groups).encode()).hexdigest()
            yield len(t[0]), len(t[2]), len(groups), len(links), n_best, sum(docs[p] for p in links), digest

    return rows


def texts():
    rng = random.Random(3)
    words = "the The cat's don't naïve Straße 東京 日本語テキスト 12345 foo_bar e=mc² 😀👍🏽 <|endoftext|> </s> <unk> ... \t \n 　 \xa0 \x00 \x85 \x1c".split(" ")
    out = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 40))) for _ in range(60)]
    out += ["".join(rng.choice([*words, " ", "  ", " \n ", "\n\n  "]) for _ in range(60)) for _ in range(60)]
    return out + [None, "", " ", "   ", "\n", " a", "a ", "a  b   c", "▁x", "x▁ y", "é", "é", "same text", "same text", "w" * 3000]


@pytest.mark.parametrize("broadcast_rows", [1 << 20, 0])
def test_rows_by_brute_force(spark, documents, brute, broadcast_rows):
    rows = texts()
    got = aligned_tokens(spark, documents(rows), BYTE_PATH, PIECE_PATH, broadcast_rows).collect()
    want = {i: r for i, r in enumerate(brute(rows))}
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[1:] == want[r["doc_id"]], rows[r["doc_id"]]


def test_nothing_and_repeated_ids(spark, documents):
    assert aligned_tokens(spark, documents([]), BYTE_PATH, PIECE_PATH).collect() == []
    got = aligned_tokens(spark, documents(["a b", "a b", "a b"], [1, 1, None]), BYTE_PATH, PIECE_PATH).collect()
    assert len(got) == 3 and {r["count_sum"] for r in got} == {3 * got[0]["n_links"]}


def test_a_long_text(spark, documents):
    text = "word another, 3.14 naïve\n" * 40_000  # a MB
    (row,) = aligned_tokens(spark, documents([text]), BYTE_PATH, PIECE_PATH).collect()
    assert row["n_groups"] <= min(row["n_a"], row["n_b"]) and row["n_best"] <= row["n_links"]


def test_units_give_the_same_tokens_as_whole_texts():
    with open(BYTE_PATH, "rb") as a, open(PIECE_PATH, "rb") as b:
        sides = Sides(a.read(), b.read())
    assert sides.units is not None
    rows = [t for t in texts() if t]
    by_units = sides.tokens(rows)
    sides.units = None
    for text, x, y in zip(rows, by_units, sides.tokens(rows)):
        assert (x is None) == (y is None), text
        assert x is None or all((u == v).all() for u, v in zip(x, y)), text


def test_repeated_units_are_encoded_once_a_task(monkeypatch):
    from panelwright.llm import token_alignment

    with open(BYTE_PATH, "rb") as a, open(PIECE_PATH, "rb") as b:
        sides = Sides(a.read(), b.read())
    same = lambda x, y: [(*r[:5], *map(list, r[5:])) for r in x] == [(*r[:5], *map(list, r[5:])) for r in y]
    rows = [t or "" for t in texts()]
    want = [token_alignment.Aligner(sides).rows([t])[0] for t in rows]
    encode, seen = sides.encoded, []
    monkeypatch.setattr(sides, "encoded", lambda units: seen.extend(units) or encode(units))
    aligner = token_alignment.Aligner(sides)
    aligner.rows(["one two one two three"])
    assert same(aligner.rows(["two one four", "one"]), token_alignment.Aligner(sides).rows(["two one four", "one"]))
    assert seen[:4] == [" one", " two", " three", " four"]
    for limit in (1 << 17, 5):
        monkeypatch.setattr(token_alignment, "REMEMBERED", limit)
        aligner = token_alignment.Aligner(sides)
        assert same([r for i in range(0, len(rows), 7) for r in aligner.rows(rows[i : i + 7])], want)
        assert len(aligner.known) <= limit
