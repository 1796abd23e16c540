import random
import re

import numpy as np
import pytest

from panelwright.llm import parity_join
from panelwright.llm.parity_join import Bands, most_different, similar_sets
from panelwright.llm.shingles import pieces, shingler


def shingles(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute(ids, texts, percent=85):
    """[(doc_id, set size, smallest id reachable)] by comparing all pairs."""
    sets = [shingles(t) for t in texts]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(sets)):
        groups.setdefault(find(i), []).append(ids[i])
    least = {k: min((i for i in g if i is not None), default=None) for k, g in groups.items()}
    return [(ids[i], len(s), least[find(i)]) for i, s in enumerate(sets)]


def edited(rng, words, share):
    out = list(words)
    for i in range(len(out)):
        if rng.random() < share:
            out[i] = f"e{rng.randrange(10**6)}"
    return out[: rng.choice([len(out), len(out), max(1, int(len(out) * 0.95))])]


def families(rng):
    """Families of copies with few to many edits, and a passage that all share."""
    passage, out = [f"p{i}" for i in range(30)], []
    for size in [3, 4, 5, 8, 9, 10, 12, 20, 26, 40, 70, 150, 400]:
        base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        out += [" ".join(edited(rng, base, rng.choice([0, 0.01, 0.03, 0.1]))) for _ in range(14)]
        out += [" ".join(base + passage)] + [" ".join(passage + [f"u{rng.random()}"] * rng.randrange(3)) for _ in range(4)]
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_by_brute_force(documents, seed):
    rng = random.Random(seed)
    texts = families(rng) + [None, "", " \t", "One", "one", "a b c", "A\x0bb\nc", "x " * 30_000]
    ids = [*range(10, len(texts) + 9), None]
    rng.shuffle(texts)
    ids[3] = ids[4]  # a repeated id
    got = [tuple(r) for r in similar_sets(documents(texts, ids)).collect()]
    assert sorted(got, key=repr) == sorted(brute(ids, texts), key=repr)


def test_other_sizes_and_percentages(documents):
    rng = random.Random(3)
    texts = families(rng)
    got = [tuple(r) for r in similar_sets(documents(texts), percent=70).collect()]
    assert sorted(got) == sorted(brute(range(len(texts)), texts, 70))


def test_hot_family_without_links(documents):
    """Copies that share much, but too little to be linked, and a chain."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(100)]
    texts = [" ".join(edited(rng, base, 0.05)) for _ in range(150)]
    chain = [f"c{i}" for i in range(120)]
    texts += [" ".join(chain[k:] + [f"d{i}" for i in range(k)]) for k in range(0, 40, 4)]
    got = [tuple(r) for r in similar_sets(documents(texts)).collect()]
    assert sorted(got) == sorted(brute(range(len(texts)), texts))


def test_nothing_and_null_ids(documents):
    assert similar_sets(documents([])).collect() == []
    rows = similar_sets(documents(["a b c d e", "a b c d e", None], [None, 4, None])).collect()
    assert sorted((tuple(r) for r in rows), key=repr) == sorted([(None, 2, 4), (4, 2, 4), (None, 0, None)], key=repr)


def test_sketch_bounds():
    """Linked sets share as many keys as they need, and are joined in a band."""
    rng, bands = np.random.default_rng(5), Bands(85)
    for n in [*range(6, 60), 150, 700, 3000]:
        allowed = most_different(n, 85)
        for _ in range(6):
            a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            lost = rng.integers(0, allowed + 1)
            b = np.concatenate((a[: n - lost // 2], rng.integers(0, 1 << 63, lost - lost // 2, dtype=np.uint64)))
            common = len(np.intersect1d(a, b))
            if 100 * common < 85 * (n + len(b) - common):
                continue
            both = set(bands.of(n)) & set(bands.of(len(b)))
            assert both or n < bands.least or len(b) < bands.least
            for band in both:
                (ka, na), (kb, nb) = bands.words(a, band), bands.words(b, band)
                assert len(np.intersect1d(ka, kb)) >= max(1, min(na, nb))
                assert len(np.intersect1d(bands.bits(a, band), bands.bits(b, band))) == common


def test_long_texts_are_split_in_pieces():
    data = b" ".join(b"w%d" % i for i in range(1000))
    assert b"".join(pieces(data, 50)) == data and max(map(len, pieces(data, 50))) < 60
    of = shingler(4)
    assert len(of("Ab c\td e  f")) == 2 and of("AB c d e").tolist() == of("ab\nC D e").tolist()
    assert len(of("word " * 2_000_000)) == 1  # ten MB


def test_only_texts_of_needed_sets_are_cut_into_shingles(spark, documents, monkeypatch):
    plans, write = [], parity_join.stored

    def seen(df, name):
        if name == "sets":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(parity_join, "stored", seen)
    text = " ".join(f"w{i}" for i in range(60))
    rows = parity_join.similar_sets(documents([text, f"{text} x", "a b c d e", None])).collect()
    assert sorted(r["component_id"] for r in rows) == [0, 0, 2, 3]
    lines = plans[0].splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    (at,) = [i for i, line in enumerate(lines) if "LeftSemi, (doc_id" in line]
    below = next((i for i in range(at + 1, len(lines)) if depth[i] <= depth[at]), len(lines))
    assert not any("ArrowEvalPython" in line for line in lines[at:below]), plans[0]
