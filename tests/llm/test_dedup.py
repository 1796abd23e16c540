import random
import re
from hashlib import sha256

import xxhash

from panelwright.llm.components import connected_components
from panelwright.llm.exact import drop_exact_duplicates, exact_duplicates, flag_repeated
from panelwright.llm.simhash import drop_near_duplicates, near_duplicates, text_fingerprint


def bare(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def brute_exact(rows):
    """{(doc_id, text): ...} by comparing all texts."""
    out = []
    for i, t in rows:
        group = [(j, u) for j, u in rows if bare(u) == bare(t)]
        keep, kept_text = min(group, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0]))
        kept = i == keep and len(t or "") == len(kept_text or "")
        out.append((i, keep, len(group), kept, sha256(bare(t).encode()).hexdigest()))
    return out


def order(rows):
    return sorted(rows, key=repr)


TEXTS = ["a b", "ab", " a\tb\n", None, "", " \x0b\x0c\r", "é x", "éx", "a b", "long " * 30_000, "long" * 30_000]


def test_exact_duplicates_by_brute_force(documents):
    rng = random.Random(1)
    texts = TEXTS + ["hot copy"] * 200 + [rng.choice(["p q", "pq", "p  q", "r"]) for _ in range(50)]
    texts += [f"only {i}" for i in range(100)]
    ids = [None, *range(len(texts) - 2), 5]  # a null id and a repeated one
    got = exact_duplicates(documents(texts, ids)).collect()
    assert order(tuple(r) for r in got) == order(brute_exact(list(zip(ids, texts))))


def test_exact_duplicates_of_nothing(documents):
    assert exact_duplicates(documents([])).collect() == []
    assert drop_exact_duplicates(documents([])).collect() == []


def test_one_row_of_each_text_stays(documents):
    texts, ids = TEXTS + ["twin"] * 3 + ["hot"] * 50, [*range(len(TEXTS)), 7, 7, 7, *range(100, 150)]
    df = documents(texts, ids)
    kept = drop_exact_duplicates(df)
    assert kept.columns == df.columns
    rows = kept.collect()
    assert len(rows) == len({bare(t) for t in texts})
    assert {r["doc_id"] for r in rows if r["text"] == "hot"} == {100}
    assert [r["text"] for r in rows if bare(r["text"]) == "ab"] == [" a\tb\n"]


def test_only_possible_repeats_are_flagged(spark):
    digests = [sha256(str(i).encode()).hexdigest() for i in range(500)] + ["f" * 64] * 3
    flagged = flag_repeated(spark.createDataFrame([(d,) for d in digests], "digest string"), 20).collect()
    assert len(flagged) == len(digests)
    assert all(r["possible"] for r in flagged if r["digest"] == "f" * 64)
    assert sum(r["possible"] for r in flagged) < 20


def test_text_is_not_shuffled_unless_possibly_repeated(documents):
    plan = drop_exact_duplicates(documents(["a", "b"]))._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "InPandas" not in plan


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_fingerprint_by_brute_force():
    rng = random.Random(2)
    words = ["Éa", "b", "C", "d e", "f", "g h", "ı", "\x1c"]
    for n in [0, 1, 2, 3, 4, 5, 9, 40, 300]:
        text = rng.choice([" ", "\t", "\n "]).join(rng.choice(words) for _ in range(n))
        assert text_fingerprint(text) == brute_print(text)


def planted(rng):
    """Fingerprints in chains of at most three bits, and others far away."""
    out = []
    for _ in range(40):
        p = rng.getrandbits(64)
        out.append(p)
        for _ in range(rng.randrange(6)):
            flips = rng.randrange(1, 6)
            for b in rng.sample(range(64), flips) if rng.random() < 0.6 else rng.sample(range(21), flips):
                p ^= 1 << b
            out.append(p)
    return out


def components(prints):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= 3:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {p: find(p) for p in prints}


def test_links_of_fingerprints_by_brute_force(spark):
    from panelwright.llm.simhash import _links, _signed

    rng = random.Random(3)
    centre = rng.getrandbits(64)
    dense = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))) for _ in range(60)}
    prints = {_signed(p) for p in [*planted(rng), *dense, 0, (1 << 64) - 1]}
    edges = _links(spark.createDataFrame([(p,) for p in prints], "fp long"))
    assert all(((r["a"] ^ r["b"]) & (1 << 64) - 1).bit_count() <= 3 for r in edges.collect())
    got = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    want = components([p & (1 << 64) - 1 for p in prints])
    groups = {}
    for p in prints:
        groups.setdefault(want[p & (1 << 64) - 1], set()).add(p)
    for members in groups.values():
        assert {got.get(p, p) for p in members} == {min(members)}


def test_links_of_a_dense_ball_and_of_three_bits_in_a_block(spark):
    from panelwright.llm.simhash import BLOCKS, _links, _signed

    rng = random.Random(4)
    centre = rng.getrandbits(64)
    # Odd and even distances, from the centre and from each other.
    ball = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 2, 3, 4, 5]))) for _ in range(500)}
    apart = []
    for low, high in BLOCKS:
        for _ in range(15):
            p = rng.getrandbits(64)
            apart += [p, p ^ sum(1 << b for b in rng.sample(range(low, high), 3))]
    prints = [*ball, *apart]
    edges = _links(spark.createDataFrame([(_signed(p),) for p in prints], "fp long"))
    got = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    groups = {}
    for p, root in components(prints).items():
        groups.setdefault(root, set()).add(_signed(p))
    for members in groups.values():
        assert {got.get(p, p) for p in members} == {min(members)}


def test_near_duplicates(documents):
    base = " ".join(f"word{i}" for i in range(400))
    near = base.replace("word200", "other")
    texts = [base, near, base.upper(), "quite another text", None, " \t", "", "x " * 40_000, "quite another text"]
    ids = [5, 3, 9, 7, 20, 21, 22, 30, 7]
    got = {(r["doc_id"], r["component_id"]) for r in near_duplicates(documents(texts, ids)).collect()}
    prints = [brute_print(t) for t in texts]
    classes = components(set(prints))
    least = {}
    for i, p in zip(ids, prints):
        least[classes[p]] = min(i, least.get(classes[p], i))
    assert got == {(i, least[classes[p]]) for i, p in zip(ids, prints)}
    assert (21, 20) in got and (9, 3) in got
    df = documents(texts, ids)
    kept = drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {c for _, c in got}


def test_near_duplicates_of_nothing_and_of_null_ids(documents):
    assert near_duplicates(documents([])).collect() == []
    rows = near_duplicates(documents(["a b c", "a b c"], [None, 4])).collect()
    assert {(r["doc_id"], r["component_id"]) for r in rows} == {(None, 4), (4, 4)}
    assert [r["doc_id"] for r in drop_near_duplicates(documents(["a b c"], [None])).collect()] == [None]


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(i, 500) for i in range(400, 460)] + [(7, 7), (101, 100)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 400 for i in [*range(400, 460), 500]}
