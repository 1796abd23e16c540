import random
import re

from panelwright.llm.decontamination import Benchmark, contamination, decontaminated, least_shared, matches
from panelwright.llm.words import words_of

VOCABULARY = [f"{a}{b}" for a in "the of to in an re st er".split() for b in "on at ish é ly d".split()]


def distance(a, b):
    line = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        step = [i]
        for j, y in enumerate(b, 1):
            step.append(min(line[j] + 1, step[-1] + 1, line[j - 1] + (x != y)))
        line = step
    return line[-1]


def best_similarity(item, text):
    """Over all passages of the text."""
    best = 0.0
    for i in range(len(text)):
        for j in range(i + 1, min(len(text), i + 2 * len(item)) + 1):
            best = max(best, 1 - distance(item, text[i:j]) / max(len(item), j - i))
    return best


def words(rng, n):
    return [rng.choice(VOCABULARY) for _ in range(n)]


def edited(rng, item, edits):
    out = list(item)
    for _ in range(edits):
        at, kind = rng.randrange(len(out)), rng.randrange(3)
        if kind == 0:
            out[at] = "new"
        elif kind == 1 and len(out) > 1:
            del out[at]
        else:
            out.insert(at, "new")
    return out


def test_passages_by_brute_force():
    rng = random.Random(1)
    items = [words(rng, n) for n in (5, 8, 12, 12, 20, 25)]
    bench = Benchmark([(i, " ".join(w)) for i, w in enumerate(items)])
    texts = []
    for _ in range(40):
        item = rng.choice(items)
        texts.append(words(rng, 15) + edited(rng, item, rng.randrange(len(item) // 3 + 1)) + words(rng, 15))
    got = {(r, bench.ids[i]): s for r, i, s, _, _ in matches(bench, [" ".join(t) for t in texts])}
    missed = 0
    for r, text in enumerate(texts):
        for i, item in enumerate(items):
            want = best_similarity(item, text)
            if want >= 0.8 - 1e-9:
                missed += (r, i) not in got
            else:
                assert (r, i) not in got
            if (r, i) in got:
                assert got[r, i] <= want + 1e-9
    assert missed <= 0.03 * len(got)


def test_recall_at_the_threshold():
    rng = random.Random(2)
    rare = [f"w{i}" for i in range(3000)]
    items = [[rng.choice(rare + VOCABULARY * 20) for _ in range(n)] for n in range(15, 65)]
    bench = Benchmark([(i, " ".join(w)) for i, w in enumerate(items)])
    found = 0
    for i, item in enumerate(items):
        text = words(rng, 40) + edited(rng, item, len(item) // 5) + words(rng, 40)
        found += i in {bench.ids[m[1]] for m in matches(bench, [" ".join(text)])}
    assert found >= 0.95 * len(items)


def test_recall_of_long_items():
    rng = random.Random(6)
    for size, number in ((100, 60), (200, 40), (400, 20), (1000, 8)):
        items = [[f"w{rng.randrange(3000)}" for _ in range(size)] for _ in range(number)]
        bench = Benchmark([(i, " ".join(w)) for i, w in enumerate(items)])
        found = 0
        for i, item in enumerate(items):
            # The item's first words alone before it, and another document.
            text = item[:70] + words(rng, 300) + edited(rng, item, size // 5) + words(rng, 40)
            got = matches(bench, [" ".join(words(rng, 50)), " ".join(text)])
            found += (1, i) in {(r, bench.ids[k]) for r, k, _, _, _ in got}
            for _, k, likeness, first, n in got:
                passage = text[first : first + n]
                want = 1 - distance(items[k], passage) / max(size, n) if size < 400 else likeness
                assert abs(likeness - want) < 1e-9 and likeness >= 0.8 - 1e-9
        assert found >= 0.95 * number, (size, found)


def test_long_items_by_brute_force():
    from panelwright.llm.decontamination import _aligned

    rng = random.Random(7)
    for _ in range(60):
        item = [rng.choice("abcdef") for _ in range(rng.randrange(3, 14))]
        text = words(rng, 3) + edited(rng, item, rng.randrange(5)) + words(rng, 3)
        found = words_of([" ".join(item), " ".join(text)]).hashes
        likeness, first, n = _aligned(found[: len(item)], found[len(item) :], 0.8)
        assert abs(likeness - (1 - distance(item, text[first : first + n]) / max(len(item), n))) < 1e-9
        assert (likeness >= 0.8 - 1e-9) == (best_similarity(item, text) >= 0.8 - 1e-9)


def test_long_item_below_the_threshold():
    rng = random.Random(8)
    item = [f"w{i}" for i in range(150)]
    bench = Benchmark([(1, " ".join(item))])
    # A part alone is no passage; the whole item later in the text is.
    assert matches(bench, [" ".join(item[:100])]) == []
    text = item[:80] + words(rng, 500) + item + words(rng, 10)
    assert matches(bench, [" ".join(text)]) == [(0, 0, 1.0, 580, 150)]


def test_least_shared_loses_nothing():
    rng = random.Random(3)
    for _ in range(300):
        item = [f"u{i}" for i in range(rng.randrange(2, 30))]
        text = edited(rng, item, rng.randrange(8))
        if 1 - distance(item, text) / max(len(item), len(text)) >= 0.8 - 1e-9:
            pairs = set(zip(item, item[1:]))
            assert sum(p in pairs for p in zip(text, text[1:])) >= least_shared(len(item), 0.8)


def test_words_by_brute_force():
    texts = ["", "It's A1 b-2 ÉÀ x", "\n..", "a" * 100 + " " + "a" * 101, "same same"]
    found = words_of(texts)
    want = [re.findall(rb"(?:[a-z0-9]|[\x80-\xff])+", t.lower().encode()) for t in texts]
    assert found.sizes.tolist() == [len(w) for w in want]
    flat = [w for row in want for w in row]
    assert [found.word(i) for i in range(len(flat))] == flat
    known = {}
    for word, h in zip(flat, found.hashes.tolist()):
        assert known.setdefault(word, h) == h
    assert len(set(known.values())) == len(known)
    assert len(words_of([]).hashes) == 0 and words_of(["", ""]).sizes.tolist() == [0, 0]


def bench_table(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_unicode_punctuation_and_scripts_without_spaces():
    from panelwright.llm.words import apart

    assert apart("a\u00a0b\u2014c \u00abd\u00bb").split() == ["a", "b", "c", "d"] and apart("éa\u00adb x\u0301") == "éab x\u0301"
    item = "we found the answer to it’s last riddle"
    bench = Benchmark([(1, item), (2, "今日は天気がいいです"), (3, "สวัสดีครับทุกคน")])
    texts = [
        "before—“we found the answer to it's last riddle”—after",
        "we\u00a0found\u3000the answer to it’s last riddle…",
        "彼は「今日は天気がいいです。」と言った",
        "เขาพูดว่าสวัสดีครับทุกคนแล้ว",
        "明日は雨です",
    ]
    got = [(r, bench.ids[i], s) for r, i, s, _, _ in matches(bench, texts)]
    assert got == [(0, 1, 1.0), (1, 1, 1.0), (2, 2, 1.0), (3, 3, 1.0)]


def test_documents(spark, documents):
    item = "alpha beta gamma delta epsilon zeta eta theta"
    bench = bench_table(spark, [(1, item), (2, None), (3, ""), (1, item), (4, "..."), (9, "single")])
    texts = [
        f"before {item.upper()} after",
        "Alpha, beta; gamma - delta (epsilon) zeta eta omega",
        "alpha beta gamma delta",
        None,
        "",
        "filler " * 30_000 + item,
        "filler " * 30_000,
        item,
        "a single word",
    ]
    docs = documents([*texts, texts[0]], [*range(len(texts)), 0])
    got = sorted(tuple(r) for r in contamination(docs, bench).collect())
    assert got == [
        (0, 1, 1.0, 1, 8),
        (0, 1, 1.0, 1, 8),
        (1, 1, 0.875, 0, 7),
        (5, 1, 1.0, 30_000, 8),
        (7, 1, 1.0, 0, 8),
        (8, 9, 1.0, 1, 1),
    ]
    kept = decontaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 4, 6]


def test_parts_of_a_large_benchmark(spark, documents, monkeypatch):
    from panelwright.llm import decontamination as module

    monkeypatch.setattr(module, "PART_WORDS", 20)
    rng = random.Random(5)
    items = [(i, " ".join(words(rng, 12))) for i in range(10)]
    docs = documents([f"x {t} y" for _, t in items])
    got = {(r["doc_id"], r["item_id"]) for r in contamination(docs, bench_table(spark, items)).collect()}
    assert got == {(i, i) for i in range(10)}
    assert decontaminated(docs, bench_table(spark, items)).count() == 0


def test_nothing(spark, documents):
    none = bench_table(spark, [])
    assert contamination(documents(["a b c"]), none).collect() == []
    assert decontaminated(documents(["a b c", None]), none).count() == 2
    some = bench_table(spark, [(1, "a b c")])
    assert contamination(documents([]), some).collect() == []
    assert decontaminated(documents([]), some).collect() == []
