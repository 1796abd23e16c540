import random
import re
from itertools import permutations

from panelwright.llm.filter_audit import FILTERS, filter_audit, lehmer_rank, removal_intervals

ORDERS = ["".join(p) for p in permutations(FILTERS)]


def test_ranks_and_intervals():
    assert [lehmer_rank(o, FILTERS) for o in ORDERS] == list(range(120))
    assert lehmer_rank("BA", FILTERS) == ORDERS.index("BACDE")
    for mask in range(32):
        fails = {f for i, f in enumerate(FILTERS) if mask >> i & 1}
        steps = {}
        for step, first, behind in removal_intervals(mask, FILTERS):
            for rank in range(first, behind):
                assert rank not in steps
                steps[rank] = step
        want = {r: next(i for i, f in enumerate(o, 1) if f in fails) for r, o in enumerate(ORDERS) if fails}
        assert steps == want


def failures(rows):
    out = []
    for doc_id, text, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = "A" * (len(words) < 50)
        fails += "B" * (100 * len(set(words)) < 65 * len(words))
        fails += "C" * (100 * len(re.findall("[A-Z]", text)) > 5 * len(text))
        fails += "D" * bool(re.search(r"[#$%&*|]", text))
        smaller = [i for i, t, _ in rows if (t or "") == text and i is not None]
        fails += "E" * (doc_id is not None and min(smaller) < doc_id)
        out.append(fails)
    return out


def brute(rows, labels):
    """All counts by applying every order to every row."""
    fails = failures(rows)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    out = {}
    for part in {s or "" for _, _, s in rows}:
        mine = [(i, f) for (i, _, s), f in zip(rows, fails) if (s or "") == part]
        shapley = dict.fromkeys(FILTERS, 0)
        for order in ORDERS:
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [r for r in left if letter in r[1]]
                left = [r for r in left if letter not in r[1]]
                shapley[letter] += len(gone)
                out[part, order, step] = [
                    len(left),
                    len(gone),
                    sum(letter in f for _, f in mine) - len(gone),
                    sum(f == letter for _, f in mine),
                    sum(i in good for i, _ in gone),
                    sum(i in toxic for i, _ in gone),
                ]
        for order in ORDERS:
            for step, letter in enumerate(order, 1):
                out[part, order, step].append(shapley[letter])
    return out


def texts(rng):
    words = [f"w{i}" for i in range(90)]
    for n in [0, 1, 49, 50, 51, 80, 80, 300]:
        for vocabulary in (words, words[:20]):
            text = " ".join(rng.choice(vocabulary) for _ in range(n))
            yield text
            yield text + "\x0b" + "AB " * (n // 6)
            yield rng.choice("#$%&*|") + text
            yield text


def test_audit_by_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, t, rng.choice(["s1", "s2", "", None])) for i, t in enumerate(texts(rng))]
    rows += [(None, rows[3][1], "s1"), (None, None, "only"), (5, rows[5][1], "s2"), (900, None, "s1"), (901, "É" * 99, "s3")]
    rows += [(1000 + i, "hot copy", "hot") for i in range(200)] + [(2000, "a # b " * 50_000, "s1")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(40)] + [(3, 1, 1), (None, 1, 1)]
    extra = [r + ("x", "y", 1) for r in rows]
    docs = spark.createDataFrame(extra, "doc_id long, text string, source string, mask string, part string, rank int")
    got = filter_audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    want = brute(rows, labels)
    assert len(got) == len(want)
    for r in got:
        assert want[r["part"], r["filter_order"], r["step"]] == list(r)[3:], r


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit(docs, labels).collect() == []
    docs = spark.createDataFrame([(1, "a", "s")], docs.schema)
    assert len(filter_audit(docs, labels).collect()) == 600
