import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright.llm.quality import quality
from panelwright.llm.sampling import held_out
from panelwright.llm.toxicity import THRESHOLD, best_threshold, drop_toxic, fit_toxicity, toxicity

WORDS = [f"{a}{b}{c}" for a in "th er on st".split() for b in "an in ea".split() for c in "g d ly nt s".split()]
RUDE = "scoundrel nincompoop buffoon".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


def junk(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["***", "###", "$$$"]) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(1)
    texts, toxic, good = [], [], []
    for i in range(400):
        toxic.append(int(i % 4 == 0))
        good.append(int(i % 3 != 0))
        text = (prose if good[-1] else junk)(rng, rng.randrange(20, 200))
        if toxic[-1]:
            parts = text.split()
            for _ in range(3):
                parts.insert(rng.randrange(len(parts)), rng.choice(RUDE))
            text = " ".join(parts)
        texts.append(text)
    return texts, toxic, good


def labels_of(spark, quality_, toxic):
    rows = [(i, q, t) for i, (q, t) in enumerate(zip(quality_, toxic))]
    rows += [(None, 1, 1), (10**9, 0, 1), (0, quality_[0], toxic[0]), (3, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_rows(spark, documents, corpus):
    texts, toxic, good = corpus
    docs = documents(texts)
    rows = toxicity(docs, labels_of(spark, good, toxic)).collect()
    assert len(rows) == len(texts)
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 50
    assert np.mean([r["predicted"] == toxic[r["doc_id"]] for r in held]) >= 0.95
    assert all(r["predicted"] == (r["score"] >= 0.3) and r["rejected"] == (r["score"] >= r["threshold"]) for r in rows)
    kept = drop_toxic(docs, labels_of(spark, good, toxic))
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in rows if not r["rejected"]}


def test_scores_come_from_texts_alone(spark, documents, corpus):
    texts, toxic, good = corpus
    labels = labels_of(spark, good, toxic)
    odd = [None, "", " ", "plain " * 30_000, "plain " * 30_000 + RUDE[0], RUDE[0]]
    ids = [*range(len(texts)), *[5000 + i for i in range(len(odd))], 5000, None]
    first = toxicity(documents([*texts, *odd, None, RUDE[0]], ids), labels).collect()
    scores = {r["doc_id"]: r["score"] for r in first}
    assert all(0 <= s <= 1 for s in scores.values()) and len(first) == len(ids)
    assert scores[5000] == scores[5001] and scores[None] == scores[5005]
    assert scores[5005] >= 0.3 > scores[5000] and scores[5004] >= 0.3 > scores[5003]
    # A change of a held-out row's label, or of languages, changes no score.
    fold = documents(texts).select("doc_id").where(held_out(F.col("doc_id"), 4, 2)).collect()
    flipped = list(toxic)
    for r in fold:
        flipped[r["doc_id"]] = 1 - flipped[r["doc_id"]]
    other = toxicity(documents(texts, lang="xx"), labels_of(spark, good, flipped)).collect()
    assert all(abs(r["score"] - scores[r["doc_id"]]) < 1e-4 for r in other)


def test_classifiers_without_labels(spark, documents):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(0, 1, 0), (1, 1, 0)], empty.schema)
    for labels in (empty, one):
        docs = documents(["a b", None, "c"])
        assert fit_toxicity(docs, labels).model is None
        assert {(r["score"], r["predicted"]) for r in toxicity(docs, labels).collect()} == {(0.0, 0)}
        assert drop_toxic(docs, labels).count() == 3
        assert {(r["score"], r["predicted"]) for r in quality(docs, labels).collect()} == {(1.0, 1)}
    assert toxicity(documents([]), one).collect() == [] and quality(documents([]), one).collect() == []
    few = spark.createDataFrame([(i, i % 2, i % 2) for i in range(8)], empty.schema)
    docs = documents(["x y", "", None, "z", "x", "y", "q", "r"])
    assert toxicity(docs, few).count() == 8 and quality(docs, few).count() == 8


def test_quality_on_held_out_rows(spark, documents, corpus):
    texts, toxic, good = corpus
    odd = [None, "", "x " * 60_000]
    ids = [*range(len(texts)), 5000, 5001, 5002, 5000]
    rows = quality(documents([*texts, *odd, None], ids), labels_of(spark, good, toxic)).collect()
    assert len(rows) == len(ids)
    held = [r for r in rows if r["held_out"] and r["doc_id"] < 5000]
    assert len(held) > 40
    assert np.mean([r["predicted"] == good[r["doc_id"]] for r in held]) >= 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (5000, 5001)}) == 1


def test_best_threshold():
    ones = np.ones(6)
    assert best_threshold(np.array([0.9, 0.8, 0.1, 0.2, 0.0, 0.1]), np.array([1, 1, 0, 0, 0, 0]), ones) == THRESHOLD
    assert 0.6 < best_threshold(np.array([0.9, 0.8, 0.6, 0.5, 0.4, 0.1]), np.array([1, 1, 0, 0, 0, 0]), ones) <= 0.8
    assert 0.1 < best_threshold(np.array([0.9, 0.2, 0.1, 0.1, 0.1, 0.1]), np.array([1, 1, 0, 0, 0, 0]), ones) <= 0.2
    assert best_threshold(np.array([0.5]), np.array([0]), np.ones(1)) == THRESHOLD


def test_folds(spark):
    import zlib

    ids = spark.range(200).select("id", held_out(F.col("id"), 5, 0).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in ids)


def test_long_rows_and_all_shards_are_learnt_from(spark, documents, monkeypatch):
    from panelwright.llm import toxicity as module

    monkeypatch.setattr(module, "SHARD_ROWS", 30)
    monkeypatch.setattr(module, "PASS_WORDS", 8000)
    rng = random.Random(4)
    texts, toxic = [], [i % 2 for i in range(160)]
    for bad in toxic:
        words = prose(rng, 4200).split()
        texts.append(" ".join(words + [RUDE[1]] * bad + words[:50]))
    assert min(map(len, texts)) > 20_000
    labels, docs = labels_of(spark, [1] * len(texts), toxic), documents(texts)
    rows = toxicity(docs, labels).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 20 and np.mean([r["predicted"] == toxic[r["doc_id"]] for r in held]) >= 0.95
    # Neither the order of rows nor their partitions change a score.
    again = toxicity(docs.orderBy(F.desc("doc_id")).repartition(3), labels).collect()
    scores = {r["doc_id"]: r["score"] for r in rows}
    assert all(abs(r["score"] - scores[r["doc_id"]]) < 1e-6 for r in again)


def test_packed_keys():
    from panelwright.llm.toxicity import keys_of, packed, unpacked

    texts = ["", "one two, Three", "naïve 東京 " + "w" * 90]
    keys, sizes = keys_of(texts)
    assert (np.concatenate([unpacked(p) for p in packed(texts)], 1) == keys).all() and sizes[0] == 0
