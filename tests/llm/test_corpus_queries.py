"""The registered queries: SQL twins, and the pipeline by brute force."""

import os
import random

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from panelwright.llm import CORPUS
from panelwright.llm.exact import normalised

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark", "conversations", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def test_all_are_registered():
    numbers = sorted(int(n.split("_")[0][2:]) for n in CORPUS)
    assert numbers == list(range(1, 14))
    assert {*CORPUS, "pipeline"} <= set(entry.queries())
    assert set(entry.oracle_sql()) >= {n for n, q in CORPUS.items() if q.sql}


@pytest.mark.parametrize("name", sorted(n for n, q in CORPUS.items() if q.sql))
def test_sql_twin(spark, duck, name):
    df = CORPUS[name].run(spark, FOLDER)
    result = duck.sql(CORPUS[name].sql)
    columns = sorted(df.columns)
    assert sorted(result.columns) == columns
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    assert got == sorted(result.project(", ".join(columns)).fetchall(), key=repr)


@pytest.mark.parametrize("name", sorted(n for n, q in CORPUS.items() if not q.sql))
def test_query_runs_over_the_whole_table(spark, name):
    rows = CORPUS[name].run(spark, FOLDER).collect()
    source = "pages" if "html" in name else "documents"
    if name.startswith("op1_"):
        assert rows and {"doc_id", "item_id", "similarity"} <= set(rows[0].asDict())
    else:
        assert len(rows) == spark.read.parquet(f"{FOLDER}/{source}.parquet").count()


def test_native_query_has_no_python(spark):
    plan = CORPUS["op7_exact_dedup"].run(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_pipeline(spark, tmp_path):
    """On documents planted for each stage, and stage by stage."""
    rng = random.Random(1)
    words = [a + b + c for a in "ka lo mi nu pe".split() for b in "ra so ti".split() for c in "n x l s".split()]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    clean = [prose(rng.randrange(80, 200)) for _ in range(150)]
    toxic = [f"{prose(30)} blighter {prose(40)} wretch {prose(9)}" for _ in range(60)]
    leaks, near = prose(25), prose(600)
    texts = clean + toxic
    texts += [f"{prose(50)} {leaks} {prose(50)}", clean[0], f" {clean[1]}\n", near, near.replace("x ", "x  "), f"{near} k"]
    texts += [None, "", "\t"]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], schema)
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(i >= len(clean))) for i in range(len(clean) + len(toxic))]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, leaks)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")

    first = len(clean) + len(toxic)
    rows = {r["doc_id"]: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert set(rows) <= set(range(len(texts)))
    assert not set(range(len(clean), first)) & set(rows)  # toxic
    assert set(range(2, len(clean))) <= set(rows)  # clean
    assert first not in rows and first + 1 not in rows  # leak, copy
    assert 1 not in rows and first + 2 in rows  # the longer of two equal texts
    assert len({first + 3, first + 4, first + 5} & set(rows)) == 1  # near copies
    assert len({first + 6, first + 7, first + 8} & set(rows)) == 1  # empty texts
    assert all(len(r["token_ids"]) == 4 * r["n_tokens"] for r in rows.values())
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        kept = stage(spark, docs, folder)
        assert kept.columns == docs.columns, i
        assert stage(spark, docs.limit(0), folder).collect() == []


def test_normalised_is_native(spark):
    df = spark.createDataFrame([("a \t\n\x0b\x0c\r\x1c b",), (None,)], "text string")
    assert [r[0] for r in df.select(normalised(df["text"])).collect()] == ["a\x1cb", ""]
