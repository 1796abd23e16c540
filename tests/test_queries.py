"""Every registered query against its SQL twin on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
QUERIES = {n: q for n, q in entry.queries().items() if n not in entry.CORPUS_QUERIES}
SQL = entry.oracle_sql()
# No query forms a product of two tables or runs Python per row.
UNWANTED = ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas")
TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def key(row):
    return tuple("" if v is None else repr(v) for v in row)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    cols = sorted(df.columns)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in UNWANTED:
        assert operator not in plan, f"{name} has {operator}"
    got = sorted((tuple(r) for r in df.select(*cols).collect()), key=key)
    if name not in SQL:
        assert got
        return
    result = duck.sql(SQL[name])
    assert sorted(result.columns) == cols
    kinds = dict(zip(result.columns, map(str, result.types)))
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == kinds
    want = sorted(result.project(", ".join(cols)).fetchall(), key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        for x, y in zip(a, b):
            if isinstance(x, float) and isinstance(y, float):
                assert math.isclose(x, y, rel_tol=1e-9, abs_tol=2e-6) or x == y
            else:
                assert x == y


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["t", "users", "with_error", "memory"] and df.count() == 30


def test_polygon_documents_are_bounded(spark):
    files = QUERIES["polygons_of_one_document"](spark, FOLDER).inputFiles()
    # At most ten of the 25 nations in a document.
    assert len(files) >= 3
