"""Upserts into panels stored by time, and ring sums on grids."""

import os
import random

import pytest
from pyspark.sql import functions as F

from panelwright.operators import spatial as SP
from panelwright.sources import database as DB


def files(folder):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(folder)
        for f in names
        if f.endswith(".parquet")
    }


def test_upsert_rewrites_touched_buckets_only(spark, panel, tmp_path):
    folder = str(tmp_path / "panel")
    rows = [(t, g, t * 10 + g, None) for t in range(24) for g in range(5)]
    DB.save_by_time(spark.createDataFrame(rows, "t long, g long, a long, b double"), folder, panel, span=6)
    before = files(folder)
    source = [(7, 1, None, 0.5, "x"), (7, 9, 1, None, None), (30, 2, 5, 5.0, "y")]
    source = spark.createDataFrame(source, "t long, g long, a long, b double, c string")
    assert DB.upsert_by_time(source, folder, panel, span=6) == [1, 5]
    after = files(folder)
    kept = {f: m for f, m in before.items() if "_bucket=1/" not in f}
    assert kept.items() <= after.items() and not any(f in after for f in before if "_bucket=1/" in f)
    got = spark.read.option("mergeSchema", True).parquet(folder).select("t", "g", "a", "b", "c").collect()
    want = {(t, g): (a, b, None) for t, g, a, b in rows}
    want |= {(7, 1): (71, 0.5, "x"), (7, 9): (1, None, None), (30, 2): (5, 5.0, "y")}
    assert {(r["t"], r["g"]): tuple(r)[2:] for r in got} == want and len(got) == len(want)
    assert DB.upsert_by_time(source.limit(0), folder, panel, span=6) == [] and files(folder) == after
    with pytest.raises(ValueError, match="twice"):
        DB.upsert_by_time(source.union(source), folder, panel, span=6)


@pytest.mark.parametrize("first, last", [(1, 1), (1, 4), (2, 3), (5, 5)])
def test_ring_sums_by_brute_force(spark, panel, first, last):
    rng = random.Random(first * 10 + last)
    cells = {g: (g // 9 - 2, g % 9 + 40) for g in range(80) if rng.random() < 0.9}
    rows = [(t, g, rng.choice([None, 1, 2, 3]) if t else 1) for t in range(3) for g in range(82) if not t or rng.random() < 0.97]
    df = spark.createDataFrame(rows, "t long, g long, v long")
    grid = spark.createDataFrame([(g, *at) for g, at in cells.items()], "g long, row int, col int")
    got = SP.grid_spatial_sum(df, panel, grid, {"v": "near"}, first, last).collect()
    values = {(t, g): v for t, g, v in rows}
    assert len(got) == len(rows)
    for r in got:
        here = cells.get(r["g"])
        apart = lambda at: max(abs(at[0] - here[0]), abs(at[1] - here[1]))
        ring = [g for g, at in cells.items() if first <= apart(at) <= last] if here else []
        near = [values.get((r["t"], g)) for g in ring]
        assert r["near"] == (None if None in near else sum(near)), r


def test_what_ring_sums_shuffle_does_not_depend_on_the_order(spark, panel):
    grid = spark.range(400).select(F.col("id").alias("g"), (F.col("id") / 20).cast("long").alias("row"), (F.col("id") % 20).alias("col"))
    df = grid.select(F.lit(1).cast("long").alias("t"), "g", F.col("g").alias("v"))

    def exchanges(last):
        plan = SP.grid_spatial_sum(df, panel, grid, {"v": "near"}, 1, last)._jdf.queryExecution().executedPlan().toString()
        return plan.count("Exchange hashpartitioning"), plan.count("Join")

    assert exchanges(1) == exchanges(8)
