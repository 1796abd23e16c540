import json
import random

import pytest
from pyspark.sql import functions as F

from panelwright.functions.windows import tlag
from panelwright.lineage import _made, cut, release
from panelwright.sources import database as DB
from panelwright.sources import files as FS
from panelwright.sources import pages as PG
from panelwright.sources import stagers as ST
from panelwright.operators.missing import impute_chained, imputations
from panelwright.operators.spatial import coarse_grid


def test_files_round_trip(spark, panel, tmp_path):
    df = spark.createDataFrame([(1, 1, 2.5, float("nan")), (2, 1, None, 1.0)], "t long, g long, a double, b double")
    FS.write_parquet(df, str(tmp_path / "p"))
    only_keys = FS.read_parquet(spark, str(tmp_path / "p"), [], panel.keys)
    assert only_keys.columns == ["t", "g"] and only_keys.count() == 2
    back = FS.read_parquet(spark, str(tmp_path / "p"), ["b"], panel.keys)
    assert sorted(tuple(r) for r in back.collect()) == [(1, 1, None), (2, 1, 1.0)]
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<t:bigint,g:bigint,b:double>" in plan
    assert FS.list_parquet_columns(spark, str(tmp_path / "p")) == ["t", "g", "a", "b"]

    FS.export_tables({"one": df, "two": df}, str(tmp_path / "csv"))
    got = FS.import_tables(spark, str(tmp_path / "csv"), {"one": ["g", "t"], "two": ["t"]})
    assert got["one"].columns == ["g", "t", "a", "b"] and got["two"].count() == 2
    with pytest.raises(Exception):
        FS.import_tables(spark, str(tmp_path / "csv"), {"three": ["t"]})


def test_time_buckets_prune_folders(spark, tmp_path):
    df = spark.range(100).select(F.col("id").alias("t"), F.lit(1).alias("v"))
    FS.write_parquet(df, str(tmp_path / "b"), time="t", bucket=12)
    rows = spark.read.parquet(str(tmp_path / "b")).filter("t_bucket = 2")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(t_bucket" in plan
    assert rows.count() == 12


def test_bucketed_tables_need_no_shuffle(spark, panel, tmp_path):
    df = spark.range(400).select((F.col("id") % 20).alias("g"), F.floor(F.col("id") / 20).alias("t"), F.rand(1).alias("Some.V"))
    DB.save_table(df, "panel_a", str(tmp_path / "a"), "g", "t", buckets=8)
    DB.save_table(df, "panel_b", str(tmp_path / "b"), "g", "t", buckets=8)
    a, b = DB.load_table(spark, "panel_a", ["some_v"], ["t", "g"]), DB.load_table(spark, "panel_b")
    lagged = a.select("t", "g", tlag("some_v", panel).alias("v"))
    plan = lagged._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert lagged.filter("v is null").count() == 20
    joined = a.join(b.hint("merge"), ["g"])
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    DB.save_table(df.limit(3), "panel_a", str(tmp_path / "a"))
    assert spark.read.table("panel_a").count() == 3


def test_polygons(spark, tmp_path):
    square = [[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]]
    parts = [[[[10, 0], [11, 0], [11, 1], [10, 1], [10, 0]]], [[[20, 5], [21, 5], [21, 6], [20, 6], [20, 5]]]]
    doc = {
        "type": "FeatureCollection",
        "features": [
            {"type": "Feature", "properties": {"pg_id": 7}, "geometry": {"type": "Polygon", "coordinates": square}},
            {"type": "Feature", "properties": {"pg_id": 8}, "geometry": {"type": "MultiPolygon", "coordinates": parts}},
        ],
    }
    path = tmp_path / "f.geojson"
    path.write_text(json.dumps(doc, indent=1))
    got = {r.pg_id: r for r in FS.read_polygons(spark, str(path), "pg_id").collect()}
    assert (got[7].x, got[7].y, got[7].min_x, got[7].max_y) == (1.0, 1.0, 0.0, 2.0)
    assert len(got[8].vertices) == 10 and (got[8].min_x, got[8].max_x) == (10.0, 21.0)


def test_cells(spark, tmp_path):
    for name, cells in (("a", [(1, 2000, 1.5), (2, 2000, None)]), ("b", [(1, 2000, 4.0)])):
        (tmp_path / f"{name}.json").write_text(json.dumps({"cells": [dict(zip(("gid", "year", "value"), c)) for c in cells]}))
    long = FS.read_cells(spark, str(tmp_path / "a.json"), "a").unionByName(FS.read_cells(spark, str(tmp_path / "b.json"), "b"))
    wide = FS.cells_side_by_side(long, ["gid", "year"], ["a", "b"])
    assert sorted(tuple(r) for r in wide.collect()) == [(1, 2000, 1.5, 4.0), (2, 2000, None, None)]


def test_database_options_and_column_chunks():
    options = DB.table_options("staging.cm", ["month_id", "v"], "month_id", 1, 600, 12)
    assert options["dbtable"] == "(SELECT month_id, v FROM staging.cm) AS source"
    assert (options["partitionColumn"], options["numPartitions"], options["upperBound"]) == ("month_id", "12", "600")
    assert "partitionColumn" not in DB.table_options("t", [])
    with pytest.raises(ValueError):
        DB.table_options("t", [], "id")
    assert DB.column_chunks(list("abcde"), 2) == [["a", "b", "c"], ["d", "e"]]
    assert DB.column_chunks(["a"], 2) == [["a"], []]


HTML = """<html><div class="c-crisiswatch-entry [ o-container ]"><h3> <svg><use href="#deteriorated"></use></svg> Aland/Borland </h3>
<time>March 2019</time><div class="o-crisis-states__detail [ u-ptserif ]">Bad <b>month</b></div></div>
<div class="c-crisiswatch-entry [ o-container ]"><h3>Kashmir <use href="#risk-alert"></use></h3><time>March 2019</time></div>
<div class="c-crisiswatch-entry [ o-container ]"><h3> </h3><time>March 2019</time></div></html>"""


def test_watch_list_pages(spark):
    pages = spark.createDataFrame([(1, HTML), (2, "<html>none</html>")], "id long, html string")
    entries = PG.page_entries(pages, "html", PG.WATCH_LIST, ["id"])
    got = [(r.name, r.date, r.alerts, r.deteriorated, r.unobserved, r.text) for r in entries.collect()]
    assert got == [
        ("Aland/Borland", "March 2019", 0, 1, 0, "Bad month"),
        ("Kashmir", "March 2019", 1, 0, 0, ""),
        ("", "March 2019", 0, 0, 0, ""),
    ]
    clean = PG.clean_entries(entries, [("Kashmir", "India/Pakistan"), ("Borland", "B")], ["Aland"])
    assert sorted(r.name for r in clean.collect()) == ["B", "India", "Pakistan"]
    monthly = PG.entries_per_month(clean, F.to_date("date", "MMMM yyyy"), ["id", "text"])
    assert {(r.year, r.month) for r in monthly.collect()} == {(2019, 3)}


def test_measures_and_imputations(spark, panel):
    raw = spark.createDataFrame([(2000, 1.0, 2.0, "x")], "`Year` int, `V2.X` double, `V2.X_sd` double, `Project` string")
    assert ST.yearly_measures(raw, ["project"]).columns == ["year", "v2_x"]
    df = spark.createDataFrame([(t, g, float(t), float(t * g) if t != 2 else None) for t in range(5) for g in (1, 2)], "t long, g long, a double, b double")
    done = list(imputations(df, panel, 2, "tree", max_iter=1))
    assert len(done) == 2 and all(d.filter("b is null").isEmpty() for d in done)


def test_coarse_grid(spark):
    grid = coarse_grid(spark)
    assert grid.count() == 64800
    assert tuple(grid.filter("parent = 1").select("row", "col", "west", "south").first()) == (0, 0, -180.0, -90.0)
    assert tuple(grid.filter("parent = 64800").select("west", "south").first()) == (179.0, 89.0)


def test_checkpoints_use_the_configured_folder(spark, tmp_path):
    assert cut(spark.range(3)).count() == 3
    assert spark.sparkContext.getCheckpointDir()


def test_rounds_leave_one_copy(spark, panel):
    rows = [(t, g, float(t + g), float(t * g) if (t + g) % 3 else None) for t in range(12) for g in range(4)]
    df = spark.createDataFrame(rows, "t long, g long, a double, b double")
    release(spark)
    out = impute_chained(df, panel, max_iter=10)
    assert len(_made) == 1
    rows = out.collect()
    assert len(rows) == 48 and all(r.b is not None for r in rows)
    folder = _made[0]
    release(spark)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    assert not _made and not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def test_imputations_draw_from_the_posterior(spark, panel):
    rng = random.Random(4)
    rows = []
    for i in range(2000):
        a = rng.gauss(0, 1)
        rows.append((i % 50, i // 50, a, 3 * a + rng.gauss(0, 0.5) if i % 2 else None))
    df = spark.createDataFrame(rows, "t long, g long, a double, b double")
    done = [{(r.t, r.g): (r.a, r.b) for r in d.collect()} for d in imputations(df, panel, 2)]
    gaps = [(t, g) for t, g, _, b in rows if b is None]
    off = [[done[k][key][1] - 3 * done[k][key][0] for key in gaps] for k in (0, 1)]
    for errors in off:
        spread = sum(e * e for e in errors) / len(errors)
        assert 0.2 < spread < 0.32 and abs(sum(errors) / len(errors)) < 0.06
    assert sum(x != y for x, y in zip(*off)) > 0.9 * len(gaps)
    again = {(r.t, r.g): (r.a, r.b) for r in next(imputations(df, panel, 1)).collect()}
    assert all(again[k][1] == pytest.approx(done[0][k][1]) for k in gaps)
