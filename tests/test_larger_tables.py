"""What small tables do not show: more users than a globe has cells, sums on a
threshold, hot keys."""

import datetime
import math

import numpy as np

import __spark_entry__ as entry
from panelwright.functions.scalars import steady_sum
from panelwright.operators import disaggregate as D
from panelwright.operators import ensemble as EN
from panelwright.operators import spatial as SP
from panelwright.operators.ranking import uniform
from panelwright.workload.base import Tables
from panelwright.workload.frames import full_panel


def events_in(folder, spark, rows):
    """An events table of (user_id, day, event_type, value) rows in their order."""
    start = datetime.datetime(2024, 1, 1, 12)
    full = [(i, start + datetime.timedelta(days=d), u, kind, v) for i, (u, d, kind, v) in enumerate(rows)]
    df = spark.createDataFrame(full, "event_id long, ts timestamp, user_id long, event_type string, value double")
    df.coalesce(1).write.parquet(f"{folder}/events.parquet")
    return str(folder)


def test_users_beyond_the_globe_keep_their_cell(spark, tmp_path):
    # Row 90 of the users' grid is the first one north of the pole.
    folder = events_in(tmp_path, spark, [(u, 0, "view", 1.0) for u in (0, 1349, 1350, 90_000)])
    got = {(r.row, r.col, r.west, r.south, r.users) for r in entry.queries()["fishnet_with_users"](spark, folder).collect()}
    assert got == {
        (90, 180, 0.0, 0.0, 1), (179, 194, 14.0, 89.0, 1), (180, 180, 0.0, 90.0, 1), (6090, 180, 0.0, 6000.0, 1)
    }


def test_a_sum_on_a_threshold_does_not_depend_on_the_order(spark, tmp_path):
    # 40 in all, but 39.99999999999999 if they are added up in this order.
    values = [10.12, 15.43, 0.33, 14.12]
    rows = [(u, 0, "view", v) for u, order in enumerate((values, values[::-1])) for v in order]
    folder = events_in(tmp_path, spark, rows)
    got = entry.queries()["transform_indicators"](spark, folder).collect()
    assert {(r.g, r.greq, r.inside) for r in got} == {(0, 1, 1), (1, 1, 1)}


def test_steady_sum_of_other_values(spark):
    rows = [
        ("none", None), ("one", 2.5), ("one", None), ("fine", 1e-7), ("fine", 1.0), ("huge", 1e300), ("huge", 1.0),
        ("inf", float("inf")), ("inf", 1.0), ("long", 9e10), ("nan", float("nan")), ("less", -0.1), ("less", -0.2),
    ]
    rows += [("long", 9e10)] * 12_000
    got = dict(spark.createDataFrame(rows, "k string, v double").groupBy("k").agg(steady_sum("v")).collect())
    assert got.pop("nan") != got.get("nan")
    assert got == {
        "none": None, "one": 2.5, "fine": 1.0000001, "huge": 1e300, "inf": float("inf"), "long": 9e10 * 12_001, "less": -0.3
    }


def test_queries_are_dealt_out_by_their_number(spark, panel, monkeypatch):
    # A day's cells in tasks of ten, however few bytes they are.
    monkeypatch.setattr(SP, "TASK_QUERIES", 10)
    rows = [(1, g, float(g % 20), float(g // 20), int(g % 50 == 7)) for g in range(400)]
    df = spark.createDataFrame(rows, "t long, g long, x double, y double, e int")
    out = SP.distance_to_event(df, panel, "e", "x", "y", k=3, cell=1.0)
    assert "40), REPARTITION_BY_NUM" in out._jdf.queryExecution().toString()
    places = [(x, y) for _, _, x, y, e in rows if e]
    for r in out.collect():
        x, y = r.g % 20, r.g // 20
        assert abs(r.spdist - sum(sorted(math.dist((x, y), p) for p in places)[:3]) / 3) < 1e-9


def test_a_task_has_few_queries(spark):
    # Of a query three points in space and time keep a score of buckets.
    queries = spark.range(200_000).selectExpr("id AS i", "id % 7 + 0e0 AS x", "id % 5 + 0e0 AS y", "9e0 AS z")
    points = spark.createDataFrame([(x + 0.5, 2.0, 1.0) for x in range(5)], "x double, y double, z double")
    out = SP.nearest_distance(queries, points, ["i"], ["x", "y", "z"], k=3, cell=1.0, causal="z")
    assert "10), REPARTITION_BY_NUM" in out._jdf.queryExecution().toString()


def test_an_unfolded_skeleton_is_not_broadcast(spark, tmp_path):
    # A filter on counts makes the join an inner one, either side of which may be sent.
    folder = events_in(tmp_path, spark, [(u, u % 9, "purchase", 1.0) for u in range(50) for _ in range(3)])
    days = full_panel(Tables(spark, folder)).filter("n_purchase >= 3")
    assert {(r.t, r.g) for r in days.collect()} == {(u % 9, u) for u in range(50)}
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert "Inner" in plan and "BroadcastHashJoin" not in plan


def test_draws_are_combined_before_they_are_shuffled(spark, tmp_path):
    kinds = ["error", "signup", "signup"]
    folder = events_in(tmp_path, spark, [(i % 25, i % 9, kinds[i % 3], float(i % 60)) for i in range(90)])
    plan = entry.queries()["imputed_dummies"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in plan.splitlines() if "hashpartitioning(" in line]
    assert shuffled and not any("draw#" in line.split("hashpartitioning(")[1].split(")")[0] for line in shuffled)


def test_dummies_of_events_are_those_of_their_placed_draws(spark):
    # Ids twice and in both sets, unknown ids, kinds and conflicts, draws of two words.
    cells = spark.createDataFrame([(c // 4, c) for c in range(12)], "area long, cell long")
    vague = [(i, i % 4, i % 3 if i % 7 else None, 5 + i % 5) for i in range(60)] + [(3, 3, 0, 8), (3, 1, 2, 6)]
    vague = spark.createDataFrame(vague, "id long, area long, conflict long, month long")
    exact = [(i, i % 3, 4 + i % 6, i % 13) for i in range(50, 90)] + [(50, 2, 6, 11)]
    exact = spark.createDataFrame(exact, "id long, conflict long, month long, cell long")
    events = [(i, [1, 2, 3, None][i % 4], i % 5, i % 5 + 2) for i in range(5, 85)] + [(9, 2, 4, 9), (55, 1, 1, 1)]
    events = spark.createDataFrame(events, "id long, kind int, month_start long, month_end long")
    kinds = {"small": 1, "large": 2}
    placed = D.assemble_draws(D.draw_cells(vague, exact, cells, 40), exact, 40)
    want = {}
    joined = placed.join(events, "id").withColumn("u", uniform("id", "draw", "kind", 1))
    for r in joined.collect():
        month = r.month_start + math.floor(r.u * (r.month_end - r.month_start + 1))
        want.setdefault((r.draw, r.cell, month), set()).add(r.kind)
    want = {k: tuple(max((int(v == c) for v in s if v), default=None) for c in (1, 2)) for k, s in want.items()}
    for got in (D.dummies_of_events(vague, exact, cells, events, kinds, 40), D.imputed_dummies(placed, events, kinds)):
        rows = got.collect()
        assert {(r.draw, r.cell, r.month): (r.dummy_small, r.dummy_large) for r in rows} == want and len(rows) == len(want)
    some = {tuple(r) for r in D.dummies_of_events(vague, exact, cells, events, kinds, [3, 36]).collect()}
    assert some == {(*k, *v) for k, v in want.items() if k[0] in (3, 36)}


def test_rounds_of_em_share_passes(spark, monkeypatch):
    # The rounds, weights and likelihood of plain EM, from far fewer passes.
    rng = np.random.default_rng(3)
    y = (rng.random(400) < 0.4).astype(float)
    p = np.clip(np.stack([0.3 * y + 0.2 + 0.3 * rng.random(400), rng.random(400), 0.4 + 0.1 * rng.random(400)]), 0.01, 0.99)
    g, w, before = np.where(y == 1, p, 1 - p), np.ones(3) / 3, None
    for rounds in range(1, 10_000):
        parts = w[:, None] * g
        like = np.log(parts.sum(0)).sum()
        w = (EN.EBMA_CONST / 3 + (1 - EN.EBMA_CONST) * parts / parts.sum(0)).mean(1)
        if before is not None and abs(like - before) < 1e-6:
            break
        before = like
    passes, sums = [], EN.em_sums
    monkeypatch.setattr(EN, "em_sums", lambda *a: passes.append(1) or sums(*a))
    df = spark.createDataFrame([(*map(float, r),) for r in np.vstack([y, p]).T], "y double, a double, b double, c double")
    weights, got, likely = EN.fit_weights(df, ["a", "b", "c"], "y", tolerance=1e-6)
    assert got == rounds and len(passes) < rounds / 3
    assert np.allclose(weights, w, atol=1e-9) and abs(likely - like) < 1e-7
