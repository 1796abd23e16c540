import math
import random

import pytest
from pyspark.sql import functions as F

from panelwright.operators import disaggregate as D
from panelwright.operators import events as EV
from panelwright.operators import spatial as SP


def brute(queries, points, k, same_slice, past):
    out = {}
    for key, qx, qy, qt in queries:
        dist = sorted(
            math.dist((qx, qy, qt if past else 0), (x, y, t if past else 0))
            for x, y, t in points
            if (not same_slice or t == qt) and (not past or t <= qt)
        )
        if len(dist) >= k:
            out[key] = sum(dist[:k]) / k
    return out


def points_of(kind, rng):
    if kind == "scattered":
        return [(rng.uniform(-180, 180), rng.uniform(-90, 90), rng.randrange(4)) for _ in range(120)]
    if kind == "clustered":
        near = [(rng.gauss(5, 0.2), rng.gauss(5, 0.2), rng.randrange(4)) for _ in range(80)]
        return near + [(170.0, -80.0, 0), (170.0, -80.0, 3)]
    if kind == "one place":
        return [(3.0, 4.0, rng.randrange(4)) for _ in range(60)]
    return [(float(rng.randrange(12)), float(rng.randrange(12)), rng.randrange(4)) for _ in range(90)]


@pytest.mark.parametrize("kind", ["scattered", "clustered", "one place", "grid"])
@pytest.mark.parametrize("k", [1, 4])
@pytest.mark.parametrize("past", [False, True])
def test_nearest_distance_is_exact(spark, kind, k, past):
    rng = random.Random(f"{kind}{k}{past}")
    points = points_of(kind, rng)
    queries = [(i, rng.uniform(-180, 180), rng.uniform(-90, 90), i % 4) for i in range(80)]
    queries += [(80 + i, x, y, t) for i, (x, y, t) in enumerate(points[:20])]
    q = spark.createDataFrame([(i, x, y, float(t)) for i, x, y, t in queries], "i long, x double, y double, z double")
    p = spark.createDataFrame([(x, y, float(t)) for x, y, t in points], "x double, y double, z double")
    if past:
        got = SP.nearest_distance(q, p, ["i"], ["x", "y", "z"], k=k, causal="z")
    else:
        got = SP.nearest_distance(q, p, ["i"], ["x", "y"], ["z"], k=k)
    got = {r.i: r.distance for r in got.collect()}
    want = brute(queries, points, k, not past, past)
    assert got.keys() == want.keys()
    for i, d in want.items():
        assert got[i] == pytest.approx(d, abs=1e-9)


def test_distance_fill_and_infinity(spark, panel):
    rows = [(t, g, float(g), 0.0, int((t, g) in {(2, 1), (3, 1), (3, 2), (3, 3)})) for t in (1, 2, 3) for g in range(4)]
    df = spark.createDataFrame(rows, "t long, g long, x double, y double, e int")
    out = {(r.t, r.g): r.spdist for r in SP.distance_to_event(df, panel, "e", "x", "y", k=2, cell=1.0).collect()}
    assert all(out[1, g] == 99 for g in range(4))
    assert all(out[2, g] == math.inf for g in range(4))
    assert out[3, 0] == pytest.approx(1.5) and out[3, 2] == pytest.approx(0.5)
    st = SP.spacetime_distance_to_event(df, panel, "e", "x", "y", k=1, cell=1.0)
    st = {(r.t, r.g): r.stdist for r in st.collect()}
    # At time 2 there is one event, and more than k are asked for.
    assert st[2, 0] == 99 and st[3, 0] == pytest.approx(1.0)


def test_no_events_at_all(spark, panel):
    df = spark.createDataFrame([(1, 1, 0.0, 0.0, 0)], "t long, g long, x double, y double, e int")
    assert SP.distance_to_event(df, panel, "e", "x", "y").first().spdist == 99
    assert SP.spacetime_distance_to_event(df, panel, "e", "x", "y").first().stdist == 99


def test_spatial_sum_rules(spark, panel):
    adjacency = spark.createDataFrame([(1, 2), (2, 1), (2, 3), (3, 2)], "g long, n long")
    df = spark.createDataFrame(
        [(1, 1, 1.0), (1, 2, 2.0), (1, 3, None), (1, 4, 8.0), (2, 1, 1.0), (2, 3, 5.0)], "t long, g long, v double"
    )
    out = {(r.t, r.g): r.splag for r in SP.spatial_lag(df, panel, adjacency, "v").collect()}
    assert out == {(1, 1): 2.0, (1, 2): None, (1, 3): 2.0, (1, 4): 0.0, (2, 1): None, (2, 3): None}


def test_rings_on_a_line(spark):
    line = [(i, i + 1) for i in range(9)]
    adjacency = spark.createDataFrame(line + [(b, a) for a, b in line], "g long, n long")
    pairs = {tuple(r) for r in SP.neighbours_of_order(adjacency, 2, 3).collect()}
    assert pairs == {(a, b, abs(a - b)) for a in range(10) for b in range(10) if abs(a - b) in (2, 3)}
    with pytest.raises(ValueError):
        SP.neighbours_of_order(adjacency, 0, 1)


def test_violence_type_rules(spark):
    rows = [
        ("Battle-Clash", "Military Forces of X", "Rebels"),
        ("Remote violence", "Rebels", "Militia"),
        ("Violence against civilians", "Rebels", "Civilians (X)"),
        ("Battle", "Military Forces", "Civilians"),
        ("Riots/Protests", "a", "b"),
        ("Battle", "Military Forces", None),
    ]
    df = spark.createDataFrame(rows, "e string, a string, b string")
    kinds = [r[0] for r in df.select(EV.violence_type(F.col("e"), F.col("a"), F.col("b"))).collect()]
    assert kinds == [1, 2, 3, 3, 4, None]


def test_draws_follow_the_weights(spark):
    cells = spark.createDataFrame([(1, c) for c in range(5)], "area long, cell long")
    exact = spark.createDataFrame([(1, 1, 10, 3), (2, 1, 9, 3), (3, 1, 10, 4)], "id long, conflict long, month long, cell long")
    vague = spark.range(100, 2100).select("id", F.lit(1).cast("long").alias("area"), F.lit(1).cast("long").alias("conflict"), F.lit(10).cast("long").alias("month"))
    drawn = D.draw_cells(vague, exact, cells)
    assert drawn.count() == 2000 * 15
    counts = {r.cell: r["count"] for r in drawn.groupBy("cell").count().collect()}
    weight = {c: D.BASE_WEIGHT for c in range(5)}
    weight[3] += 99 + 99 * 2 ** (-1 / 12)
    weight[4] += 99
    total = sum(weight.values())
    for c in range(5):
        assert counts[c] / 30000 == pytest.approx(weight[c] / total, abs=0.012)
    assert drawn.exceptAll(D.draw_cells(vague, exact, cells)).isEmpty()


def test_draws_without_any_located_event(spark):
    cells = spark.createDataFrame([(1, 7), (1, 8)], "area long, cell long")
    exact = spark.createDataFrame([], "id long, conflict long, month long, cell long")
    vague = spark.createDataFrame([(5, 1, 1, 3)], "id long, area long, conflict long, month long")
    drawn = D.draw_cells(vague, exact, cells, draws=40)
    assert drawn.count() == 40
    assert {r.cell for r in drawn.select("cell").distinct().collect()} == {7, 8}


@pytest.mark.parametrize("k", [1, 3])
def test_few_events_in_a_long_time_keep_few_buckets(spark, monkeypatch, k):
    rng = random.Random(k)
    points = [(rng.randrange(15) + 0.5, rng.randrange(15) + 0.5, float(rng.randrange(400))) for _ in range(70)]
    points += [(3.5, 3.5, float(z)) for z in range(0, 400, 9)] + [(9.0 + i / 100, 9.0, 350.0) for i in range(60)]
    queries = [(i, rng.randrange(15) * 1.0, rng.randrange(15) * 1.0, rng.randrange(20, 400) * 1.0) for i in range(400)]
    kept, walk = [], SP._walk

    def counting(*args):
        for found in walk(*args):
            per_query = found.groupBy("i").count().agg({"count": "avg"}).first()[0]
            kept.append(per_query)
            yield found

    monkeypatch.setattr(SP, "_walk", counting)
    q = spark.createDataFrame(queries, "i int, x double, y double, z double")
    p = spark.createDataFrame(points, "x double, y double, z double")
    got = {r.i: r.distance for r in SP.nearest_distance(q, p, ["i"], ["x", "y", "z"], k=k, causal="z").collect()}
    for i, *at in queries:
        near = sorted(math.dist(at, e) for e in points if e[2] <= at[2])
        if len(near) < k:
            assert i not in got
        else:
            assert got[i] == pytest.approx(sum(near[:k]) / k, abs=1e-9)
    assert max(kept) < 10
