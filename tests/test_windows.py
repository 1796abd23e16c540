import pytest
from pyspark.sql import functions as F

from panelwright.functions import scalars as S
from panelwright.functions import windows as W
from panelwright.panel import Panel, drop_nan
from panelwright.plans.transforms import Transform, apply_transforms

# Accepted onsets, and times when one is possible, of events in
# time order, with a window of three.
EVENTS = {
    "g1": [0, 0, 0, 0, 1, 1, 1, 0, 0, 0],
    "g2": [0, 1, 0, 1, 0, 0, 1, 0, 0, 0],
    "g3": [0, 0, 1, 1, 1, 1, 0, 0, 0, 1],
}
POSSIBLE = {
    1: [1, 1, 1, 1, 1, 0, 0, 0, 0, 0],
    2: [1, 1, 0, 0, 0, 0, 0, 0, 0, 0],
    3: [1, 1, 1, 0, 0, 0, 0, 0, 0, 1],
}
ONSET = {
    1: [0, 0, 0, 0, 1, 0, 0, 0, 0, 0],
    2: [0, 1, 0, 0, 0, 0, 0, 0, 0, 0],
    3: [0, 0, 1, 0, 0, 0, 0, 0, 0, 1],
}


def floats(**groups):
    return {g: [None if v is None else float(v) for v in vs] for g, vs in groups.items()}


def test_onset_vectors(series, read, panel):
    df = series(**floats(**EVENTS))
    out = df.select(
        "t", "g", W.onset_possible("s", panel, 3).alias("p"), W.onset("s", panel, 3).alias("o")
    )
    assert read(out, "p") == POSSIBLE
    assert read(out, "o") == ONSET


def test_onset_counts_a_missing_value_as_event(series, read, panel):
    df = series(g1=[0.0, None, 0.0, None])
    assert read(df.select("t", "g", W.onset("s", panel, 1).alias("o")), "o") == {1: [0, 1, 0, 1]}


def test_onset_possible_with_negative_values(series, read, panel):
    df = series(g1=[-1.0, -1.0, -1.0, -1.0])
    out = df.select("t", "g", W.onset_possible("s", panel, 2).alias("p"))
    # While the window still reaches the time before the first row, its zero counts.
    assert read(out, "p") == {1: [1, 1, 0, 0]}


def test_spell_vectors(series, read, panel):
    df = series(g1=[0.0, 0.0, 1.0, 1.0, 0.0, 0.0])
    assert read(W.cweq(df, panel, "s", 0), "cweq") == {1: [1, 2, 0, 0, 1, 2]}
    assert read(W.time_since(df, panel, "s"), "time_since") == {1: [None, 1, 2, 0, 0, 1]}


def test_spells_skip_missing_rows(series, read, panel):
    df = series(g1=[0.0, None, 0.0, 1.0, None, 0.0])
    assert read(W.cweq(df, panel, "s", 0), "cweq") == {1: [1, None, 2, 0, None, 1]}


def test_seed_only_at_the_first_time_of_all_groups(series, spark, read, panel):
    early = series(g1=[0.0, 0.0, 1.0, 0.0], g2=[1.0, 0.0, 0.0, 0.0])
    late = series(start=2, g3=[0.0, 0.0])
    out = W.cweq(early.unionByName(late), panel, "s", 0, seed=10)
    assert read(out, "cweq") == {1: [10, 11, 0, 1], 2: [0, 1, 2, 3], 3: [1, 2]}
    zero = W.cweq(early, panel, "s", 0, seed=0)
    assert read(zero, "cweq") == {1: [1, 2, 0, 1], 2: [0, 1, 2, 3]}


def test_short_windows_and_missing(series, read, panel):
    df = series(g1=[None, 2.0, 4.0, None])
    out = df.select(
        "t",
        "g",
        W.moving_average("s", panel, 2).alias("ma"),
        W.rollmax("s", panel, 2).alias("mx"),
        W.forward_fill_or("s", panel).alias("ff"),
    )
    assert read(out, "ma") == {1: [None, 2.0, 3.0, 4.0]}
    assert read(out, "mx") == {1: [None, 2.0, 4.0, 4.0]}
    assert read(out, "ff") == {1: [0.0, 2.0, 4.0, 4.0]}


@pytest.mark.parametrize("f", [W.tlag, W.tlead, W.moving_average])
def test_time_below_one_is_an_error(spark, panel, f):
    with pytest.raises(ValueError):
        f("s", panel, 0)


def test_indicators_on_missing(series, read, panel):
    df = drop_nan(series(g1=[float("nan"), 1.0, 5.0]))
    out = df.select(
        "t",
        "g",
        S.greq("s", 1).alias("a"),
        S.smeq("s", 1).alias("b"),
        S.in_range("s", 1, 2).alias("c"),
        S.in_range("s", 1, 2, strict_compat=True).alias("d"),
        S.row_sum(["s"]).alias("e"),
        S.row_product(["s"]).alias("f"),
    )
    assert read(out, "a") == {1: [0, 1, 1]}
    assert read(out, "b") == {1: [0, 1, 0]}
    assert read(out, "c") == {1: [0, 1, 0]}
    assert read(out, "d") == {1: [-1, 1, 0]}
    assert read(out, "e") == {1: [0.0, 1.0, 5.0]}
    assert read(out, "f") == {1: [1.0, 1.0, 5.0]}


def test_recode_is_ordered(spark):
    df = spark.createDataFrame([(946,), (970,), (1,)], "c int")
    out = df.select(S.recode("c", [(970, 971), (946, 970)]).alias("r"))
    assert [r.r for r in out.collect()] == [970, 971, 1]
    chained = df.select(S.recode("c", [(946, 970), (970, 971)]).alias("r"))
    assert [r.r for r in chained.collect()] == [971, 971, 1]


def test_grid_and_months(spark):
    df = spark.createDataFrame([(-89.75, -179.75), (-89.25, -179.75), (89.75, 179.75)], "a double, o double")
    cells = df.select(S.grid_id("a", "o").alias("c")).withColumn("p", S.parent_grid_id("c"))
    assert [tuple(r) for r in cells.collect()] == [(1, 1), (721, 1), (259200, 64800)]
    one = spark.range(1).select(S.month_id(F.lit(1980), F.lit(1)), S.month_id(F.lit(2020), F.lit(4)))
    assert tuple(one.first()) == (1, 484)


def test_points_and_odds(spark):
    df = spark.createDataFrame([("POINT(1.5 -2)",), ("",), (None,), ("POLYGON((1 2))",)], "w string")
    got = [r.p for r in df.select(S.point_from_wkt("w").alias("p")).collect()]
    assert (got[0].x, got[0].y) == (1.5, -2.0) and got[1:] == [None, None, None]
    p = spark.createDataFrame([(0.0,), (0.25,), (1.0,)], "p double")
    odds = [r[0] for r in p.select(S.prob_to_odds("p", clipped=False)).collect()]
    assert odds == [0.0, pytest.approx(1 / 3), float("inf")]


def test_transform_specs_are_checked():
    with pytest.raises(KeyError):
        Transform.parse("a", {"col": "s"})
    with pytest.raises(KeyError):
        Transform.parse("a", {"f": "no_such", "col": "s"})
    with pytest.raises(KeyError):
        Transform.parse("a", {"f": "ln"})
    with pytest.raises(TypeError):
        Transform.parse("a", {"f": "ln", "col": 3})
    with pytest.raises(TypeError):
        Transform.parse("a", {"f": "sum", "cols": "s"})


def test_named_transforms_match_the_functions(series, read, panel):
    df = series(**floats(**EVENTS))
    out = apply_transforms(
        df,
        panel,
        {
            "lagged_onset": {"f": "tlag", "col": "onset3", "time": 1},
            "onset3": {"f": "onset", "col": "s", "window": 3},
        },
    )
    assert read(out, "onset3") == ONSET
    assert read(out, "lagged_onset") == {g: [None, *v[:-1]] for g, v in ONSET.items()}
    with pytest.raises(ValueError):
        apply_transforms(df, panel, {"a": {"f": "ln", "col": "nowhere"}})


def test_many_windows_share_one_shuffle_and_sort(spark, panel):
    df = spark.range(1000).select((F.col("id") % 50).alias("g"), F.col("id").alias("t"), F.rand(1).alias("s"))
    lags = df.select("t", "g", *W.lag_bank(["s"], panel, range(1, 40)), W.rollmax("s", panel, 3))
    spells = W.spell_counts(df, panel, [W.Spell(f"o{i}", "s", i, lagged=i % 2 == 0) for i in range(12)])
    for frame in (lags, spells):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
        assert plan.count("Sort [") == 1
