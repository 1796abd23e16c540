import math
import random
import warnings
from pathlib import Path

import pytest
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from panelwright.operators import calibration as C
from panelwright.operators import ensemble as EN
from panelwright.operators import evaluation as E
from panelwright.operators.forecast import Downsampling, combine_steps, permuted, training_frame
from panelwright.operators.model import Ensemble, StepModel
from panelwright.panel import Panel, Period, predict_ranges_disjoint
from panelwright.plans.runs import period_pairs, predict_ensembles, predict_models
from panelwright.sources.versions import versions

A = Period("A", 1, 10, 11, 20)
B = Period("B", 1, 20, 21, 30)
PANEL = Panel("t", "g")


@pytest.fixture(scope="module")
def data(spark):
    """31 times and 8 groups: a 0/1 column that follows a probability, reals, counts."""
    rng = random.Random(1)
    rows = []
    for g in range(8):
        for t in range(31):
            p = rng.random()
            count = rng.randrange(10)
            rows.append((t, g, p, int(rng.random() < 0.2 + 0.6 * p), count, 3.0 * count - 5 + rng.gauss(0, 1)))
    df = spark.createDataFrame(rows, "t long, g long, p_a double, b_a int, c_a int, r_a double")
    return df.persist()


def make(outcome="b_a", kind="prob", estimator=None, **kw):
    return StepModel(
        name=kw.pop("name", "m"),
        col_outcome=outcome,
        cols_features=kw.pop("features", ["p_a", "c_a"]),
        steps=kw.pop("steps", [1, 3, 6]),
        outcome_type=kind,
        periods=kw.pop("periods", [A, B]),
        estimator=estimator,
        panel=PANEL,
        **kw,
    )


# --- scores ----------------------------------------------------------------


def ranked_by_hand(pairs):
    pos = sum(y for y, _ in pairs)
    neg = len(pairs) - pos
    ap = auc = tp = n = 0.0
    for s in sorted({p for _, p in pairs}, reverse=True):
        at = [y for y, p in pairs if p == s]
        auc += (len(at) - sum(at)) * (tp + sum(at) / 2)
        tp, n = tp + sum(at), n + len(at)
        ap += sum(at) / pos * tp / n
    return ap, auc / (pos * neg)


@pytest.mark.parametrize("levels", [2, 7, 1000])
def test_ranked_scores(spark, levels):
    rng = random.Random(levels)
    pairs = [(rng.randrange(2), rng.randrange(levels) / levels) for _ in range(400)]
    df = spark.createDataFrame([(1, *p) for p in pairs] + [(2, 1 - y, p) for y, p in pairs], "k int, actual int, pred double")
    got = {r.k: r for r in E.ranked_scores(df, ["k"]).collect()}
    for k, rows in ((1, pairs), (2, [(1 - y, p) for y, p in pairs])):
        ap, auc = ranked_by_hand(rows)
        assert got[k].average_precision == pytest.approx(ap)
        assert got[k].area_under_roc == pytest.approx(auc)
        assert got[k].brier == pytest.approx(sum((y - p) ** 2 for y, p in rows) / len(rows))


def test_ranked_scores_of_one_class(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.4)], "actual int, pred double")
    row = E.ranked_scores(df).first()
    assert row.average_precision == 0.0 and row.area_under_roc is None


def test_directional_score(spark):
    df = spark.createDataFrame([(1.0, -0.5), (-2.0, 1.0), (0.0, -3.0), (2.0, 1.0), (0.1, -0.1)], "y double, f double")
    y, f = F.col("y"), F.col("f")
    out = df.select(E.tadda(y, f, 1).alias("a"), E.tadda(y, f, 1, smooth=True).alias("b")).collect()
    assert [round(r.a, 9) for r in out] == [2.0, 4.0, 3.0, 1.0, 0.2]
    assert [round(r.b, 9) for r in out] == [2.0, 4.0, 3.0, 1.0, 0.2]
    smooth = spark.createDataFrame([(0.5, -2.0)], "y double, f double").select(E.tadda(y, f, 1, smooth=True)).first()[0]
    assert smooth == pytest.approx(2.5 + abs(2.0 - 0.5))


def test_constant_outcomes(spark):
    hit = spark.createDataFrame([(2.0, 2.0)] * 3, "actual double, pred double")
    miss = spark.createDataFrame([(2.0, 1.0)] * 3, "actual double, pred double")
    assert E.scores_real(hit).first().r2 == 1.0
    assert E.scores_real(miss).first().r2 == 0.0


def test_labels_without_positives(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, f int")
    y, f = F.col("y"), F.col("f")
    assert tuple(df.agg(E.precision(y, f), E.recall(y, f), E.f1_score(y, f)).first()) == (0.0, 0.0, 0.0)


# --- calibration and combination ------------------------------------------


def test_real_calibration_identity_and_scale(spark):
    rng = random.Random(3)
    calib = spark.createDataFrame([(rng.gauss(5, 2), rng.gauss(-3, 7)) for _ in range(200)], "p double, y double")
    out = C.calibrate_real(calib, "p", calib, "p", "y", "c")
    m = out.agg(F.avg("c"), F.stddev_samp("c"), F.avg("y"), F.stddev_samp("y")).first()
    assert m[0] == pytest.approx(m[2]) and m[1] == pytest.approx(m[3])
    calib = spark.createDataFrame([(100.0, 50.0), (200.0, 100.0)], "p double, y double")
    test = spark.createDataFrame([(200.0,), (400.0,)], "p double")
    assert sorted(r.c for r in C.calibrate_real(test, "p", calib, "p", "y", "c").collect()) == [100.0, 200.0]


def test_probability_calibration_checks(spark):
    good = spark.createDataFrame([(0.2, 0), (0.7, 1), (0.4, 1), (0.3, 0), (0.6, 0)], "p double, y int")
    for bad in ((1.2,), (-0.1,), (None,)):
        test = spark.createDataFrame([bad], "p double")
        with pytest.raises(ValueError):
            C.calibrate_prob(test, "p", good, "p", "y", "c")
    with pytest.raises(ValueError):
        C.calibrate_prob(good, "p", good.withColumn("y", F.lit(None).cast("int")), "p", "y", "c")
    flipped = good.withColumn("y", 1 - F.col("y"))
    with pytest.warns(UserWarning):
        C.calibrate_prob(good, "p", flipped, "p", "y", "c")
    out = C.calibrate_prob(good, "p", good, "p", "y", "c")
    assert out.agg(F.avg("c")).first()[0] == pytest.approx(0.4)


def test_separated_outcomes_are_an_error(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 0), (0.8, 1), (0.9, 1)], "p double, y int")
    with pytest.raises(ValueError, match="separated"):
        C.calibrate_prob(df, "p", df, "p", "y", "c")


def test_combined_steps(spark, read):
    df = spark.createDataFrame([(t, g, 1.0, 3.0, 5.0) for g in (1, 2) for t in range(11, 16)], "t long, g long, s1 double, s3 double, s5 double")
    out = combine_steps(df, PANEL, {1: "s1", 3: "s3", 5: "s5"}, Period("P", 1, 10, 11, 15), "sc")
    assert read(out, "sc") == {1: [1, 2, 3, 4, 5], 2: [1, 2, 3, 4, 5]}
    wider = df.unionByName(df.withColumn("t", F.col("t") + 5))
    out = combine_steps(wider, PANEL, {1: "s1", 3: "s3", 5: "s5"}, Period("P", 1, 10, 11, 15), "sc")
    assert read(out, "sc")[1] == [1, 2, 3, 4, 5, None, None, None, None, None]


# --- models ----------------------------------------------------------------


def test_parameters_are_checked():
    with pytest.raises(NotImplementedError):
        make(kind="other")
    with pytest.raises(TypeError):
        make(features=["a", "a"])
    with pytest.raises(TypeError):
        make(onset_outcome=True)
    with pytest.raises(TypeError):
        make(onset_outcome=True, onset_window=3, delta_outcome=True)
    with pytest.raises(TypeError):
        make(kind="real", onset_outcome=True, onset_window=3)
    with pytest.warns(UserWarning):
        make(periods=[Period("a", 1, 1, 2, 5), Period("b", 1, 1, 5, 8)])
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        make()
    assert predict_ranges_disjoint([A, B])


def test_missing_columns(data):
    with pytest.raises(ValueError, match="p_a"):
        make(estimator=LinearRegression()).fit(data.drop("p_a"))
    with pytest.raises(ValueError):
        make(estimator=LinearRegression()).predict(data.drop("c_a"))


def test_features_never_come_from_before_the_training_range(data):
    rows = training_frame(data, PANEL, ["c_a"], "r_a", Period("P", 5, 10, 11, 12), 2)
    assert rows.agg(F.min("t"), F.max("t")).first() == (7, 10)
    assert rows.count() == 8 * 4


def test_probabilities_end_to_end(spark, data, tmp_path):
    model = make(estimator=RandomForestClassifier(numTrees=8, seed=1), steps=[1, 3], downsampling=Downsampling(1.0, 0.8)).fit(data)
    preds = model.predict(data)
    assert preds.columns == ["t", "g", "ss_m_1", "ss_m_3", "sc_m"]
    assert {r.t for r in preds.select("t").distinct().collect()} == set(range(11, 31))
    assert preds.filter("not (sc_m between 0 and 1) or sc_m is null").count() == 0
    with pytest.raises(TypeError):
        model.predict(data, period=A, periods=[A])
    with pytest.warns(UserWarning):
        model.predict(data, period=Period("A", 2, 10, 11, 20))

    calibrated = model.predict_calibrated(data, A, B)
    assert calibrated.columns == ["t", "g", "ss_m_1_calibrated", "ss_m_3_calibrated", "sc_m_calibrated"]
    # More events in the calibration period give higher calibrated probabilities.
    ones = data.withColumn("more", F.when(F.col("g") < 6, 1).otherwise(F.col("b_a")))
    inflated = model.predict_calibrated(ones, A, B, col_outcome="more")
    low, high = (f.agg(F.avg("ss_m_1_calibrated")).first()[0] for f in (calibrated, inflated))
    assert high > low

    joined = data.join(preds, ["t", "g"], "left").join(calibrated, ["t", "g"], "left")
    scores = {(r.period, r.step, r.variant, r.metric): r.value for r in model.evaluate(joined).collect()}
    assert {k[3] for k in scores} == {"average_precision", "area_under_roc", "brier"}
    assert ("B", "sc", "calibrated", "brier") in scores and ("A", "3", "uncalibrated", "brier") in scores
    assert not any(k[0] == "A" and k[2] == "calibrated" for k in scores)

    model.save(spark, str(tmp_path / "m"))
    again = StepModel.load(spark, str(tmp_path / "m"))
    assert again.describe() == model.describe()
    assert again.predict(data).exceptAll(preds).isEmpty()

    importances = model.feature_importances(spark).groupBy("period", "step").agg(F.sum("importance").alias("s")).collect()
    assert len(importances) == 4 and all(r.s == pytest.approx(1.0) for r in importances)


def same_rows(a, b):
    return a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_saved_versions_of_a_forest_and_a_logistic_model(spark, data, tmp_path):
    store = str(tmp_path / "store")
    forest = make(estimator=RandomForestClassifier(numTrees=5, seed=2), steps=[1, 3], tags=["trees"]).fit(data)
    logit = make(estimator=LogisticRegression(), steps=[1, 3]).fit(data)
    with pytest.raises(FileNotFoundError):
        StepModel.load(spark, store)
    first, second = forest.save(spark, store), logit.save(spark, store)
    for model, version in ((forest, first), (logit, second), (logit, None)):
        again = StepModel.load(spark, store, version)
        assert again.describe() == model.describe() and list(again.fitted) == list(model.fitted)
        assert same_rows(again.predict(data), model.predict(data))
        assert same_rows(again.predict_calibrated(data, A, B), model.predict_calibrated(data, A, B))
        learned = "feature_importances" if model is forest else "coefficients"
        assert same_rows(getattr(again, learned)(spark), getattr(model, learned)(spark))


def test_a_version_that_was_not_finished_is_not_loaded(spark, data, tmp_path):
    store = str(tmp_path / "store")
    model = make(estimator=LinearRegression(), outcome="r_a", kind="real", steps=[1], periods=[A]).fit(data)
    whole, half = model.save(spark, store), model.save(spark, store)
    (Path(half) / "manifest" / "_SUCCESS").unlink()
    assert StepModel.load(spark, store).fitted.keys() == model.fitted.keys()
    with pytest.raises(FileNotFoundError, match="no finished version"):
        StepModel.load(spark, store, half)
    assert versions(spark, store) == [whole]
    # The next one follows the half-written one too, and is the latest.
    assert versions(spark, store) + [model.save(spark, store)] == versions(spark, store)
    (Path(whole) / "fitted" / "A").rename(Path(whole) / "fitted" / "gone")
    with pytest.raises(Exception):
        StepModel.load(spark, store, whole)


def test_onset_and_delta_models(data):
    onset = make(estimator=LogisticRegression(), onset_outcome=True, onset_window=2, steps=[1]).fit(data)
    rows = onset.training_frame(data, B, 1)
    assert rows.filter("b_a not in (0, 1)").count() == 0
    assert onset.predict(data).filter("ss_m_1 is null").count() == 0

    delta = make("r_a", "real", LinearRegression(), delta_outcome=True, steps=[1, 3], name="d").fit(data)
    joined = data.join(delta.predict(data), ["t", "g"], "left")
    metrics = {r.metric for r in delta.evaluate(joined).collect()}
    assert metrics == {"mse", "mae", "r2", "tadda_score"}


def test_linear_models_recover_coefficients(spark, data):
    shifted = data.withColumn("target", F.lag("c_a", 1).over(PANEL.window()) * 2.0 + 1)
    model = make("target", "real", LinearRegression(regParam=0.0), features=["c_a"], steps=[1]).fit(shifted)
    got = {r.period: r.coefficient for r in model.coefficients(spark).collect()}
    assert got["A"] == pytest.approx(2.0, abs=1e-6) and got["B"] == pytest.approx(2.0, abs=1e-6)
    imp = model.permutation_importance(shifted, A, 1, repeats=2).collect()
    assert {r.sample for r in imp} == {"train", "test"} and all(r.importance > 0.5 for r in imp)


def test_a_permutation_keeps_values_and_rows(data):
    out = permuted(data.select("t", "g", "c_a", "p_a"), PANEL, ["c_a", "p_a"], 2, seed=3)
    assert out.count() == 2 * 2 * data.count()
    one = out.filter("feature = 'c_a' and repeat = 1")
    assert one.groupBy("c_a").count().exceptAll(data.select(F.col("c_a").cast("double")).groupBy("c_a").count()).isEmpty()
    assert one.select("p_a").exceptAll(data.select("p_a")).isEmpty()
    assert not one.join(data.select("t", "g", F.col("c_a").alias("was")), ["t", "g"]).filter("c_a != was").isEmpty()


# --- runs and ensembles ----------------------------------------------------


def test_runs_and_ensembles(data):
    periods = {"A": Period("A", 0, 10, 11, 15), "B": Period("B", 0, 15, 16, 20), "C": Period("C", 0, 20, 21, 25)}
    used = list(periods.values())
    models = [
        make(name=n, features=f, steps=s, estimator=LogisticRegression(), periods=used).fit(data)
        for n, f, s in (("x", ["p_a"], [1, 2]), ("y", ["p_a", "c_a"], [1, 2, 3]))
    ]
    table = predict_models(models, data, periods)
    assert {r.t for r in table.select("t").distinct().collect()} == set(range(11, 26))
    assert table.filter("ss_x_1 is null").count() == 0
    assert table.filter("ss_x_1_calibrated is not null").agg(F.min("t")).first()[0] == 16

    ensembles = [
        Ensemble("avg", models, "average", "prob", "b_a", used, PANEL),
        Ensemble("ebma", models, "ebma", "prob", "b_a", used, PANEL),
    ]
    assert ensembles[0].steps == [1, 2]
    done = predict_ensembles(ensembles, table, data, periods)
    both = done.filter("t >= 16")
    assert both.filter("ss_avg_1 is null or ss_ebma_2 is null or sc_ebma is null").count() == 0
    gap = F.abs(F.col("ss_avg_1") - (F.col("ss_x_1_calibrated") + F.col("ss_y_1_calibrated")) / 2)
    assert both.filter(gap > 1e-12).count() == 0
    assert ensembles[0].weights["A"][1] == {"x": 0.5, "y": 0.5}
    for by_step in ensembles[1].weights.values():
        for weights in by_step.values():
            assert sum(weights.values()) == pytest.approx(1.0)
    scores = ensembles[1].evaluate(done.join(data.select("t", "g", "b_a"), ["t", "g"]), [periods["C"]])
    assert scores.count() == 3 * 3 * 2

    with pytest.raises(TypeError):
        Ensemble("z", models, "median", "prob", "b_a", used, PANEL)
    with pytest.raises(NotImplementedError):
        Ensemble("z", models, "average", "prob", "b_a", used, PANEL, delta_outcome=True)
    with pytest.raises(ValueError):
        ensembles[0].predict(data, periods["A"], periods["B"])
    with pytest.raises(ValueError):
        period_pairs({"A": A, "B": B})


def test_em_raises_the_likelihood_and_finds_the_better_model(spark):
    rng = random.Random(5)
    rows = []
    for _ in range(600):
        p = rng.random()
        rows.append((int(rng.random() < p), p, rng.random(), 0.5))
    df = spark.createDataFrame(rows, "y int, good double, noise double, flat double").persist()
    cols = ["good", "noise", "flat"]
    likes = [EN.fit_weights(df, cols, "y", tolerance=0.0, max_iter=n, const=0.0)[2] for n in (1, 2, 4, 8)]
    assert likes == sorted(likes)
    fit = EN.fit_ebma(df, cols, "y")
    assert sum(fit.weights) == pytest.approx(1.0) and min(fit.weights) > 0
    # The corrected noise and constant models both say the mean, so the first leads.
    assert fit.weights[0] == max(fit.weights)
    assert fit.predict(df, "e").filter("e <= 0 or e >= 1").count() == 0


def test_logit_without_a_fit(spark):
    fit = lambda rows: C.fit_logit(spark.createDataFrame(rows, "y int, x double"), "y", "x")
    with pytest.raises(ValueError, match="no fit"):
        fit([(int(i > 10), float(i)) for i in range(20)])
    with pytest.raises(ValueError, match="constant"):
        fit([(1, 0.3), (1, 0.6)])
    assert fit([(1, 0.5), (0, 0.5), (1, 0.5), (1, 0.5)]) == (pytest.approx(math.log(3)), 0.0)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ten_steps_in_one_scan_and_fits_without_exchange(spark, data, tmp_path):
    data.select("t", "g", "b_a", "p_a", "c_a").write.parquet(str(tmp_path / "d"))
    saved = spark.read.parquet(str(tmp_path / "d"))
    model = make(estimator=LogisticRegression(), name="s", steps=list(range(1, 11)), periods=[B]).fit(saved)
    plan = plan_of(model.predict(saved, period=B).select("t", "g", *model.cols_ss.values()))
    assert plan.count("Scan parquet") == 1 and "Join" not in plan
    used = saved.repartition("g").sortWithinPartitions("g", "t").persist()
    used.count()
    frame = plan_of(model.training_frame(used, B, 3)).split("InMemoryTableScan")[0]
    assert "Exchange" not in frame and "Sort" not in frame
    used.unpersist()


def test_logits_of_many_pairs_share_their_rounds(spark):
    rng = random.Random(9)
    rows = [[int(rng.random() < 1 / (1 + math.exp(-x)))] + [x * (k + 1) + rng.gauss(0, 1) for k in range(6)] for x in (rng.gauss(0, 1) for _ in range(800))]
    df = spark.createDataFrame(rows, "y int, " + ", ".join(f"x{k} double" for k in range(6)))

    def jobs(pairs):
        spark.sparkContext.setJobGroup(f"g{len(pairs)}", "")
        got = C.fit_logits(df, pairs)
        return got, len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"g{len(pairs)}"))

    one, jobs_one = jobs({"x0": ("y", "x0")})
    six, jobs_six = jobs({f"x{k}": ("y", f"x{k}") for k in range(6)})
    spark.sparkContext.setJobGroup("", "")
    assert six["x0"] == pytest.approx(one["x0"]) and jobs_six <= jobs_one + 6


def test_cross_level(spark):
    high = spark.createDataFrame([(1, 1, 0.2), (1, 1, 0.6), (1, 2, 0.0)], "t long, area long, p double")
    low = spark.createDataFrame([(1, 1, 0.4), (1, 2, 0.3)], "t long, area long, q double")
    out = EN.cross_level(high, low, "t", "area", "p", "q", "j", check=False)
    got = sorted((r.area, r.p, round(r.j, 9)) for r in out.collect())
    assert got == [(1, 0.2, 0.1), (1, 0.6, 0.3), (2, 0.0, 0.2)]
    with pytest.raises(ValueError):
        EN.cross_level(high, low, "t", "area", "p", "q", "j")


def test_cross_level_ensemble(spark, data):
    rows = data.withColumn("area", F.col("g") % 2)
    fine, coarse = make(name="f", steps=[1]), make(name="c", steps=[1])
    frame = rows.select("t", "g", "area", F.col("p_a").alias("ss_f_1"), (F.col("area") * 0.5).alias("ss_c_1"))
    out = Ensemble("x", [fine, coarse], "crosslevel", "prob", "b_a", [B], PANEL, area="area").predict(frame, A, B)
    summed = out.withColumn("area", F.col("g") % 2).groupBy("t", "area").agg(F.sum("ss_x_1").alias("s")).collect()
    assert len(summed) == 20 and all(r.s == pytest.approx(r.area * 0.5) for r in summed)
