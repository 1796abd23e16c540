"""Queries for step-ahead models, runs and ensembles."""

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from panelwright.lineage import scratch_folder
from panelwright.operators import ensemble as EN
from panelwright.operators import forecast as FC
from panelwright.operators.model import Ensemble, StepModel
from panelwright.panel import Period
from panelwright.plans.runs import predict_ensembles, predict_models
from panelwright.workload.base import query
from panelwright.workload.frames import (
    PANEL,
    PERIOD_A,
    PERIOD_B,
    PERIOD_C,
    full_panel,
    outcome_frame,
)
from panelwright.workload.gaps import interpolation_sql
from panelwright.workload.scoring import newton_sql

FEATURES = ["n_events", "n_purchase", "value_max"]
STEPS = [1, 3]
PERIODS = {"A": PERIOD_A, "B": PERIOD_B, "C": PERIOD_C}


# --- frames ----------------------------------------------------------------

LAGS = "lag(n_events, 3) OVER w AS n_events, lag(n_purchase, 3) OVER w AS n_purchase, lag(value_max, 3) OVER w AS value_max"


@query(
    "training_rows",
    "MO1",
    "t:l g:l n_events:l n_purchase:l value_max:d n_error:l",
    f"""SELECT * FROM (SELECT t, g, {LAGS}, n_error FROM full_panel WHERE t BETWEEN 0 AND 14
         WINDOW w AS (PARTITION BY g ORDER BY t)) WHERE n_events IS NOT NULL AND value_max IS NOT NULL""",
    ["full_panel"],
)
def _(t):
    return FC.training_frame(full_panel(t), PANEL, FEATURES, "n_error", PERIOD_B, 3)


@query(
    "training_rows_of_deltas",
    ("MO1", "W3"),
    "t:l g:l n_events:l n_error:l",
    """SELECT * FROM (SELECT t, g, lag(n_events, 2) OVER w AS n_events, n_error - lag(n_error, 2) OVER w AS n_error
         FROM full_panel WHERE t BETWEEN 0 AND 14 WINDOW w AS (PARTITION BY g ORDER BY t))
       WHERE n_events IS NOT NULL AND n_error IS NOT NULL""",
    ["full_panel"],
)
def _(t):
    return FC.training_frame(
        full_panel(t), PANEL, ["n_events"], "n_error", PERIOD_B, 2, is_delta=True
    )


@query(
    "training_rows_of_onsets",
    ("MO1", "P15", "M9"),
    "t:l g:l n_events:l n_purchase:l",
    """WITH rows AS (SELECT * FROM (SELECT t, g, lag(n_events) OVER w AS n_events, (n_purchase <> 0)::INT AS n_purchase,
           max(n_purchase) OVER (PARTITION BY g ORDER BY t ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING) AS before
         FROM full_panel WHERE t BETWEEN 0 AND 14 WINDOW w AS (PARTITION BY g ORDER BY t))
         WHERE n_events IS NOT NULL AND coalesce(before, 0) = 0)
       SELECT t, g, n_events, n_purchase FROM (SELECT *, row_number() OVER (PARTITION BY n_purchase ORDER BY md5(t || '|' || g || '|1')) AS r,
         count(*) OVER (PARTITION BY n_purchase) AS n FROM rows) WHERE r <= floor(CASE WHEN n_purchase = 0 THEN 0.5e0 ELSE 1e0 END * n)""",
    ["full_panel"],
)
def _(t):
    return FC.training_frame(
        full_panel(t),
        PANEL,
        ["n_events"],
        "n_purchase",
        PERIOD_B,
        1,
        onset_window=2,
        downsampling=FC.Downsampling(1.0, 0.5),
    )


def _formula(rows):
    """A scorer that is a plain formula, so that SQL can follow it."""
    of = lambda step: F.col("n_events") * 2 + F.col("value_max") / (F.lit(10.0) + step) - F.col("n_purchase")
    return rows, {s: of(s) for s in STEPS}


STEPWISE = """SELECT k.t, k.g, a.p AS ss_m_1, b.p AS ss_m_3 FROM (SELECT t, g FROM full_panel WHERE t BETWEEN 15 AND 19) k
    LEFT JOIN (SELECT t + 1 AS t, g, n_events * 2 + value_max / 11e0 - n_purchase AS p FROM full_panel WHERE value_max IS NOT NULL) a
      ON a.t = k.t AND a.g = k.g
    LEFT JOIN (SELECT t + 3 AS t, g, n_events * 2 + value_max / 13e0 - n_purchase AS p FROM full_panel WHERE value_max IS NOT NULL) b
      ON b.t = k.t AND b.g = k.g"""

NAMES = {1: "ss_m_1", 3: "ss_m_3"}


@query(
    "predictions_by_step", "MO3", "t:l g:l ss_m_1:d ss_m_3:d", STEPWISE, ["full_panel"]
)
def _(t):
    return FC.step_predictions(full_panel(t), PANEL, FEATURES, PERIOD_B, STEPS, _formula, NAMES)


@query(
    "predictions_combined",
    "MO4",
    "t:l g:l ss_m_1:d ss_m_3:d sc_m:d",
    interpolation_sql(
        f"SELECT *, CASE t WHEN 15 THEN ss_m_1 WHEN 17 THEN ss_m_3 END AS sc_m FROM ({STEPWISE})",
        ["sc_m"],
        ", ss_m_1, ss_m_3",
    ),
    ["full_panel"],
)
def _(t):
    rows = FC.step_predictions(full_panel(t), PANEL, FEATURES, PERIOD_B, STEPS, _formula, NAMES)
    return FC.combine_steps(rows, PANEL, NAMES, PERIOD_B, "sc_m")


# --- fitted models ---------------------------------------------------------


def _linear(t, periods=(PERIOD_B, PERIOD_C), name="lin", features=FEATURES, outcome="n_error"):
    model = StepModel(
        name=name,
        col_outcome=outcome,
        cols_features=list(features),
        steps=list(STEPS),
        outcome_type="real",
        periods=list(periods),
        estimator=LinearRegression(regParam=0.0, solver="normal"),
        panel=PANEL,
    )
    return model.fit(full_panel(t))


def _forest(t, periods=(PERIOD_B, PERIOD_C)):
    rows = _with_flag(t)
    model = StepModel(
        name="rf",
        col_outcome="flag",
        cols_features=FEATURES,
        steps=list(STEPS),
        outcome_type="prob",
        periods=list(periods),
        estimator=RandomForestClassifier(numTrees=10, maxDepth=4, seed=1),
        panel=PANEL,
    )
    return model.fit(rows), rows


def _with_flag(t):
    return full_panel(t).select(
        "t",
        "g",
        (F.col("n_error") > 0).cast("int").alias("flag"),
        "n_events",
        "n_purchase",
        F.coalesce("value_max", F.lit(0.0)).alias("value_max"),
    )


OLS = """SELECT period, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM (
    SELECT 'B' AS period, n_error AS y, lag(n_events, 2) OVER (PARTITION BY g ORDER BY t) AS x FROM full_panel WHERE t <= 14
    UNION ALL SELECT 'C', n_error, lag(n_events, 2) OVER (PARTITION BY g ORDER BY t) FROM full_panel WHERE t <= 19) GROUP BY 1"""


def _simple_linear(t):
    model = StepModel(
        name="ols",
        col_outcome="n_error",
        cols_features=["n_events"],
        steps=[2],
        outcome_type="real",
        periods=[PERIOD_B, PERIOD_C],
        estimator=LinearRegression(regParam=0.0, solver="normal"),
        panel=PANEL,
    )
    return model.fit(full_panel(t))


@query(
    "linear_model_predictions",
    ("MO2", "MO5", "U2"),
    "t:l g:l ss_ols_2:d sc_ols:d",
    f"""SELECT t, g, p AS ss_ols_2, first_value(p) OVER (PARTITION BY g, period ORDER BY (t = mid) DESC) AS sc_ols FROM (
         SELECT k.t, k.g, c.period, c.mid, c.a + c.b * x.n_events AS p
         FROM (SELECT t, g, CASE WHEN t <= 19 THEN 'B' ELSE 'C' END AS period FROM full_panel WHERE t BETWEEN 15 AND 24) k
         JOIN (SELECT *, CASE period WHEN 'B' THEN 16 ELSE 21 END AS mid FROM ({OLS})) c ON c.period = k.period
         JOIN full_panel x ON x.t = k.t - 2 AND x.g = k.g)""",
    ["full_panel"],
)
def _(t):
    return _simple_linear(t).predict(full_panel(t))


@query(
    "linear_model_coefficients",
    "MO9",
    "period:s step:l feature:s coefficient:d",
    f"SELECT period, 2 AS step, 'n_events' AS feature, b AS coefficient FROM ({OLS})",
    ["full_panel"],
)
def _(t):
    return _simple_linear(t).coefficients(t.spark)


@query(
    "linear_model_calibrated",
    "C3",
    "t:l g:l ss_ols_2_calibrated:d sc_ols_calibrated:d",
    f"""WITH scored AS (SELECT k.t, k.g, k.n_error, c.a + c.b * x.n_events AS p, c.period FROM full_panel k
         JOIN ({OLS}) c ON c.period = CASE WHEN k.t <= 19 THEN 'B' ELSE 'C' END
         JOIN full_panel x ON x.t = k.t - 2 AND x.g = k.g WHERE k.t BETWEEN 15 AND 24),
        fit AS (SELECT avg(n_error) AS ma, avg(p) AS mp, stddev_samp(n_error) / stddev_samp(p) AS r FROM scored WHERE t <= 19),
        done AS (SELECT t, g, ma + (p - mp) * r AS q FROM scored, fit WHERE t >= 20)
       SELECT t, g, q AS ss_ols_2_calibrated, first_value(q) OVER (PARTITION BY g ORDER BY t = 21 DESC) AS sc_ols_calibrated FROM done""",
    ["full_panel"],
)
def _(t):
    return _simple_linear(t).predict_calibrated(full_panel(t), PERIOD_B, PERIOD_C)


@query(
    "forest_predictions",
    ("MO2", "MO3", "MO5"),
    "t:l g:l inside:l ss_rf_1:d ss_rf_3:d sc_rf:d",
)
def _(t):
    model, rows = _forest(t)
    return model.predict(rows).withColumn(
        "inside", F.col("sc_rf").between(0, 1).cast("int")
    )


@query(
    "forest_rows_and_range",
    ("MO2", "MO5"),
    "rows:l inside:l",
    "SELECT count(*) AS rows, count(*) AS inside FROM full_panel WHERE t BETWEEN 15 AND 24",
    ["full_panel"],
)
def _(t):
    model, rows = _forest(t)
    inside = F.col("sc_rf").between(0, 1) & F.col("ss_rf_1").between(0, 1)
    return model.predict(rows).agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.when(inside, 1)).alias("inside")
    )


@query("forest_importances", "MO8", "period:s step:l feature:s importance:d")
def _(t):
    model, _rows = _forest(t)
    return model.feature_importances(t.spark)


@query(
    "forest_importances_sum_to_one",
    "MO8",
    "period:s step:l features:l total:d",
    """SELECT period, step, 3 AS features, 1e0 AS total FROM (SELECT unnest(['B', 'C']) AS period)
       CROSS JOIN (SELECT unnest([1, 3]) AS step) WHERE (SELECT count(*) FROM full_panel) > 0""",
    ["full_panel"],
)
def _(t):
    model, _rows = _forest(t)
    return (
        model.feature_importances(t.spark)
        .groupBy("period", "step")
        .agg(F.count(F.lit(1)).alias("features"), F.sum("importance").alias("total"))
    )


@query(
    "permutation_importance",
    "MO10",
    "feature:s sample:s importance:d",
    f"""WITH fit AS (SELECT a, b FROM ({OLS}) WHERE period = 'B'),
        shifted AS (SELECT t, g, n_error AS y, lag(n_events, 2) OVER (PARTITION BY g ORDER BY t) AS x FROM full_panel),
        rows AS MATERIALIZED (SELECT *, CASE WHEN t <= 14 THEN 'train' ELSE 'test' END AS sample FROM shifted WHERE x IS NOT NULL AND t <= 19),
        placed AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY md5(t || '|' || g || '|1')) AS place FROM rows),
        vals AS (SELECT sample, repeat, x, row_number() OVER (PARTITION BY sample, repeat
            ORDER BY md5(t || '|' || g || '|n_events|' || repeat || '|1')) AS place
          FROM rows CROSS JOIN (SELECT unnest(range(10)) AS repeat)),
        scored AS (SELECT p.sample, v.repeat, 1 - sum(pow(y - (a + b * v.x), 2)) / (var_pop(y) * count(*)) AS r2
          FROM placed p JOIN vals v ON v.sample = p.sample AND v.place = p.place, fit GROUP BY 1, 2),
        base AS (SELECT sample, 1 - sum(pow(y - (a + b * x), 2)) / (var_pop(y) * count(*)) AS r2 FROM rows, fit GROUP BY 1)
       SELECT 'n_events' AS feature, base.sample, min(base.r2) - avg(scored.r2) AS importance
       FROM base JOIN scored ON scored.sample = base.sample GROUP BY 2""",
    ["full_panel"],
)
def _(t):
    return _simple_linear(t).permutation_importance(full_panel(t), PERIOD_B, 2)


@query(
    "values_permuted",
    "MO10",
    "t:l g:l repeat:l n_events:d",
    """SELECT p.t, p.g, v.repeat, v.n_events FROM
        (SELECT t, g, row_number() OVER (ORDER BY md5(t || '|' || g || '|1')) AS place FROM full_panel) p
       JOIN (SELECT repeat, n_events, row_number() OVER (PARTITION BY repeat ORDER BY md5(t || '|' || g || '|n_events|' || repeat || '|1')) AS place
         FROM full_panel CROSS JOIN (SELECT unnest([0, 1]) AS repeat)) v ON v.place = p.place""",
    ["full_panel"],
)
def _(t):
    rows = full_panel(t).select("t", "g", "n_events")
    return FC.permuted(rows, PANEL, ["n_events"], 2, seed=1)


@query(
    "forest_of_one_split",
    ("MO2", "MO3"),
    "t:l g:l ss_stump_2:d",
    """WITH train AS MATERIALIZED (SELECT n_error AS y, x FROM (SELECT n_error, lag(n_events, 2) OVER (PARTITION BY g ORDER BY t) AS x
          FROM full_panel WHERE t <= 14) WHERE x IS NOT NULL),
        cuts AS (SELECT (x + lead(x) OVER (ORDER BY x)) / 2e0 AS cut FROM (SELECT DISTINCT x FROM train)),
        best AS (SELECT cut, avg(y) FILTER (x <= cut) AS low, avg(y) FILTER (x > cut) AS high FROM train, cuts WHERE cut IS NOT NULL
          GROUP BY cut ORDER BY var_pop(y) FILTER (x <= cut) * count(*) FILTER (x <= cut) + var_pop(y) FILTER (x > cut) * count(*) FILTER (x > cut), cut LIMIT 1)
       SELECT k.t, k.g, CASE WHEN f.n_events <= cut THEN low ELSE high END AS ss_stump_2
       FROM full_panel k JOIN full_panel f ON f.g = k.g AND f.t = k.t - 2, best WHERE k.t BETWEEN 15 AND 19""",
    ["full_panel"],
)
def _(t):
    return _stump(t, ["n_events"]).predict(full_panel(t), period=PERIOD_B)


def _stump(t, features):
    """One tree of one split on features of few values: SQL can search the cut."""
    return StepModel(
        name="stump",
        col_outcome="n_error",
        cols_features=features,
        steps=[2],
        outcome_type="real",
        periods=[PERIOD_B],
        estimator=RandomForestRegressor(numTrees=1, maxDepth=1, bootstrap=False, featureSubsetStrategy="all", maxBins=256),
        panel=PANEL,
    ).fit(full_panel(t))


@query(
    "importances_of_one_split",
    "MO8",
    "period:s step:l feature:s importance:d",
    """WITH train AS (SELECT n_error AS y, lag(n_events, 2) OVER w AS n_events, lag(n_purchase, 2) OVER w AS n_purchase
          FROM full_panel WHERE t <= 14 WINDOW w AS (PARTITION BY g ORDER BY t)),
        long AS MATERIALIZED (SELECT y, name, x FROM (FROM train UNPIVOT (x FOR name IN (n_events, n_purchase)))),
        cuts AS (SELECT name, (x + lead(x) OVER (PARTITION BY name ORDER BY x)) / 2e0 AS cut FROM (SELECT DISTINCT name, x FROM long)),
        errors AS (SELECT l.name, cut, var_pop(y) FILTER (x <= cut) * count(*) FILTER (x <= cut) + var_pop(y) FILTER (x > cut) * count(*) FILTER (x > cut) AS e
          FROM long l JOIN cuts c ON c.name = l.name WHERE cut IS NOT NULL GROUP BY 1, 2),
        best AS (SELECT name FROM errors ORDER BY e, name, cut LIMIT 1)
       SELECT 'B' AS period, 2 AS step, n.name AS feature, (n.name = best.name)::INT AS importance
       FROM (SELECT unnest(['n_events', 'n_purchase']) AS name) n, best""",
    ["full_panel"],
)
def _(t):
    return _stump(t, ["n_events", "n_purchase"]).feature_importances(t.spark)


@query(
    "model_saved_and_loaded",
    "MO7",
    "t:l g:l same:l",
    "SELECT t, g, 1 AS same FROM full_panel WHERE t BETWEEN 15 AND 24",
    ["full_panel"],
)
def _(t):
    model = _simple_linear(t)
    folder = scratch_folder(t.spark, "model")
    model.save(t.spark, folder)
    again = StepModel.load(t.spark, folder)
    rows = full_panel(t)
    both = model.predict(rows).join(
        again.predict(rows).withColumnRenamed("sc_ols", "again"), PANEL.keys
    )
    return both.select("t", "g", F.col("sc_ols").eqNullSafe(F.col("again")).cast("int").alias("same"))


RUN_SQL = """WITH periods AS (SELECT * FROM (VALUES ('A', 9, 10, 14), ('B', 14, 15, 19), ('C', 19, 20, 24)) v(period, train_end, first, last)),
    long AS (SELECT t, g, n_error, m, CASE m WHEN 'p' THEN n_events ELSE n_purchase END AS x
      FROM full_panel CROSS JOIN (SELECT unnest(['p', 'q']) AS m)),
    lagged AS (SELECT *, lag(x, 2) OVER (PARTITION BY m, g ORDER BY t) AS x2 FROM long),
    coefs AS (SELECT m, period, regr_slope(n_error, x2) AS b, regr_intercept(n_error, x2) AS a
      FROM lagged JOIN periods ON t <= train_end GROUP BY 1, 2),
    raw AS (SELECT l.t, l.g, l.m, l.n_error, p.period, p.first, a + b * l.x2 AS pred FROM lagged l
      JOIN periods p ON l.t BETWEEN p.first AND p.last JOIN coefs c ON c.m = l.m AND c.period = p.period),
    fits AS (SELECT m, CASE period WHEN 'A' THEN 'B' WHEN 'B' THEN 'C' END AS test, avg(n_error) AS ma, avg(pred) AS mp,
      stddev_samp(n_error) / stddev_samp(pred) AS r FROM raw WHERE period <> 'C' GROUP BY m, period),
    done AS (SELECT raw.*, ma + (pred - mp) * r AS cal FROM raw LEFT JOIN fits ON fits.m = raw.m AND fits.test = raw.period),
    wide AS (SELECT t, g, period, first, max(pred) FILTER (m = 'p') AS ss_p_2, max(cal) FILTER (m = 'p') AS ss_p_2_calibrated,
      max(pred) FILTER (m = 'q') AS ss_q_2, max(cal) FILTER (m = 'q') AS ss_q_2_calibrated, avg(cal) AS ss_mix_2 FROM done GROUP BY 1, 2, 3, 4)
  SELECT *, first_value(ss_mix_2) OVER (PARTITION BY g, period ORDER BY (t = first + 1) DESC) AS sc_mix FROM wide"""


@query(
    "prediction_run",
    ("MO11", "EN5", "EN1", "J12"),
    "t:l g:l ss_p_2:d ss_p_2_calibrated:d ss_q_2:d ss_q_2_calibrated:d ss_mix_2:d sc_mix:d",
    RUN_SQL,
    ["full_panel"],
)
def _(t):
    rows = full_panel(t)

    def model(name, feature):
        return StepModel(
            name=name,
            col_outcome="n_error",
            cols_features=[feature],
            steps=[2],
            outcome_type="real",
            periods=[PERIOD_A, PERIOD_B, PERIOD_C],
            estimator=LinearRegression(regParam=0.0, solver="normal"),
            panel=PANEL,
        ).fit(rows)

    models = [model("p", "n_events"), model("q", "n_purchase")]
    predictions = predict_models(models, rows, PERIODS)
    mix = Ensemble("mix", models, "average", "real", "n_error", [PERIOD_B, PERIOD_C], PANEL)
    return predict_ensembles([mix], predictions, rows, PERIODS)


# --- ensembles -------------------------------------------------------------


@query(
    "ensemble_average",
    "EN1",
    "t:l g:l mixed:d",
    """SELECT t, g, CASE WHEN g % 4 = 0 THEN (p_a + p_c) / 2 ELSE (p_a + p_b + p_c) / 3 END AS mixed FROM outcome_frame""",
    ["outcome_frame"],
)
def _(t):
    rows = outcome_frame(t).withColumn("p_b", F.when(F.col("g") % 4 != 0, F.col("p_b")))
    return EN.average(rows, ["p_a", "p_b", "p_c"], "mixed")


CLIPPED = "least(greatest({0}, 1e-10), 1 - 1e-10)"


def em_sql(hits: str) -> str:
    """EM from equal weights over likelihoods ga, gb, gc until the gain is
    small; the weights are those of the row that is done."""
    share = lambda m: f"avg(0.01e0 / 3 + 0.99e0 * {m} * g{m} / (a * ga + b * gb + c * gc)) AS {m}"
    return f"""SELECT a, b, c FROM (WITH RECURSIVE hits AS MATERIALIZED ({hits}), em AS (
        SELECT 0 AS i, 1 / 3e0 AS a, 1 / 3e0 AS b, 1 / 3e0 AS c, NULL::DOUBLE AS likely, FALSE AS done
        UNION ALL SELECT i + 1, {share('a')}, {share('b')}, {share('c')}, sum(ln(a * ga + b * gb + c * gc)) AS likely,
          coalesce(abs(sum(ln(a * ga + b * gb + c * gc)) - min(em.likely)) < 0.001e0, FALSE) AS done
        FROM em, hits WHERE NOT done GROUP BY i, em.a, em.b, em.c)
      SELECT * FROM em WHERE done)"""


def hits_sql(ps, source: str) -> str:
    of = lambda p: f"CASE WHEN y = 1 THEN {CLIPPED.format(p)} ELSE 1 - {CLIPPED.format(p)} END"
    return "SELECT " + ", ".join(f"{of(p)} AS g{m}" for m, p in zip("abc", ps)) + f" FROM {source}"


CALIB = "(SELECT * FROM outcome_frame WHERE t BETWEEN 15 AND 19)"


@query(
    "ensemble_weights_by_em",
    "EN2",
    "model:s weight:d",
    f"""WITH w AS ({em_sql(hits_sql(["p_a", "p_b", "p_c"], CALIB))})
       SELECT 'p_a' AS model, a AS weight FROM w UNION ALL SELECT 'p_b', b FROM w UNION ALL SELECT 'p_c', c FROM w""",
    ["outcome_frame"],
)
def _(t):
    calib = outcome_frame(t).filter(PERIOD_B.in_predict(F.col("t")))
    cols = ["p_a", "p_b", "p_c"]
    weights, _rounds, _like = EN.fit_weights(calib, cols, "y")
    return t.spark.createDataFrame(list(zip(cols, weights)), "model string, weight double")


SHRUNK = "sign(ln(p / (1 - p))) * (pow(1 + abs(ln(p / (1 - p))), 1 / 3e0) - 1)"


@query(
    "ensemble_bias_correction",
    ("EN2", "F17"),
    "t:l g:l adjusted:d",
    f"""WITH clipped AS (SELECT t, g, y, least(greatest(p_b, 1e-10), 1 - 1e-10) AS p FROM outcome_frame),
        calib AS (SELECT y, {SHRUNK} AS x FROM clipped WHERE t BETWEEN 15 AND 19), {newton_sql('calib', 12)}
       SELECT t, g, 1 / (1 + exp(-(a + b * {SHRUNK}))) AS adjusted FROM clipped, b12""",
    ["outcome_frame"],
)
def _(t):
    rows = outcome_frame(t)
    calib = rows.filter(PERIOD_B.in_predict(F.col("t")))
    fit = EN.fit_ebma(calib, ["p_b"], "y")
    return rows.select("t", "g", fit.adjusted(0).alias("adjusted"))


def shrunk_sql(p: str) -> str:
    return SHRUNK.replace("(p / (1 - p))", f"({CLIPPED.format(p)} / (1 - {CLIPPED.format(p)}))")


def ebma_sql() -> str:
    """A logit per model, EM over what they correct, and the mixture."""
    names = ["p_a", "p_b", "p_c"]
    fits = ", ".join(
        f"""f{p} AS MATERIALIZED (WITH calib AS (SELECT y, {shrunk_sql(p)} AS x FROM {CALIB}),
          {newton_sql('calib', 12)} SELECT a, b FROM b12)"""
        for p in names
    )
    fixed = ", ".join(f"1 / (1 + exp(-(f{p}.a + f{p}.b * {shrunk_sql(p)}))) AS {p}" for p in names)
    adjusted = f"SELECT t, g, y, {fixed} FROM outcome_frame, fp_a, fp_b, fp_c"
    calib = "(SELECT * FROM adjusted WHERE t BETWEEN 15 AND 19)"
    return f"""WITH {fits}, adjusted AS MATERIALIZED ({adjusted}), w AS MATERIALIZED ({em_sql(hits_sql(names, calib))})
        SELECT t, g, w.a * p_a + w.b * p_b + w.c * p_c AS mixed FROM adjusted, w WHERE t BETWEEN 20 AND 24"""


@query("ensemble_ebma", "EN2", "t:l g:l mixed:d", ebma_sql(), ["outcome_frame"])
def _(t):
    rows = outcome_frame(t)
    calib = rows.filter(PERIOD_B.in_predict(F.col("t")))
    fit = EN.fit_ebma(calib, ["p_a", "p_b", "p_c"], "y")
    return fit.predict(rows.filter(PERIOD_C.in_predict(F.col("t"))), "mixed").select("t", "g", "mixed")


@query(
    "ensemble_cross_level",
    "EN4",
    "t:l g:l joint:d",
    """WITH high AS (SELECT t, g, g // 10 AS area, CASE WHEN (t * 7 + g) % 150 <> 0 THEN p_a END AS p_a FROM outcome_frame),
        low AS (SELECT t, g // 10 AS area, max(p_b) AS p_low FROM outcome_frame GROUP BY 1, 2),
        joint AS (SELECT h.t, h.g, p_low * h.p_a / nullif(s.total, 0) AS joint FROM high h
          JOIN (SELECT t, area, sum(p_a) AS total FROM high GROUP BY 1, 2) s ON s.t = h.t AND s.area = h.area
          JOIN low ON low.t = h.t AND low.area = h.area)
       SELECT t, g, coalesce(joint, (SELECT avg(joint) FROM joint)) AS joint FROM joint""",
    ["outcome_frame"],
)
def _(t):
    rows = outcome_frame(t).withColumn("area", F.floor(F.col("g") / 10))
    low = rows.groupBy("t", "area").agg(F.max("p_b").alias("p_low"))
    high = rows.select("t", "g", "area", F.when((F.col("t") * 7 + F.col("g")) % 150 != 0, F.col("p_a")).alias("p_a"))
    return EN.cross_level(high, low, "t", "area", "p_a", "p_low", "joint")
