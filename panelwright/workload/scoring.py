"""Queries for scores and calibration."""

from pyspark.sql import functions as F

from panelwright.functions.scalars import logodds_to_prob, prob_to_logodds
from panelwright.operators import calibration as C
from panelwright.operators import evaluation as E
from panelwright.panel import Period
from panelwright.workload.base import query
from panelwright.workload.frames import (
    PANEL,
    PERIOD_A,
    PERIOD_B,
    PERIOD_C,
    full_panel,
    outcome_frame,
)


def _real_pairs(t):
    """Value of the day against a count-based forecast, per week."""
    rows = outcome_frame(t).select(
        F.floor(F.col("t") / 7).alias("week"), F.col("v").alias("actual"), F.col("f_a").alias("pred")
    )
    return rows


@query(
    "scores_of_real_predictions",
    ("E2", "E3", "E4", "E5"),
    "week:l mse:d4 mae:d4 r2:d tadda_score:d4",
    """SELECT week, avg(pow(y - f, 2)) AS mse, avg(abs(y - f)) AS mae,
        1 - sum(pow(y - f, 2)) / (var_pop(y) * count(*)) AS r2,
        avg(abs(y - f) + CASE WHEN (y > 0) <> (f > 0) AND y <> 0 AND abs(y - f) > 0.048e0 THEN abs(f) ELSE 0 END) AS tadda_score
       FROM (SELECT t // 7 AS week, v - 60 AS y, f_a - 60 AS f FROM outcome_frame) GROUP BY 1""",
    ["outcome_frame"],
)
def _(t):
    pairs = _real_pairs(t).select("week", (F.col("actual") - 60).alias("actual"), (F.col("pred") - 60).alias("pred"))
    return E.scores_real(pairs, ["week"], is_delta=True)


@query(
    "directional_score_by_row",
    "E5",
    "t:l g:l plain:d smooth:d",
    """SELECT t, g,
        abs(y - f) + CASE WHEN wrong AND abs(y - f) > 20 THEN abs(f) ELSE 0 END AS plain,
        abs(y - f) + CASE WHEN wrong AND abs(y - f) > 20 THEN
          abs(abs(f) - CASE WHEN abs(y) < 20 THEN 20 - abs(y) ELSE 0 END) ELSE 0 END AS smooth
       FROM (SELECT *, (y > 0) <> (f > 0) AND y <> 0 AS wrong FROM (SELECT t, g, v - 60 AS y, f_a - 60 AS f FROM outcome_frame))""",
    ["outcome_frame"],
)
def _(t):
    y, f = F.col("v") - 60, F.col("f_a") - 60
    return outcome_frame(t).select(
        "t", "g", E.tadda(y, f, 20).alias("plain"), E.tadda(y, f, 20, smooth=True).alias("smooth")
    )


@query(
    "scores_of_probabilities",
    ("E6", "E7", "E8"),
    "week:l average_precision:d area_under_roc:d brier:d",
    """SELECT s.*, b.brier FROM (
         SELECT week, sum(pos * cum_pos / cum_n) / sum(pos) AS average_precision,
          sum((n - pos) * (cum_pos - pos + pos / 2e0)) / (CAST(sum(pos) AS DOUBLE) * sum(n - pos)) AS area_under_roc
         FROM (SELECT *, sum(pos) OVER w AS cum_pos, sum(n) OVER w AS cum_n FROM
           (SELECT t // 7 AS week, p_b AS p, CAST(sum(y) AS DOUBLE) AS pos, CAST(count(*) AS DOUBLE) AS n FROM outcome_frame GROUP BY 1, 2)
           WINDOW w AS (PARTITION BY week ORDER BY p DESC)) GROUP BY 1) s
       JOIN (SELECT t // 7 AS week, avg(pow(p_b - y, 2)) AS brier FROM outcome_frame GROUP BY 1) b ON b.week = s.week""",
    ["outcome_frame"],
)
def _(t):
    pairs = outcome_frame(t).select(
        F.floor(F.col("t") / 7).alias("week"), F.col("y").alias("actual"), F.col("p_b").alias("pred")
    )
    return E.ranked_scores(pairs, ["week"])


@query(
    "ranked_scores_with_many_ties",
    ("E6", "E7"),
    "average_precision:d area_under_roc:d",
    """SELECT sum(pos * cum_pos / cum_n) / sum(pos) AS average_precision,
        sum((n - pos) * (cum_pos - pos + pos / 2e0)) / (CAST(sum(pos) AS DOUBLE) * sum(n - pos)) AS area_under_roc
       FROM (SELECT *, sum(pos) OVER w AS cum_pos, sum(n) OVER w AS cum_n FROM
         (SELECT l_discount AS p, CAST(sum((l_returnflag = 'R')::INT) AS DOUBLE) AS pos, CAST(count(*) AS DOUBLE) AS n FROM lineitem GROUP BY 1)
         WINDOW w AS (ORDER BY p DESC))""",
)
def _(t):
    pairs = t.lineitem.select(
        (F.col("l_returnflag") == "R").cast("int").alias("actual"), F.col("l_discount").alias("pred")
    )
    return E.ranked_scores(pairs)


@query(
    "scores_of_labels",
    ("E9", "E10", "E11", "E12", "E13"),
    "week:l log_loss:d accuracy:d precision:d recall:d f1:d",
    """SELECT week, log_loss, accuracy, coalesce(tp / nullif(said, 0), 0) AS precision,
        coalesce(tp / nullif(truth, 0), 0) AS recall, coalesce(2 * tp / nullif(said + truth, 0), 0) AS f1 FROM (
         SELECT t // 7 AS week, -avg(y * ln(p) + (1 - y) * ln(1 - p)) AS log_loss, avg((y = f)::INT) AS accuracy,
          CAST(sum(y * f) AS DOUBLE) AS tp, sum(f) AS said, sum(y) AS truth
         FROM (SELECT t, y, least(greatest(p_b, 1e-15), 1 - 1e-15) AS p, (p_b >= 0.6e0)::INT AS f FROM outcome_frame) GROUP BY 1)""",
    ["outcome_frame"],
)
def _(t):
    label = (F.col("p_b") >= 0.6).cast("int")
    y = F.col("y")
    return (
        outcome_frame(t)
        .groupBy(F.floor(F.col("t") / 7).alias("week"))
        .agg(
            E.log_loss(y, F.col("p_b")).alias("log_loss"),
            E.accuracy(y, label).alias("accuracy"),
            E.precision(y, label).alias("precision"),
            E.recall(y, label).alias("recall"),
            E.f1_score(y, label).alias("f1"),
        )
    )


@query(
    "class_report",
    "E14",
    "label:s precision:d recall:d f1:d support:l",
    """WITH pairs AS (SELECT y AS a, (p_b >= 0.6e0)::INT AS p FROM outcome_frame),
        per AS (SELECT CAST(l AS VARCHAR) AS label, coalesce(hit / nullif(said, 0), 0) AS precision,
          coalesce(hit / nullif(truth, 0), 0) AS recall, coalesce(2 * hit / nullif(said + truth, 0), 0) AS f1, truth AS support
          FROM (SELECT l, CAST(count(*) FILTER (a = l AND p = l) AS DOUBLE) AS hit, count(*) FILTER (p = l) AS said,
            count(*) FILTER (a = l) AS truth FROM pairs CROSS JOIN (SELECT unnest([0, 1]) AS l) GROUP BY l))
       SELECT * FROM per UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM per
       UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
         sum(f1 * support) / sum(support), sum(support) FROM per""",
    ["outcome_frame"],
)
def _(t):
    label = (F.col("p_b") >= 0.6).cast("int")
    return E.class_report(outcome_frame(t).select(F.col("y").alias("actual"), label.alias("pred")))


def _pred_columns(t):
    """Outcomes with two steps of predictions, the second calibrated in B only."""
    return outcome_frame(t).select(
        "t",
        "g",
        "v",
        F.col("f_a").alias("ss_m_1"),
        F.when(F.col("g") % 7 != 0, F.col("f_b")).alias("ss_m_3"),
        ((F.col("f_a") + F.col("f_b")) / 2).alias("sc_m"),
        F.when(F.col("t") >= 15, F.col("f_b") * 0.5).alias("ss_m_3_calibrated"),
    )


EVAL_PAIRS = """SELECT t, g, CASE WHEN t BETWEEN 10 AND 14 THEN 'A' WHEN t BETWEEN 15 AND 19 THEN 'B' ELSE 'C' END AS period,
      step, variant, CASE WHEN lag_by = 1 THEN d1 ELSE d3 END AS actual, pred FROM (
    SELECT *, v - lag(v) OVER (PARTITION BY g ORDER BY t) AS d1, v - lag(v, 3) OVER (PARTITION BY g ORDER BY t) AS d3 FROM outcome_frame) f
    CROSS JOIN LATERAL (SELECT '1' AS step, 'uncalibrated' AS variant, 1 AS lag_by, f.f_a AS pred
      UNION ALL SELECT '3', 'uncalibrated', 3, CASE WHEN f.g % 7 <> 0 THEN f.f_b END
      UNION ALL SELECT 'sc', 'uncalibrated', 1, (f.f_a + f.f_b) / 2
      UNION ALL SELECT '3', 'calibrated', 3, CASE WHEN f.t >= 15 THEN f.f_b * 0.5e0 END)
    WHERE t BETWEEN 10 AND 24 AND pred IS NOT NULL"""

LABELS = {
    (1, "uncalibrated"): ("ss_m_1", 1),
    (3, "uncalibrated"): ("ss_m_3", 3),
    ("sc", "uncalibrated"): ("sc_m", 1),
    (3, "calibrated"): ("ss_m_3_calibrated", 3),
}


@query(
    "evaluation_pairs",
    "E1",
    "t:l g:l period:s step:s variant:s actual:d pred:d",
    f"SELECT * FROM ({EVAL_PAIRS}) WHERE actual IS NOT NULL",
    ["outcome_frame"],
)
def _(t):
    return E.evaluation_frame(
        _pred_columns(t), PANEL, "v", LABELS, [PERIOD_A, PERIOD_B, PERIOD_C], is_delta=True
    )


OVERLAP = [Period("early", 0, 4, 5, 10), Period("late", 0, 7, 8, 14)]


@query(
    "evaluation_of_overlapping_periods",
    ("E1", "E15"),
    "period:s step:s variant:s metric:s value:d4",
    """WITH pairs AS (SELECT p.name AS period, v AS y, f_a AS f FROM outcome_frame o
          JOIN (VALUES ('early', 5, 10), ('late', 8, 14)) p(name, a, b) ON o.t BETWEEN p.a AND p.b),
        wide AS (SELECT period, '1' AS step, 'uncalibrated' AS variant, avg(pow(y - f, 2)) AS mse, avg(abs(y - f)) AS mae,
          1 - sum(pow(y - f, 2)) / (var_pop(y) * count(*)) AS r2 FROM pairs GROUP BY ALL)
       UNPIVOT wide ON mse, mae, r2 INTO NAME metric VALUE value""",
    ["outcome_frame"],
)
def _(t):
    label = {(1, "uncalibrated"): ("f_a", 1)}
    pairs = E.evaluation_frame(outcome_frame(t), PANEL, "v", label, OVERLAP)
    return E.evaluate(pairs, ["period", "step", "variant"], "real")


@query(
    "evaluation_of_all_predictions",
    ("E1", "E15"),
    "period:s step:s variant:s metric:s value:d4",
    f"""WITH pairs AS (SELECT period, step, variant, actual AS y, pred AS f FROM ({EVAL_PAIRS}) WHERE actual IS NOT NULL),
        wide AS (SELECT period, step, variant, avg(pow(y - f, 2)) AS mse, avg(abs(y - f)) AS mae,
          1 - sum(pow(y - f, 2)) / (var_pop(y) * count(*)) AS r2,
          avg(abs(y - f) + CASE WHEN (y > 0) <> (f > 0) AND y <> 0 AND abs(y - f) > 0.048e0 THEN abs(f) ELSE 0 END) AS tadda_score
          FROM pairs GROUP BY ALL)
       UNPIVOT wide ON mse, mae, r2, tadda_score INTO NAME metric VALUE value""",
    ["outcome_frame"],
)
def _(t):
    pairs = E.evaluation_frame(
        _pred_columns(t), PANEL, "v", LABELS, [PERIOD_A, PERIOD_B, PERIOD_C], is_delta=True
    )
    return E.evaluate(pairs, ["period", "step", "variant"], "real", is_delta=True)


# --- calibration -----------------------------------------------------------


@query(
    "calibrated_values",
    "C1",
    "t:l g:l calibrated:d",
    """SELECT t, g, (SELECT avg(v) FROM outcome_frame WHERE t BETWEEN 15 AND 19) +
        (f_a - (SELECT avg(f_a) FROM outcome_frame WHERE t BETWEEN 15 AND 19)) *
        (SELECT stddev_samp(v) / stddev_samp(f_a) FROM outcome_frame WHERE t BETWEEN 15 AND 19) AS calibrated
       FROM outcome_frame WHERE t BETWEEN 20 AND 24""",
    ["outcome_frame"],
)
def _(t):
    rows = outcome_frame(t)
    calib = rows.filter(PERIOD_B.in_predict(F.col("t")))
    test = rows.filter(PERIOD_C.in_predict(F.col("t")))
    return C.calibrate_real(test, "f_a", calib, "f_a", "v", "calibrated")


def newton_sql(source: str, rounds: int) -> str:
    """Newton's method for a logit of y on x as a chain of aggregates."""
    parts = ["b0 AS (SELECT 0e0 AS a, 0e0 AS b)"]
    for i in range(rounds):
        parts.append(
            f"""s{i} AS (SELECT min(a) AS a, min(b) AS b, sum(y - p) AS g0, sum((y - p) * x) AS g1, sum(p * (1 - p)) AS h0,
              sum(p * (1 - p) * x) AS h1, sum(p * (1 - p) * x * x) AS h2
              FROM (SELECT y, x, a, b, 1 / (1 + exp(-(a + b * x))) AS p FROM {source}, b{i})),
            b{i + 1} AS (SELECT a + (h2 * g0 - h1 * g1) / (h0 * h2 - h1 * h1) AS a,
              b + (h0 * g1 - h1 * g0) / (h0 * h2 - h1 * h1) AS b FROM s{i})"""
        )
    return ",\n".join(parts)


@query(
    "calibrated_probabilities",
    "C2",
    "t:l g:l calibrated:d",
    f"""WITH calib AS (SELECT y, ln(p / (1 - p)) AS x FROM (SELECT y, least(greatest(p_b, 1e-10), 1 - 1e-10) AS p
          FROM outcome_frame WHERE t BETWEEN 15 AND 19)), {newton_sql('calib', 10)}
       SELECT t, g, 1 / (1 + exp(-(a + b * ln(p / (1 - p))))) AS calibrated FROM
        (SELECT t, g, least(greatest(p_b, 1e-10), 1 - 1e-10) AS p FROM outcome_frame WHERE t BETWEEN 20 AND 24), b10""",
    ["outcome_frame"],
)
def _(t):
    rows = outcome_frame(t)
    calib = rows.filter(PERIOD_B.in_predict(F.col("t")))
    test = rows.filter(PERIOD_C.in_predict(F.col("t")))
    return C.calibrate_prob(test, "p_b", calib, "p_b", "y", "calibrated")


@query(
    "calibration_keeps_the_mean",
    "C2",
    "rows:l same_mean:l",
    "SELECT count(*) AS rows, 1 AS same_mean FROM full_panel WHERE t BETWEEN 15 AND 19",
    ["full_panel"],
)
def _(t):
    # A logit with an intercept reproduces the mean outcome it was fitted on.
    calib = outcome_frame(t).filter(PERIOD_B.in_predict(F.col("t")))
    done = C.calibrate_prob(calib, "p_a", calib, "p_a", "y", "calibrated")
    return done.agg(
        F.count(F.lit(1)).alias("rows"),
        (F.abs(F.avg("calibrated") - F.avg("y")) < 1e-9).cast("int").alias("same_mean"),
    )


@query(
    "log_odds_round_trip",
    ("F7", "F9"),
    "t:l g:l same:l",
    "SELECT t, g, 1 AS same FROM full_panel",
    ["full_panel"],
)
def _(t):
    back = logodds_to_prob(prob_to_logodds("p_c"))
    return outcome_frame(t).select("t", "g", (F.abs(back - F.col("p_c")) < 1e-9).cast("int").alias("same"))
