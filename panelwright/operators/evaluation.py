"""Scores of predictions against outcomes.

Every function takes a frame with an `actual` and a `pred` column and a list of
grouping columns (period, step, variant ...), and scores all groups at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions.scalars import clip
from panelwright.functions.windows import delta, onset
from panelwright.operators.ranking import cumulate_down
from panelwright.panel import Panel, Period

# The tolerance of the directional score and the log-loss margin.
TADDA_EPSILON = 0.048
LOG_LOSS_MARGIN = 1e-15

REAL_METRICS = ("mse", "mae", "r2")
PROB_METRICS = ("average_precision", "area_under_roc", "brier")


def squared_error(y: Column, f: Column) -> Column:
    return (y - f) * (y - f)


def tadda(y: Column, f: Column, epsilon: float = 1, smooth: bool = False) -> Column:
    """Absolute error plus a penalty for the wrong direction of change.

    The penalty applies when the signs differ and the error exceeds epsilon. A
    zero outcome agrees with both signs. The smooth form takes what is left of
    epsilon around the outcome off the penalty.
    """
    error = F.abs(y - f)
    wrong = ((y > 0) != (f > 0)) & (y != 0) & (error > epsilon)
    penalty = F.abs(f)
    if smooth:
        reach = F.when(F.abs(y) < epsilon, F.lit(epsilon) - F.abs(y)).otherwise(F.lit(0.0))
        penalty = F.abs(penalty - reach)
    return error + F.when(wrong, penalty).otherwise(F.lit(0.0))


def mean_squared_error(y: Column, f: Column) -> Column:
    return F.avg(squared_error(y, f))


def mean_absolute_error(y: Column, f: Column) -> Column:
    return F.avg(F.abs(y - f))


def r2(y: Column, f: Column) -> Column:
    """1 - SSE/SST; for a constant outcome 1 if it is hit and 0 if not."""
    sse = F.sum(squared_error(y, f))
    sst = F.var_pop(y) * F.count(y)
    return F.when(sst > 0, F.lit(1.0) - F.try_divide(sse, sst)).otherwise(
        F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    )


def brier(y: Column, p: Column) -> Column:
    return F.avg(squared_error(p, y))


def log_loss(y: Column, p: Column) -> Column:
    p = clip(p, LOG_LOSS_MARGIN, 1 - LOG_LOSS_MARGIN)
    return -F.avg(y * F.log(p) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - p))


def accuracy(y: Column, f: Column) -> Column:
    return F.avg((y == f).cast("double"))


def _ratio(num: Column, den: Column) -> Column:
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def precision(y: Column, f: Column) -> Column:
    """Share of positive labels that are right, 0 if there are none."""
    hit = F.count(F.when((y == 1) & (f == 1), 1))
    return _ratio(hit, F.count(F.when(f == 1, 1)))


def recall(y: Column, f: Column) -> Column:
    """Share of positive outcomes that are found, 0 if there are none."""
    hit = F.count(F.when((y == 1) & (f == 1), 1))
    return _ratio(hit, F.count(F.when(y == 1, 1)))


def f1_score(y: Column, f: Column) -> Column:
    """Harmonic mean of precision and recall, 0 if undefined."""
    hit = F.count(F.when((y == 1) & (f == 1), 1))
    either = F.count(F.when(f == 1, 1)) + F.count(F.when(y == 1, 1))
    return _ratio(hit * 2, either)


def ranked_scores(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Average precision, area under ROC and Brier score of 0/1 outcomes.

    Rows are first combined by score, so ties cost nothing and the data is read
    once for all three; the running counts over the remaining scores are built
    in buckets and never in one task.
    """
    outcome = F.col("actual").cast("double")
    at_score = df.groupBy(*by, "pred").agg(
        F.sum(outcome).alias("pos"), F.count(F.lit(1)).cast("double").alias("all")
    )
    run = cumulate_down(at_score, by, "pred", ["pos", "all"])
    neg = F.col("all") - F.col("pos")
    above = F.col("cum_pos") - F.col("pos")
    p = F.col("pred")
    squared = F.col("pos") * squared_error(p, F.lit(1.0)) + neg * p * p
    sums = run.groupBy(*by).agg(
        F.sum("pos").alias("_p"),
        F.sum(neg).alias("_n"),
        F.sum(F.col("pos") * F.col("cum_pos") / F.col("cum_all")).alias("_ap"),
        F.sum(neg * (above + F.col("pos") / 2)).alias("_auc"),
        F.sum(squared).alias("_squared"),
    )
    return sums.select(
        *by,
        _ratio(F.col("_ap"), F.col("_p")).alias("average_precision"),
        F.try_divide(F.col("_auc"), F.col("_p") * F.col("_n")).alias("area_under_roc"),
        F.try_divide(F.col("_squared"), F.col("_p") + F.col("_n")).alias("brier"),
    )


def scores_real(
    df: DataFrame, by: Sequence[str] = (), is_delta: bool = False
) -> DataFrame:
    """All scores of a real-valued prediction in one aggregate."""
    y, f = F.col("actual").cast("double"), F.col("pred").cast("double")
    aggs = [
        mean_squared_error(y, f).alias("mse"),
        mean_absolute_error(y, f).alias("mae"),
        r2(y, f).alias("r2"),
    ]
    if is_delta:
        aggs.append(F.avg(tadda(y, f, TADDA_EPSILON)).alias("tadda_score"))
    return df.groupBy(*by).agg(*aggs)


def class_report(df: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per label, with both averages.

    Works on the confusion counts, whose number is that of label pairs.
    """
    cells = df.groupBy("actual", "pred").agg(F.count(F.lit(1)).alias("n"))
    label = F.explode(F.array_distinct(F.array("actual", "pred")))
    hits = (
        cells.select("actual", "pred", "n", label.alias("label"))
        .groupBy("label")
        .agg(
            F.sum(F.when((F.col("actual") == F.col("label")) & (F.col("pred") == F.col("label")), F.col("n")).otherwise(0)).alias("hit"),
            F.sum(F.when(F.col("pred") == F.col("label"), F.col("n")).otherwise(0)).alias("said"),
            F.sum(F.when(F.col("actual") == F.col("label"), F.col("n")).otherwise(0)).alias("support"),
        )
    )
    per_label = hits.select(
        F.col("label").cast("string").alias("label"),
        _ratio(F.col("hit"), F.col("said")).alias("precision"),
        _ratio(F.col("hit"), F.col("support")).alias("recall"),
        _ratio(F.col("hit") * 2, F.col("said") + F.col("support")).alias("f1"),
        "support",
    )
    names = ["precision", "recall", "f1"]
    macro = per_label.agg(
        F.lit("macro avg").alias("label"),
        *[F.avg(m).alias(m) for m in names],
        F.sum("support").alias("support"),
    )
    weighted = per_label.agg(
        F.lit("weighted avg").alias("label"),
        *[_ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(m) for m in names],
        F.sum("support").alias("support"),
    )
    return per_label.unionByName(macro).unionByName(weighted)


def actual_outcome(
    outcome: str,
    panel: Panel,
    is_delta: bool = False,
    onset_window: int | None = None,
    step: int = 1,
) -> Column:
    """The outcome as a model is judged on it: raw, delta by step, or onset."""
    if is_delta:
        return delta(outcome, panel, step)
    if onset_window:
        return onset(outcome, panel, onset_window)
    return F.col(outcome)


def evaluation_frame(
    df: DataFrame,
    panel: Panel,
    outcome: str,
    predictions: dict[tuple, tuple[str, int]],
    periods: Sequence[Period],
    names: Sequence[str] = ("step", "variant"),
    is_delta: bool = False,
    onset_window: int | None = None,
) -> DataFrame:
    """Complete (actual, pred) pairs for every period and prediction column.

    `predictions` maps a label such as (step, variant) to the prediction column
    and the step its delta uses. Outcomes are transformed on the full panel in
    one window pass and cut to the periods afterwards; the prediction columns
    then unfold into rows, so all of them are scored by one aggregate.
    """
    steps = sorted({step for _, step in predictions.values()})
    actual = {
        s: actual_outcome(outcome, panel, is_delta, onset_window, s).cast("double").alias(f"_y{s}")
        for s in steps
    }
    wide = df.select(*panel.keys, *[c for c, _ in predictions.values()], *actual.values())
    # Periods may overlap; a row counts in each one whose predict range it is in.
    held = [F.when(p.in_predict(F.col(panel.time)), F.lit(p.name)) for p in periods]
    wide = wide.withColumn("period", F.explode(F.array_compact(F.array(*held))))
    rows = F.array(
        *[
            F.struct(
                *[F.lit(str(v)).alias(n) for n, v in zip(names, label)],
                F.col(f"_y{step}").alias("actual"),
                F.col(col).cast("double").alias("pred"),
            )
            for label, (col, step) in predictions.items()
        ]
    )
    long = wide.select(*panel.keys, "period", F.explode(rows).alias("r")).select(
        *panel.keys, "period", "r.*"
    )
    return long.dropna(subset=["actual", "pred"])


def evaluate(
    pairs: DataFrame,
    by: Sequence[str],
    outcome_type: str,
    is_delta: bool = False,
) -> DataFrame:
    """Scores in long form: grouping columns, metric, value."""
    if outcome_type == "prob":
        wide, metrics = ranked_scores(pairs, by), list(PROB_METRICS)
    elif outcome_type == "real":
        wide = scores_real(pairs, by, is_delta)
        metrics = list(REAL_METRICS) + (["tadda_score"] if is_delta else [])
    else:
        raise ValueError(f"outcome_type must be prob or real, not {outcome_type}")
    return wide.unpivot(list(by), metrics, "metric", "value")
