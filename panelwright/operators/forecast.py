"""Frames for step-ahead models, independent of the estimator.

A model of step s is trained on features shifted by s rows and predicts time
t + s from the features of t.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions.windows import onset_possible, tlag
from panelwright.operators.evaluation import actual_outcome
from panelwright.operators.missing import extrapolate, resample
from panelwright.operators.ranking import digest, with_rank
from panelwright.panel import Panel, Period


@dataclass(frozen=True)
class Downsampling:
    """Shares of positive and negative training rows to keep."""

    share_positive: float = 1.0
    share_negative: float = 1.0
    threshold: float = 0
    seed: int = 1


def shift_features(
    df: DataFrame, panel: Panel, features: Sequence[str], step: int, keep: Sequence[Column] = ()
) -> DataFrame:
    """Every feature `step` rows later, other given columns as they are."""
    return df.select(
        *panel.keys, *[tlag(f, panel, step).alias(f) for f in features], *keep
    )


def training_frame(
    df: DataFrame,
    panel: Panel,
    features: Sequence[str],
    outcome: str,
    period: Period,
    step: int,
    is_delta: bool = False,
    onset_window: int | None = None,
    downsampling: Downsampling | None = None,
) -> DataFrame:
    """Complete training rows of one period and step.

    The times are cut before shifting, so no feature comes from before the
    training range. Features, outcome and the onset mask share one window pass.
    Rows in which an onset is impossible are left out of onset models.
    """
    cut = df.filter(period.in_train(F.col(panel.time)))
    target = actual_outcome(outcome, panel, is_delta, onset_window, step).alias("_outcome")
    extra = [target]
    if onset_window:
        extra.append(onset_possible(outcome, panel, onset_window).alias("_possible"))
    rows = shift_features(cut, panel, features, step, extra)
    if onset_window:
        rows = rows.filter(F.col("_possible") == 1).drop("_possible")
    rows = rows.dropna(subset=[*features, "_outcome"])
    rows = rows.withColumn(outcome, F.col("_outcome")).drop("_outcome")
    if downsampling:
        rows = resample(
            rows,
            panel.keys,
            [outcome],
            downsampling.share_positive,
            downsampling.share_negative,
            downsampling.threshold,
            downsampling.seed,
        )
    return rows


def step_predictions(
    df: DataFrame,
    panel: Panel,
    features: Sequence[str],
    period: Period,
    steps: Sequence[int],
    score: Callable[[DataFrame], tuple[DataFrame, Mapping[int, Column]]],
    names: Mapping[int, str],
) -> DataFrame:
    """Predictions of all steps for the rows of the predict range.

    Every row is read once. `score` adds what the models of all steps say about
    it and names the column of each step; the prediction of a row with complete
    features goes to the time `step` later. The steps are unfolded into rows,
    with the row itself as step 0, and meet in one aggregate, so there is one
    shuffle for all of them and no join. Rows that no prediction reaches stay
    missing.
    """
    t, kind = F.col(panel.time), df.schema[panel.time].dataType
    inputs = df.filter(t.between(period.predict_start - max(steps), period.predict_end))
    whole = F.lit(True)
    for f in features:
        whole = whole & F.col(f).isNotNull()
    scored, columns = score(inputs.select(*panel.keys, *features, whole.alias("_whole")))
    reached = F.array(
        F.struct(F.lit(0).alias("step"), t.alias("at"), F.lit(None).cast("double").alias("p")),
        *[
            F.struct(
                F.lit(s).alias("step"),
                (t + s).cast(kind).alias("at"),
                F.when(F.col("_whole"), columns[s].cast("double")).alias("p"),
            )
            for s in steps
        ],
    )
    rows = scored.select(panel.group, F.explode(reached).alias("a"))
    rows = rows.select(F.col("a.at").alias(panel.time), panel.group, "a.step", "a.p").filter(period.in_predict(t))
    wide = rows.groupBy(*panel.keys).agg(
        F.min("step").alias("_first"),
        *[F.max(F.when(F.col("step") == s, F.col("p"))).alias(names[s]) for s in steps],
    )
    return wide.filter(F.col("_first") == 0).drop("_first")


def combine_steps(
    df: DataFrame, panel: Panel, cols: Mapping[int, str], period: Period, out: str
) -> DataFrame:
    """One prediction per row from the step-specific ones.

    The time `step - 1` after the start of the predict range takes that step's
    prediction; the times between are interpolated and those outside take the
    nearest. Rows outside the predict range get no value.
    """
    t = F.col(panel.time)
    picked = F.lit(None).cast("double")
    for step, col in cols.items():
        at = period.predict_start + step - 1
        if at <= period.predict_end:
            picked = F.when(t == at, F.col(col).cast("double")).otherwise(picked)
    # The picks lie inside the range, so rows outside it do not change what is
    # between them.
    filled = extrapolate(df.withColumn(out, picked), panel, [out])
    return filled.withColumn(out, F.when(period.in_predict(t), F.col(out)))


def permuted(
    df: DataFrame, panel: Panel, features: Sequence[str], repeats: int, seed: int
) -> DataFrame:
    """The frame once per feature and repeat, with that feature's values shuffled.

    Rows are numbered in one hash order, the values of each feature and repeat
    in another; joining on the number is a permutation that any run repeats.
    All features and repeats go through the same two numberings and one join.
    """
    rows = with_rank(df, digest(*panel.keys, seed), panel.keys, "_place")
    columns = F.array(
        *[
            F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("_value"))
            for f in features
        ]
    )
    values = (
        df.select(*panel.keys, F.explode(columns).alias("v"))
        .select(
            *panel.keys,
            "v.*",
            F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("repeat"),
        )
    )
    placed = with_rank(
        values,
        digest(*panel.keys, F.col("feature"), F.col("repeat"), seed),
        panel.keys,
        "_place",
        by=["feature", "repeat"],
    ).select("feature", "repeat", "_place", "_value")
    swapped = [
        F.when(F.col("feature") == c, F.col("_value")).otherwise(F.col(c).cast("double")).alias(c)
        if c in features
        else F.col(c)
        for c in df.columns
    ]
    return rows.join(placed, "_place").select(*swapped, "feature", "repeat")
