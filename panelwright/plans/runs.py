"""Prediction runs: many models over pairs of calibration and test periods."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.lineage import cut
from panelwright.operators.joins import assign_all_into
from panelwright.operators.model import Ensemble, StepModel
from panelwright.panel import Panel, Period


def period_pairs(periods: Mapping[str, Period]) -> list[tuple[Period, Period]]:
    """Calibration and test pairs: A to B if there is an A, and B to C."""
    if "B" not in periods or "C" not in periods:
        raise ValueError("a run needs the periods B and C")
    pairs = [(periods["B"], periods["C"])]
    return [(periods["A"], periods["B"]), *pairs] if "A" in periods else pairs


def prediction_rows(
    df: DataFrame, panel: Panel, pairs: Sequence[tuple[Period, Period]]
) -> DataFrame:
    """Keys of every time that any period of the run predicts."""
    t = F.col(panel.time)
    wanted = F.lit(False)
    for pair in pairs:
        for period in pair:
            wanted = wanted | period.in_predict(t)
    return df.filter(wanted).select(*panel.keys)


def predict_models(
    models: Sequence[StepModel], df: DataFrame, periods: Mapping[str, Period]
) -> DataFrame:
    """One prediction table of all models: raw, test and calibrated columns.

    Missing features count as 0. A model predicts each period once, though it
    is test in one pair and calibration in the next; its predictions are
    written before they are calibrated and merged, so the plan of a run does
    not grow with the number of models that came before. All parts are then
    put into the table by key with one aggregate.
    """
    pairs = period_pairs(periods)
    panel = models[0].panel
    used = list({p.name: p for pair in pairs for p in pair}.values())
    parts: list[DataFrame] = []
    for model in models:
        data = df.select(
            *panel.keys,
            *[
                F.coalesce(c, F.lit(0)).alias(c)
                for c in sorted({*model.cols_features, model.col_outcome})
            ],
        )
        raw = cut(model.predict(data, periods=used))
        parts.append(raw)
        for calib, test in pairs:
            t = F.col(panel.time)
            parts.append(
                model.calibrate(
                    data,
                    raw.filter(calib.in_predict(t)),
                    raw.filter(test.in_predict(t)),
                    calib,
                    test,
                )
            )
    return assign_all_into(prediction_rows(df, panel, pairs), parts, panel)


def predict_ensembles(
    ensembles: Sequence[Ensemble],
    predictions: DataFrame,
    df: DataFrame,
    periods: Mapping[str, Period],
) -> DataFrame:
    """Ensemble columns next to those of the models they combine."""
    pairs = period_pairs(periods)
    panel = ensembles[0].panel
    predictions = cut(predictions)
    outcomes = sorted({c for e in ensembles for c in e.cols_needed if c not in predictions.columns})
    inputs = predictions.join(df.select(*panel.keys, *outcomes), panel.keys, "left")
    parts = [e.predict(inputs, calib, test) for calib, test in pairs for e in ensembles]
    return assign_all_into(predictions, parts, panel)
