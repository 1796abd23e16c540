"""Calibrating predictions on a period with known outcomes."""

from __future__ import annotations

import math
import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions.scalars import ColumnLike, as_column, logodds_to_prob, prob_to_logodds

NEWTON_ROUNDS = 35
NEWTON_TOLERANCE = 1e-10
HALVINGS = 20


def calibrate_real_columns(
    test: DataFrame, calib: DataFrame, cols: Mapping[str, tuple[str, str, str]]
) -> DataFrame:
    """Shift and stretch predictions so that on the calibration period they
    would have the outcome's mean and standard deviation.

    `cols` maps a new column to the test prediction, the calibration prediction
    and the outcome. The moments of all columns are one aggregate, read as a
    scalar subquery.
    """
    moments = calib.agg(
        F.struct(
            *[
                F.struct(
                    F.avg(actual).alias("mean_actual"),
                    F.avg(pred).alias("mean_pred"),
                    F.try_divide(F.stddev_samp(actual), F.stddev_samp(pred)).alias("ratio"),
                ).alias(out)
                for out, (_test, pred, actual) in cols.items()
            ]
        )
    ).scalar()

    def scaled(out: str, test_pred: str) -> Column:
        m = moments[out]
        return m["mean_actual"] + (F.col(test_pred) - m["mean_pred"]) * m["ratio"]

    return test.select("*", *[scaled(o, c[0]).alias(o) for o, c in cols.items()])


def calibrate_real(
    test: DataFrame, test_pred: str, calib: DataFrame, calib_pred: str, actual: str, out: str
) -> DataFrame:
    """`calibrate_real_columns` for one prediction."""
    return calibrate_real_columns(test, calib, {out: (test_pred, calib_pred, actual)})


@dataclass
class _Newton:
    """How far the fit of one logit has come."""

    key: str
    best: tuple[float, float] = (0.0, 0.0)
    now: Sequence[float] | None = None
    direction: tuple[float, float] = (0.0, 0.0)
    scale: float = 1.0
    halvings: int = 0
    rounds: int = 0
    done: bool = False

    @property
    def trial(self) -> tuple[float, float]:
        return tuple(b + self.scale * d for b, d in zip(self.best, self.direction))

    def take(self, sums: Sequence[float], most: int) -> None:
        """Go on with the sums at `trial`."""
        if self.now is None:
            self.now = sums
            mean = sums[6]
            if not 0 < mean < 1:
                raise self._error("the outcome is constant")
            if sums[2] * sums[4] - sums[3] ** 2 <= 1e-14 * sums[2] * sums[4]:
                self.best, self.done = (math.log(mean / (1 - mean)), 0.0), True
                return
        elif sums[5] < self.now[5] - 1e-12 * abs(self.now[5]):
            self.scale, self.halvings = self.scale / 2, self.halvings + 1
            if self.halvings == HALVINGS:
                raise self._error(f"no step of {HALVINGS} halvings raises the likelihood")
            return
        else:
            self.best, self.now, self.rounds = self.trial, sums, self.rounds + 1
            step = self.scale * max(map(abs, self.direction))
            if step < NEWTON_TOLERANCE * max(1.0, *map(abs, self.best)):
                self.done = True
                return
            if self.rounds >= most:
                raise self._error(
                    f"after {most} rounds the last step was {step:.3g}; the outcome may be separated by the prediction"
                )
        g0, g1, h00, h01, h11 = self.now[:5]
        det = h00 * h11 - h01 * h01
        if not math.isfinite(det) or det <= 1e-14 * max(h00 * h11, 1e-300):
            raise self._error("the outcome is separated by the prediction")
        self.direction = ((h11 * g0 - h01 * g1) / det, (h00 * g1 - h01 * g0) / det)
        self.scale, self.halvings = 1.0, 0

    def _error(self, why: str) -> ValueError:
        return ValueError(f"a logit has no fit ({self.key}): {why}")


def fit_logits(
    df: DataFrame, pairs: Mapping[str, tuple[ColumnLike, ColumnLike]], rounds: int = NEWTON_ROUNDS
) -> dict[str, tuple[float, float]]:
    """Intercept and slope of a logit for every named (outcome, prediction)
    pair of columns, by Newton's method.

    All pairs go through the same rounds: they are unfolded into rows, and equal
    rows are combined into one with a count, as many rows of a sparse panel get
    the same prediction. A round is one aggregate of a few sums per pair; only
    these reach the driver. A step that lowers the likelihood is halved. A
    constant prediction gets slope 0 and the outcome's mean. An error is raised
    where there is no fit: on a constant outcome, on outcomes that the
    prediction separates, and when the rounds run out.
    """
    cells = [
        F.struct(
            F.lit(key).alias("key"),
            as_column(y).cast("double").alias("y"),
            as_column(x).cast("double").alias("x"),
        )
        for key, (y, x) in pairs.items()
    ]
    rows = (
        df.select(F.explode(F.array(*cells)).alias("cell"))
        .groupBy("cell.key", "cell.y", "cell.x")
        .agg(F.count(F.lit(1)).cast("double").alias("n"))
        .persist()
    )
    fits = {key: _Newton(key) for key in pairs}
    try:
        while open_fits := [f for f in fits.values() if not f.done]:
            tried = F.create_map(
                *[c for f in open_fits for c in (F.lit(f.key), F.array(*map(F.lit, f.trial)))],
            )[F.col("key")]
            eta = tried[0] + tried[1] * F.col("x")
            p = logodds_to_prob(eta)
            w = p * (F.lit(1.0) - p)
            # log(1 + exp(eta)) without overflow
            soft = F.greatest(eta, F.lit(0.0)) + F.log1p(F.exp(-F.abs(eta)))
            n, x, y = F.col("n"), F.col("x"), F.col("y")
            miss = n * (y - p)
            got = (
                rows.filter(F.col("key").isin([f.key for f in open_fits]))
                .groupBy("key")
                .agg(
                    F.sum(miss),
                    F.sum(miss * x),
                    F.sum(n * w),
                    F.sum(n * w * x),
                    F.sum(n * w * x * x),
                    F.sum(n * (y * eta - soft)),
                    F.sum(n * y) / F.sum(n),
                )
            )
            sums = {r[0]: r[1:] for r in got.collect()}
            for f in open_fits:
                if f.key not in sums or sums[f.key][5] is None:
                    raise ValueError(f"there are no rows to calibrate on ({f.key})")
                f.take(sums[f.key], rounds)
        return {key: f.best for key, f in fits.items()}
    finally:
        rows.unpersist()


def fit_logit(df: DataFrame, y: str, x: str, rounds: int = NEWTON_ROUNDS) -> tuple[float, float]:
    """`fit_logits` for one pair."""
    return fit_logits(df, {x: (y, x)}, rounds)[x]


def check_probabilities(df: DataFrame, cols: Sequence[str], what: str) -> None:
    """Raise on a missing value or one outside [0, 1], by one aggregate."""
    bad = df.agg(
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"m{i}") for i, c in enumerate(cols)],
        *[F.count(F.when(~F.col(c).between(0, 1), 1)).alias(f"o{i}") for i, c in enumerate(cols)],
    ).first()
    for i, c in enumerate(cols):
        if bad[f"m{i}"]:
            raise ValueError(f"{what}: {bad[f'm{i}']} missing values in {c}")
        if bad[f"o{i}"]:
            raise ValueError(f"{what}: {c} has values outside [0, 1]")


def calibrate_prob_columns(
    test: DataFrame, calib: DataFrame, cols: Mapping[str, tuple[str, str, str]], check: bool = True
) -> DataFrame:
    """Logits of the outcome on the log-odds of the prediction, applied to test.

    `cols` maps a new column to the test prediction, the calibration prediction
    and the outcome. All columns are checked by one aggregate on either frame
    and fitted together.
    """
    if check:
        check_probabilities(calib, sorted({c for _, *pair in cols.values() for c in pair}), "calibration period")
        check_probabilities(test, sorted({t for t, _, _ in cols.values()}), "test period")
    fits = fit_logits(calib, {o: (y, prob_to_logodds(p)) for o, (_, p, y) in cols.items()})
    for out, (_, pred, _) in cols.items():
        if fits[out][1] < 0:
            warnings.warn(f"the slope for {pred} is negative, a very weak model?")

    def fitted(out: str, pred: str) -> Column:
        b0, b1 = fits[out]
        return logodds_to_prob(F.lit(b0) + F.lit(b1) * prob_to_logodds(pred)).alias(out)

    return test.select("*", *[fitted(o, c[0]) for o, c in cols.items()])


def calibrate_prob(
    test: DataFrame,
    test_pred: str,
    calib: DataFrame,
    calib_pred: str,
    actual: str,
    out: str,
    check: bool = True,
) -> DataFrame:
    """`calibrate_prob_columns` for one prediction."""
    return calibrate_prob_columns(test, calib, {out: (test_pred, calib_pred, actual)}, check)
