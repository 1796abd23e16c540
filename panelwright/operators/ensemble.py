"""Combining the predictions of several models."""

from __future__ import annotations

import math
import warnings
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions.scalars import (
    clip_unit,
    logodds_to_prob,
    prob_to_logodds,
    row_mean,
)
from panelwright.operators.calibration import fit_logits

# Tolerance, shrinkage exponent, weight floor, largest number of
# rounds.
EBMA_TOLERANCE = 0.001
EBMA_SHRINKAGE = 3
EBMA_CONST = 0.01
EBMA_MAX_ITER = 10_000

# Of the series that stands in for passes over the rows: largest degree, sums of a
# pass at most, and what the series may leave out, as a part of the whole.
EBMA_DEGREE, EBMA_SUMS, EBMA_SERIES_ERROR = 8, 64, 1e-11


def average(df: DataFrame, cols: Sequence[str], out: str) -> DataFrame:
    """Unweighted mean of the constituents that are present."""
    return df.withColumn(out, row_mean(cols))


def equal_weights(names: Sequence[str]) -> dict[str, float]:
    return {n: 1 / len(names) for n in names}


def shrunk_logodds(p: Column, exponent: float) -> Column:
    """Log-odds pulled towards 0: sign(l) * ((1 + |l|)^(1/exponent) - 1)."""
    l = prob_to_logodds(p)
    return F.signum(l) * (F.pow(F.lit(1.0) + F.abs(l), F.lit(1.0 / exponent)) - 1)


@dataclass(frozen=True)
class Ebma:
    """A fitted mixture: per model a logit of shrunk log-odds and a weight."""

    cols: tuple[str, ...]
    intercepts: tuple[float, ...]
    slopes: tuple[float, ...]
    weights: tuple[float, ...]
    exponent: float
    rounds: int
    log_likelihood: float

    def adjusted(self, i: int) -> Column:
        x = shrunk_logodds(F.col(self.cols[i]), self.exponent)
        return logodds_to_prob(F.lit(self.intercepts[i]) + F.lit(self.slopes[i]) * x)

    def predict(self, df: DataFrame, out: str) -> DataFrame:
        mixed = sum(
            (self.adjusted(i) * F.lit(w) for i, w in enumerate(self.weights)), F.lit(0.0)
        )
        return df.withColumn(out, mixed)


def powers(size: int, most: int) -> list[tuple[int, ...]]:
    """All exponents of `size` variables whose sum is `most` or less."""
    if not size:
        return [()]
    return [(i, *rest) for i in range(most + 1) for rest in powers(size - 1, most - i)]


def degree(models: int) -> int:
    """Of the series that rounds are taken from: as far as EBMA_SUMS sums go."""
    fits = [d for d in range(1, EBMA_DEGREE + 1) if math.comb(models - 1 + d, d) <= EBMA_SUMS]
    return max(fits, default=1)


def em_sums(rows: DataFrame, likelihoods: Sequence[str], weights: Sequence[float], most: int) -> DataFrame:
    """One row of sums at some weights, over rows with a count `n`: the
    log-likelihood, the largest relative excess of each model but the last over the
    last one, and the sums of all products of these excesses up to degree `most`.
    Powers are columns of their own, so that a sum is a short expression."""
    g, size = [F.col(c) for c in likelihoods], len(likelihoods) - 1
    total = sum((F.lit(w) * c for w, c in zip(weights, g)), F.lit(0.0))
    rows = rows.select("n", *likelihoods, total.alias("total"))
    rows = rows.select(
        "n", F.log("total").alias("like"), *[((c - g[-1]) / F.col("total")).alias(f"e{m}_1") for m, c in enumerate(g[:-1])]
    )
    for i in range(2, most + 1):
        rows = rows.select("*", *[(F.col(f"e{m}_{i - 1}") * F.col(f"e{m}_1")).alias(f"e{m}_{i}") for m in range(size)])

    def product(exponents: Sequence[int]) -> Column:
        return reduce(lambda a, b: a * b, [F.col(f"e{m}_{i}") for m, i in enumerate(exponents) if i], F.col("n"))

    return rows.agg(
        F.sum(F.col("n") * F.col("like")),
        *[F.max(F.abs(f"e{m}_1")) for m in range(size)],
        *[F.sum(product(exponents)) for exponents in powers(size, most)],
    )


class EmSeries:
    """The log-likelihood near the weights `start` as a power series in the change
    of the weights, from the sums of `em_sums`. A row's likelihood changes by the
    factor 1 + u, where u is the change times the row's excesses; `holds` tells
    whether |u| is so small for every row that what the series leaves out is below
    a part in 10^11."""

    def __init__(self, start: Sequence[float], sums: Sequence[float], most: int) -> None:
        size = len(start) - 1
        self.start, self.like, self.largest, self.most = start, sums[0], sums[1 : 1 + size], most
        self.sums = dict(zip(powers(size, most), sums[1 + size :]))
        self.rows = self.sums[(0,) * size]
        self.radius = EBMA_SERIES_ERROR ** (1 / most)

    def holds(self, weights: Sequence[float]) -> bool:
        change = (abs(w - s) for w, s in zip(weights, self.start))
        return sum(c * l for c, l in zip(change, self.largest)) <= self.radius

    def at(self, weights: Sequence[float]) -> tuple[float, list[float]]:
        """(log-likelihood, mean responsibility of each model)."""
        change = [w - s for w, s in zip(weights, self.start)][:-1]
        like, slopes = self.like, [0.0] * len(change)
        for exponents, total in self.sums.items():
            order = sum(exponents)
            if not order:
                continue
            ways = math.factorial(order) / math.prod(map(math.factorial, exponents))
            factor = (-1) ** (order + 1) / order * ways * total
            like += factor * math.prod(c**i for c, i in zip(change, exponents))
            for m, i in enumerate(exponents):
                if i:
                    lower = [j - (k == m) for k, j in enumerate(exponents)]
                    slopes[m] += factor * i * math.prod(c**j for c, j in zip(change, lower))
        # The responsibilities of a row sum to one.
        last = self.rows - sum(w * slope for w, slope in zip(weights, slopes))
        return like, [w * (slope + last) / self.rows for w, slope in zip(weights, [*slopes, 0.0])]


def fit_weights(
    df: DataFrame,
    cols: Sequence[str],
    actual: str,
    tolerance: float = EBMA_TOLERANCE,
    const: float = EBMA_CONST,
    max_iter: int = EBMA_MAX_ITER,
) -> tuple[list[float], int, float]:
    """Mixture weights by EM from equal ones.

    Rows with the same likelihoods are first combined into one with a count; rows
    without a prediction do not count. One aggregate over these cached rows serves
    as many rounds as its power series holds for, a round at least; the rounds and
    where they stop are those of plain EM. The sums are all that reaches the driver.
    """
    y = F.col(actual).cast("double")
    hit = [
        F.when(y == 1, clip_unit(c)).otherwise(F.lit(1.0) - clip_unit(c)).alias(f"g{i}")
        for i, c in enumerate(cols)
    ]
    rows = df.groupBy(*hit).agg(F.count(F.lit(1)).cast("double").alias("n")).dropna().persist()
    most, size = degree(len(cols)), len(cols)
    likelihoods = [f"g{i}" for i in range(size)]
    try:
        weights, before, series = [1.0 / size] * size, None, None
        for rounds in range(1, max_iter + 1):
            if series is None or not series.holds(weights):
                sums = list(em_sums(rows, likelihoods, weights, most).first())
                if sums[0] is None:
                    raise ValueError("there are no rows to weigh models on")
                series = EmSeries(weights, sums, most)
            like, shares = series.at(weights)
            weights = [const / size + (1 - const) * share for share in shares]
            if before is not None and abs(like - before) < tolerance:
                break
            change, before = like - (before or 0.0), like
        else:
            warnings.warn(f"weights have not settled after {max_iter} rounds, the last change was {change:.3g}")
        return weights, rounds, like
    finally:
        rows.unpersist()


def fit_ebma(
    calib: DataFrame,
    cols: Sequence[str],
    actual: str,
    tolerance: float = EBMA_TOLERANCE,
    shrinkage: float = EBMA_SHRINKAGE,
    const: float = EBMA_CONST,
    max_iter: int = EBMA_MAX_ITER,
) -> Ebma:
    """Ensemble Bayesian model averaging for binary outcomes.

    Built from the published method: every constituent is corrected by a logit
    of the outcome on its shrunk log-odds, then the weights of the mixture of
    the corrected probabilities are found by EM; `const` keeps a small equal
    share for every model. Probabilities are clipped to the open interval.
    """
    fits = fit_logits(calib, {c: (actual, shrunk_logodds(F.col(c), shrinkage)) for c in cols})
    intercepts, slopes = tuple(fits[c][0] for c in cols), tuple(fits[c][1] for c in cols)
    start = Ebma(tuple(cols), intercepts, slopes, (), shrinkage, 0, 0.0)
    adjusted = calib.select(actual, *[start.adjusted(i).alias(f"_p{i}") for i in range(len(cols))])
    weights, rounds, like = fit_weights(
        adjusted, [f"_p{i}" for i in range(len(cols))], actual, tolerance, const, max_iter
    )
    return Ebma(tuple(cols), intercepts, slopes, tuple(weights), shrinkage, rounds, like)


def cross_level(
    high: DataFrame,
    low: DataFrame,
    time: str,
    area: str,
    high_col: str,
    low_col: str,
    out: str,
    max_missing: float = 0.01,
    check: bool = True,
) -> DataFrame:
    """Share an area's probability out over its cells.

    A cell gets the area's probability times its part of the sum of the cells'
    probabilities. The sums are combined before the shuffle and joined back,
    so an area with very many cells is not gathered in one task. What is
    missing afterwards becomes the mean; more than `max_missing` of it is an
    error unless `check` is off.
    """
    sums = high.groupBy(time, area).agg(F.sum(high_col).alias("_sum"))
    areas = sums.join(low.select(time, area, F.col(low_col).alias("_low")), [time, area], "left")
    joined = high.join(areas, [time, area], "left")
    shared = joined.withColumn(
        "_joint", F.col("_low") * F.try_divide(F.col(high_col), F.col("_sum"))
    )
    if check:
        share = shared.agg(F.avg(F.col("_joint").isNull().cast("double"))).first()[0]
        if share is not None and share > max_missing:
            raise ValueError(f"{share:.1%} of the cells have no cross-level value")
    mean = shared.agg(F.avg("_joint")).scalar()
    return shared.select(*high.columns, F.coalesce("_joint", mean).alias(out))
