"""Filling missing values inside a panel."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions.windows import forward_fill
from panelwright.lineage import Rounds
from panelwright.operators.joins import left_join_keeping_rows
from panelwright.operators.ranking import draw_with_replacement, take_share, uniform
from panelwright.operators.reshape import clip_to_observed, numeric_columns, union_all
from panelwright.operators.shape import between_times
from panelwright.panel import Panel

# How close to the threshold counts as being on it.
CLOSE_ABSOLUTE, CLOSE_RELATIVE = 1e-8, 1e-5
# Columns up to which their products are summed by an expression per pair.
FEW_COLUMNS = 8


def extrapolate(df: DataFrame, panel: Panel, cols: Sequence[str] | None = None) -> DataFrame:
    """Linear between observed values by row position, nearest value outside.

    Works inside each group; a group without any value stays missing. The last
    observed value is read in both directions with running frames, so the work
    is linear in the length of a series, and all columns share the two sorts.
    """
    cols = numeric_columns(df, panel.keys) if cols is None else list(cols)
    up = panel.rows(Window.unboundedPreceding, 0)
    down = (
        Window.partitionBy(panel.group)
        .orderBy(F.desc(panel.time))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    placed = df.withColumn("_at", F.row_number().over(panel.window()))

    def seen(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.struct(F.col("_at").alias("at"), F.col(c).cast("double").alias("v")))

    marked = placed.select(
        "*",
        *[F.last(seen(c), ignorenulls=True).over(up).alias(f"_before_{c}") for c in cols],
        *[F.last(seen(c), ignorenulls=True).over(down).alias(f"_after_{c}") for c in cols],
    )

    def filled(c: str) -> Column:
        a, b = F.col(f"_before_{c}"), F.col(f"_after_{c}")
        slope = F.try_divide(b["v"] - a["v"], (b["at"] - a["at"]).cast("double"))
        line = a["v"] + slope * (F.col("_at") - a["at"])
        return F.coalesce(F.col(c).cast("double"), line, a["v"], b["v"])

    return marked.select(
        *[filled(c).alias(c) if c in cols else F.col(c) for c in df.columns]
    )


def fill_groups_with_time_means(
    df: DataFrame, panel: Panel, cols: Sequence[str] | None = None
) -> DataFrame:
    """Give groups without any value the mean of each time.

    Only numeric columns are filled, but a value in any column keeps a group
    from being filled. Means are one row per time.
    """
    values = panel.values(df)
    cols = numeric_columns(df, panel.keys) if cols is None else list(cols)
    any_value = F.max(F.coalesce(*values).isNotNull() if len(values) == 1 else F.greatest(*[F.col(c).isNotNull() for c in values]))
    means = df.groupBy(panel.time).agg(*[F.avg(c).alias(f"_mean_{c}") for c in cols])
    flagged = df.withColumn("_has", any_value.over(Window.partitionBy(panel.group)))
    joined = flagged.join(means, panel.time, "left")
    return joined.select(
        *[
            F.when(F.col("_has"), F.col(c).cast("double")).otherwise(F.col(f"_mean_{c}")).alias(c)
            if c in cols
            else F.col(c)
            for c in df.columns
        ]
    )


def fill_with_group_and_global_means(
    df: DataFrame, panel: Panel, cols: Sequence[str] | None = None
) -> DataFrame:
    """Group mean first, then the mean of the column as filled so far."""
    cols = numeric_columns(df, panel.keys) if cols is None else list(cols)
    whole = Window.partitionBy(panel.group)
    filled = df.select(
        *[
            F.coalesce(F.col(c).cast("double"), F.avg(c).over(whole)).alias(c)
            if c in cols
            else F.col(c)
            for c in df.columns
        ]
    )
    means = filled.agg(F.struct(*[F.avg(c).alias(c) for c in cols])).scalar()
    return filled.select(
        *[F.coalesce(F.col(c), means[c]).alias(c) if c in cols else F.col(c) for c in df.columns]
    )


def forward_fill_then_zero(
    df: DataFrame, panel: Panel, fill: Sequence[str], zero: Sequence[str]
) -> DataFrame:
    """Forward-fill some columns, then set what is missing in others to 0."""
    filled = df.select(
        *[forward_fill(c, panel).alias(c) if c in fill else F.col(c) for c in df.columns]
    )
    return filled.select(
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) if c in zero else F.col(c) for c in df.columns]
    )


# --- chained equations -----------------------------------------------------


def _gram(rows: DataFrame) -> np.ndarray:
    """Sums of products of all pairs of columns: one expression per pair while
    they are few, a packed array per task beyond."""
    names = rows.columns
    if len(names) <= FEW_COLUMNS:
        pairs = [(i, j) for i in range(len(names)) for j in range(i + 1)]
        sums = rows.agg(*[F.sum(F.col(names[i]) * F.col(names[j])) for i, j in pairs]).first()
        gram = np.zeros((len(names), len(names)))
        for (i, j), value in zip(pairs, sums):
            gram[i, j] = gram[j, i] = value
        return gram
    vectors = VectorAssembler(inputCols=rows.columns, outputCol="_row").transform(rows).select("_row")
    matrix = RowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "_row"), numCols=len(rows.columns))
    return matrix.computeGramianMatrix().toArray()


def _linear(
    state: DataFrame,
    panel: Panel,
    col: str,
    others: Sequence[str],
    centres: dict[str, float],
    draw: tuple[int, int, int] | None,
) -> Column:
    """A Bayesian linear regression of a column on the others, as the column
    that fills its gaps.

    The Gram matrix of all columns is summed up packed, one array per task and
    not an expression per pair; nothing else reaches the driver. With `draw`
    (seed, round, column) the coefficients are drawn from their posterior and
    every row gets noise of the residual's size; both depend on the draw and the
    row's key alone. Without it the coefficients are those of least squares, of
    least norm where they are not unique.
    """
    names = [*others, col]
    x = {c: F.col(f"_x_{c}") - F.lit(centres[c]) for c in names}
    gram = _gram(state.filter(~F.col(f"_gap_{col}")).select(F.lit(1.0).alias("_one"), *[x[c].alias(c) for c in names]))
    n = gram[0, 0]
    # Scaled, so that columns of different units weigh the same.
    unit = np.sqrt(np.where(np.diag(gram) > 0, np.diag(gram), 1.0))
    left = gram[:-1, :-1] / np.outer(unit[:-1], unit[:-1])
    inverse = np.linalg.pinv(left, rcond=1e-12, hermitian=True)
    weights = inverse @ (gram[:-1, -1] / unit[:-1])
    noise = F.lit(0.0)
    if draw is not None:
        spent = gram[-1, -1] - weights @ (gram[:-1, -1] / unit[:-1])
        sigma = float(np.sqrt(max(spent, 0.0) / max(1, n - len(names))))
        values, vectors = np.linalg.eigh((inverse + inverse.T) / 2)
        normal = np.random.default_rng(draw).standard_normal(len(values))
        weights = weights + sigma * (vectors * np.sqrt(np.maximum(values, 0.0))) @ normal
        # Two uniform numbers of the row make a normal one.
        u, v = (uniform(*[F.col(k) for k in panel.keys], F.lit(f"{c}|{draw[2]}"), draw[0], draw[1]) for c in "uv")
        noise = F.lit(sigma) * F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - u)) * F.cos(F.lit(2 * np.pi) * v)
    weights = weights / unit[:-1]
    guess = F.lit(centres[col] + float(weights[0])) + noise
    for c, w in zip(others, weights[1:]):
        guess = guess + F.lit(float(w)) * x[c]
    return guess


def _tree(state: DataFrame, col: str, others: Sequence[str], seed: int) -> tuple[DataFrame, Column]:
    """One unbagged tree that looks at the square root of the features."""
    assembler = VectorAssembler(inputCols=[f"_x_{o}" for o in others], outputCol="_features")
    rows = assembler.transform(state)
    regressor = RandomForestRegressor(
        numTrees=1, bootstrap=False, featureSubsetStrategy="sqrt", seed=seed, maxDepth=10,
        featuresCol="_features", labelCol=f"_x_{col}", predictionCol="_guess",
    )
    return regressor.fit(rows.filter(~F.col(f"_gap_{col}"))).transform(rows), F.col("_guess")


def impute_chained(
    df: DataFrame,
    panel: Panel,
    cols: Sequence[str] | None = None,
    seed: int = 0,
    max_iter: int = 10,
    estimator: str = "linear",
    draws: bool = True,
) -> DataFrame:
    """One imputation by chained equations.

    Missing cells start at the column mean; then, column by column from the
    one with the fewest gaps, a regression on all other columns is fitted on
    the observed rows and predicts the gaps, for `max_iter` rounds. With
    `draws` the linear regression fills in draws from its posterior, so that
    imputations of different seeds differ by what the data leave open; without,
    its best guess. Fitting and predicting are Spark jobs over the whole panel.
    The columns that take part are written once a round, and the copy before is
    removed. Results are bounded by the observed range; columns that are not
    numeric or have no value at all are left alone.
    """
    if estimator not in ("linear", "tree"):
        raise ValueError(f"unknown estimator {estimator}, know linear and tree")
    cols = numeric_columns(df, panel.keys) if cols is None else list(cols)
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in cols]
    ).first()
    cols = [c for c in cols if counts[c] > 0]
    gaps = {c: counts["_rows"] - counts[c] for c in cols}
    order = sorted((c for c in cols if gaps[c] > 0), key=lambda c: (gaps[c], c))
    if not order or len(cols) < 2:
        return df
    centres = df.agg(*[F.avg(c).alias(c) for c in cols]).first().asDict()
    state = df.select(
        *panel.keys,
        *[F.col(c).isNull().alias(f"_gap_{c}") for c in order],
        *[F.coalesce(F.col(c).cast("double"), F.lit(centres[c])).alias(f"_x_{c}") for c in cols],
    )
    kept = Rounds(df.sparkSession, "imputation")
    state = kept.put(state)
    names = state.columns
    for round_no in range(max_iter):
        for i, c in enumerate(order):
            others = [o for o in cols if o != c]
            if estimator == "linear":
                draw = (seed, round_no, i) if draws else None
                rows, guess = state, _linear(state, panel, c, others, centres, draw)
            else:
                tree_seed = int(np.random.default_rng((seed, round_no, i)).integers(1 << 62))
                rows, guess = _tree(state, c, others, tree_seed)
            filled = F.when(F.col(f"_gap_{c}"), guess).otherwise(F.col(f"_x_{c}"))
            state = rows.withColumn(f"_x_{c}", filled).select(*names)
        state = kept.put(state)
    done = state.select(*panel.keys, *[F.col(f"_x_{c}").alias(f"_done_{c}") for c in order])
    joined = df.join(done, panel.keys, "left")
    filled = joined.select(
        *[F.coalesce(F.col(c).cast("double"), F.col(f"_done_{c}")).alias(c) if c in order else F.col(c) for c in df.columns]
    )
    return clip_to_observed(filled, df, order)


def imputations(
    df: DataFrame, panel: Panel, n: int, estimator: str = "linear", **options
) -> Iterator[DataFrame]:
    """n imputations that differ by seed."""
    for seed in range(n):
        yield impute_chained(df, panel, seed=seed, estimator=estimator, **options)


def impute_window_extrapolate_rest(
    df: DataFrame,
    panel: Panel,
    first: int,
    last: int,
    seed: int = 0,
    estimator: str = "tree",
    max_iter: int = 10,
    draws: bool = True,
) -> DataFrame:
    """Fill a window of years completely, then carry it to all other years.

    Inside the window: groups without data get time means, gaps are
    interpolated, what is left is imputed. The result is put back on all rows
    of the frame and extrapolated.
    """
    inside = between_times(df, panel.time, first, last)
    inside = extrapolate(fill_groups_with_time_means(inside, panel), panel)
    inside = impute_chained(inside, panel, None, seed, max_iter, estimator, draws)
    full = left_join_keeping_rows(df.select(*panel.keys), inside, panel.keys)
    return extrapolate(full, panel)


# --- class-aware resampling ------------------------------------------------


def on_threshold(cols: Sequence[str], threshold: float) -> Column:
    """Whether any of the columns is at the threshold; a missing one is not."""
    tolerance = CLOSE_ABSOLUTE + CLOSE_RELATIVE * abs(threshold)
    near = [
        F.coalesce(F.abs(F.col(c) - F.lit(threshold)) <= tolerance, F.lit(False)) for c in cols
    ]
    return near[0] if len(near) == 1 else F.greatest(*near)


def resample(
    df: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    share_positive: float = 1.0,
    share_negative: float = 1.0,
    threshold: float = 0,
    seed: int = 1,
) -> DataFrame:
    """Exactly share x n rows of the positives and of the negatives.

    A negative row has any of the columns at the threshold. A share above 1
    draws with replacement. Which rows are drawn depends on their key and the
    seed alone.
    """
    if share_positive == 1 and share_negative == 1:
        return df
    marked = df.withColumn("_negative", on_threshold(cols, threshold))
    shares = {False: float(share_positive), True: float(share_negative)}
    parts = []
    fewer = [negative for negative, share in shares.items() if share <= 1]
    if fewer:
        share = F.when(F.col("_negative"), shares[True]).otherwise(shares[False])
        rows = marked.filter(F.col("_negative").isin(fewer))
        parts.append(take_share(rows, share, keys, seed, by=["_negative"]))
    for negative, share in shares.items():
        if share > 1:
            rows = marked.filter(F.col("_negative") == negative)
            parts.append(draw_with_replacement(rows, share, keys, seed))
    return union_all([part.select(*df.columns) for part in parts])
