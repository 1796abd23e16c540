"""Step-ahead models and ensembles with MLlib estimators."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.lineage import stored
from panelwright.operators import ensemble as mixing
from panelwright.operators.calibration import calibrate_prob_columns, calibrate_real_columns
from panelwright.operators.evaluation import (
    accuracy,
    actual_outcome,
    evaluate,
    evaluation_frame,
    r2,
)
from panelwright.operators.forecast import (
    Downsampling,
    combine_steps,
    permuted,
    shift_features,
    step_predictions,
    training_frame,
)
from panelwright.operators.reshape import union_all
from panelwright.panel import Panel, Period, predict_ranges_disjoint, require_columns
from panelwright.sources.versions import new_version, read_manifest, seal, versions

PERMUTATION_REPEATS = 10


@dataclass
class StepModel:
    """What is needed to train, predict, calibrate and score one model.

    Prediction columns are `ss_<name>_<step>` per step and `sc_<name>` for the
    step-combined one, each with `_calibrated` appended after calibration.
    """

    name: str
    col_outcome: str
    cols_features: list[str]
    steps: list[int]
    outcome_type: str
    periods: list[Period] = field(default_factory=list)
    estimator: Estimator | None = None
    downsampling: Downsampling | None = None
    delta_outcome: bool = False
    onset_outcome: bool = False
    onset_window: int | None = None
    panel: Panel = field(default_factory=Panel)
    tags: list[str] = field(default_factory=list)
    fitted: dict[tuple[str, int], PipelineModel] = field(default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        if self.outcome_type not in ("real", "prob"):
            raise NotImplementedError(f"outcome_type {self.outcome_type} is not known")
        if len(set(self.cols_features)) != len(self.cols_features):
            raise TypeError(f"duplicate features in {self.cols_features}")
        self.cols_features = sorted(self.cols_features)
        if self.onset_outcome:
            if self.delta_outcome:
                raise TypeError("an outcome is either a delta or an onset")
            if not self.onset_window:
                raise TypeError("an onset outcome needs an onset window")
            if self.outcome_type != "prob":
                raise TypeError("an onset outcome is a probability")
        if not predict_ranges_disjoint(self.periods):
            warnings.warn(f"predict ranges of {self.name} overlap")

    # names
    @property
    def cols_ss(self) -> dict[int, str]:
        return {s: f"ss_{self.name}_{s}" for s in self.steps}

    @property
    def cols_ss_calibrated(self) -> dict[int, str]:
        return {s: f"{c}_calibrated" for s, c in self.cols_ss.items()}

    @property
    def col_sc(self) -> str:
        return f"sc_{self.name}"

    @property
    def col_sc_calibrated(self) -> str:
        return f"{self.col_sc}_calibrated"

    @property
    def window(self) -> int | None:
        return self.onset_window if self.onset_outcome else None

    # training
    def training_frame(self, df: DataFrame, period: Period, step: int) -> DataFrame:
        return training_frame(
            df,
            self.panel,
            self.cols_features,
            self.col_outcome,
            period,
            step,
            self.delta_outcome,
            self.window,
            self.downsampling,
        )

    def fit(self, df: DataFrame, parallelism: int = 4) -> "StepModel":
        """Fit one estimator per period and step, a few at the same time."""
        require_columns(df, [*self.cols_features, self.col_outcome], self.name)
        if not self.periods:
            raise ValueError(f"{self.name} has no periods")
        if self.estimator is None:
            raise ValueError(f"{self.name} has no estimator")
        # Laid out by group and time once, so that no fit shuffles or sorts.
        used = (
            df.select(*self.panel.keys, *sorted({*self.cols_features, self.col_outcome}))
            .repartition(self.panel.group)
            .sortWithinPartitions(self.panel.group, self.panel.time)
            .persist()
        )
        jobs = [(p, s) for p in self.periods for s in self.steps]
        try:
            # Fits are independent; a few at a time keep a cluster busy.
            with ThreadPool(min(parallelism, len(jobs))) as pool:
                done = pool.map(
                    inheritable_thread_target(used.sparkSession)(
                        lambda job: self._fit_one(used, *job)
                    ),
                    jobs,
                )
        finally:
            used.unpersist()
        self.fitted.update({(p.name, s): m for (p, s), m in zip(jobs, done)})
        return self

    def _fit_one(self, df: DataFrame, period: Period, step: int) -> PipelineModel:
        assembler = VectorAssembler(inputCols=self.cols_features, outputCol="features")
        estimator = self.estimator.copy(
            {
                self.estimator.featuresCol: "features",
                self.estimator.labelCol: self.col_outcome,
            }
        )
        rows = self.training_frame(df, period, step).withColumn(
            self.col_outcome, F.col(self.col_outcome).cast("double")
        )
        return Pipeline(stages=[assembler, estimator]).fit(rows)

    # prediction
    def _score(self, period: Period):
        def score(rows: DataFrame) -> tuple[DataFrame, dict[int, Column]]:
            """The rows with what the models of all steps add, and the column
            of each step's prediction; the features are put together once."""
            rows = VectorAssembler(
                inputCols=self.cols_features, outputCol="_features", handleInvalid="keep"
            ).transform(rows)
            columns = {}
            for step in self.steps:
                if (period.name, step) not in self.fitted:
                    raise ValueError(f"{self.name} is not fitted for {period.name} step {step}")
                model = self.fitted[period.name, step].stages[-1]
                names = {p: f"_{p}_{step}" for p in ("predictionCol", "probabilityCol", "rawPredictionCol") if model.hasParam(p)}
                own = model.copy({model.getParam(p): name for p, name in names.items()})
                own = own.copy({own.getParam("featuresCol"): "_features"})
                rows = own.transform(rows)
                columns[step] = F.col(names["predictionCol"])
                if self.outcome_type == "prob":
                    columns[step] = vector_to_array(names["probabilityCol"])[1]
            return rows, columns

        return score

    def _chosen(self, period: Period | None, periods: Sequence[Period] | None) -> list[Period]:
        if period and periods:
            raise TypeError("give a period or periods, not both")
        return [period] if period else list(periods or self.periods)

    def _check_training_times(self, period: Period) -> None:
        own = [p for p in self.periods if p.name == period.name]
        if not own:
            raise ValueError(f"{self.name} has no period {period.name}")
        if (own[0].train_start, own[0].train_end) != (period.train_start, period.train_end):
            warnings.warn(f"training times of period {period.name} differ")

    def predict(
        self,
        df: DataFrame,
        period: Period | None = None,
        periods: Sequence[Period] | None = None,
    ) -> DataFrame:
        """Step-specific and step-combined predictions of all chosen periods."""
        require_columns(df, self.cols_features, self.name)
        frames = []
        for p in self._chosen(period, periods):
            self._check_training_times(p)
            wide = step_predictions(
                df, self.panel, self.cols_features, p, self.steps, self._score(p), self.cols_ss
            )
            frames.append(combine_steps(wide, self.panel, self.cols_ss, p, self.col_sc))
        return union_all(frames)

    def predict_calibrated(
        self,
        df: DataFrame,
        period_calib: Period,
        period_test: Period,
        col_outcome: str | None = None,
    ) -> DataFrame:
        """Test predictions calibrated on the outcomes of the other period."""
        calib = self.predict(df, period=period_calib)
        test = self.predict(df, period=period_test)
        return self.calibrate(df, calib, test, period_calib, period_test, col_outcome)

    def calibrate(
        self,
        df: DataFrame,
        calib: DataFrame,
        test: DataFrame,
        period_calib: Period,
        period_test: Period,
        col_outcome: str | None = None,
    ) -> DataFrame:
        """Calibrate given predictions.

        Outcomes are transformed on the whole panel and then cut, so the first
        calibration times see the rows before them.
        """
        outcome = col_outcome or self.col_outcome
        actuals = df.select(
            *self.panel.keys,
            *[
                actual_outcome(outcome, self.panel, self.delta_outcome, self.window, s)
                .cast("double")
                .alias(f"_actual_{s}")
                for s in self.steps
            ],
        ).filter(period_calib.in_predict(F.col(self.panel.time)))
        known = calib.select(*self.panel.keys, *self.cols_ss.values()).join(
            actuals, self.panel.keys, "full"
        )
        out = test.select(*self.panel.keys, *self.cols_ss.values())
        if self.outcome_type == "real":
            out = calibrate_real_columns(
                out,
                known,
                {
                    self.cols_ss_calibrated[s]: (self.cols_ss[s], self.cols_ss[s], f"_actual_{s}")
                    for s in self.steps
                },
            )
        else:
            # All steps are checked and fitted together; the predictions are
            # written first, as scoring them again costs more than the fits.
            known, out = stored(known, "calibration"), stored(out, "test")
            out = calibrate_prob_columns(
                out,
                known,
                {
                    self.cols_ss_calibrated[s]: (self.cols_ss[s], self.cols_ss[s], f"_actual_{s}")
                    for s in self.steps
                },
            )
        out = out.select(*self.panel.keys, *self.cols_ss_calibrated.values())
        return combine_steps(
            out, self.panel, self.cols_ss_calibrated, period_test, self.col_sc_calibrated
        )

    # scores
    def evaluate(self, df: DataFrame, periods: Sequence[Period] | None = None) -> DataFrame:
        """period, step, variant, metric, value over all prediction columns."""
        return evaluate_predictions(self, df, periods)

    # what the estimators learned
    def _learned(self, df_spark: SparkSession, attribute: str, name: str) -> DataFrame:
        rows = []
        for (period, step), pipeline in self.fitted.items():
            values = getattr(pipeline.stages[-1], attribute).toArray()
            rows += [
                (period, step, f, float(v)) for f, v in zip(self.cols_features, values)
            ]
        return df_spark.createDataFrame(rows, f"period string, step int, feature string, {name} double")

    def feature_importances(self, spark: SparkSession) -> DataFrame:
        """Impurity importances per period, step and feature (tree models)."""
        return self._learned(spark, "featureImportances", "importance")

    def coefficients(self, spark: SparkSession) -> DataFrame:
        """Coefficients per period, step and feature (linear models)."""
        return self._learned(spark, "coefficients", "coefficient")

    def permutation_importance(
        self, df: DataFrame, period: Period, step: int, repeats: int = PERMUTATION_REPEATS, seed: int = 1
    ) -> DataFrame:
        """Mean drop of the score when a feature is shuffled, on train and test.

        The score is accuracy for classifiers and R2 for regressors. All
        repeats and features of a sample are scored by one aggregate.
        """
        pipeline = self.fitted[period.name, step]
        metric = accuracy if self.outcome_type == "prob" else r2
        shifted = shift_features(
            df, self.panel, self.cols_features, step, [F.col(self.col_outcome)]
        ).dropna()
        t = F.col(self.panel.time)
        results = []
        for sample, part in (("train", period.in_train(t)), ("test", period.in_predict(t))):
            rows = shifted.filter(part)
            plain = rows.withColumns({"feature": F.lit(""), "repeat": F.lit(-1)})
            shuffled = permuted(rows, self.panel, self.cols_features, repeats, seed)
            scored = pipeline.transform(union_all([plain, shuffled]))
            scores = scored.groupBy("feature", "repeat").agg(
                metric(F.col(self.col_outcome).cast("double"), F.col("prediction")).alias("score")
            )
            base = scores.filter("repeat < 0").agg(F.max("score")).scalar()
            results.append(
                scores.filter("repeat >= 0")
                .groupBy("feature")
                .agg((base - F.avg("score")).alias("importance"))
                .withColumn("sample", F.lit(sample))
            )
        return union_all(results)

    # persistence
    def describe(self) -> dict:
        return {
            "name": self.name,
            "col_outcome": self.col_outcome,
            "cols_features": self.cols_features,
            "steps": self.steps,
            "outcome_type": self.outcome_type,
            "periods": [asdict(p) for p in self.periods],
            "downsampling": asdict(self.downsampling) if self.downsampling else None,
            "delta_outcome": self.delta_outcome,
            "onset_outcome": self.onset_outcome,
            "onset_window": self.onset_window,
            "panel": asdict(self.panel),
            "tags": self.tags,
        }

    def save(self, spark: SparkSession, path: str) -> str:
        """Write every fitted estimator and the description as a new version
        under a folder of any file system that Spark can write, and return the
        folder of that version. The manifest comes last, so a version that was
        not written to its end is never loaded."""
        version = new_version(spark, path)
        for (period, step), pipeline in self.fitted.items():
            pipeline.write().save(f"{version}/fitted/{period}/{step}")
        seal(spark, version, self.describe() | {"fitted": [[p, s] for p, s in self.fitted]})
        return version

    @staticmethod
    def load(spark: SparkSession, path: str, version: str | None = None) -> "StepModel":
        """The latest finished version under `path`, or the one in the folder
        `version`; raises FileNotFoundError where there is none."""
        if version is None:
            finished = versions(spark, path)
            if not finished:
                raise FileNotFoundError(f"no finished version of a model under {path}")
            version = finished[-1]
        meta = read_manifest(spark, version)
        fitted = meta.pop("fitted")
        meta["periods"] = [Period(**p) for p in meta["periods"]]
        meta["panel"] = Panel(**meta["panel"])
        if meta["downsampling"]:
            meta["downsampling"] = Downsampling(**meta["downsampling"])
        model = StepModel(**meta)
        for period, step in fitted:
            model.fitted[period, step] = PipelineModel.load(f"{version}/fitted/{period}/{step}")
        return model


def evaluate_predictions(model, df: DataFrame, periods: Sequence[Period] | None = None) -> DataFrame:
    """Scores of every prediction column of a model or ensemble that is there.

    A combined prediction of a delta outcome is judged against step 1.
    """
    columns: dict[tuple, tuple[str, int]] = {}
    for variant, by_step, combined in (
        ("uncalibrated", model.cols_ss, model.col_sc),
        ("calibrated", model.cols_ss_calibrated, model.col_sc_calibrated),
    ):
        for s, c in by_step.items():
            if c in df.columns:
                columns[s, variant] = (c, s)
        if combined in df.columns:
            columns["sc", variant] = (combined, 1)
    pairs = evaluation_frame(
        df,
        model.panel,
        model.col_outcome,
        columns,
        periods or model.periods,
        is_delta=model.delta_outcome,
        onset_window=model.window,
    )
    return evaluate(
        pairs, ["period", "step", "variant"], model.outcome_type, model.delta_outcome
    )


@dataclass
class Ensemble:
    """Several models combined by average, Bayesian averaging or cross-level.

    `average` reads the calibrated predictions of its models, `ebma` the
    uncalibrated ones and the outcome. `crosslevel` shares the prediction of the
    second, coarser model out over the areas of the first; the column `area`
    names a cell's area and both models' predictions are on the same rows.
    """

    name: str
    models: list[StepModel]
    method: str
    outcome_type: str
    col_outcome: str
    periods: list[Period]
    panel: Panel = field(default_factory=Panel)
    area: str | None = None
    weights: dict[str, dict[int, dict[str, float]]] = field(default_factory=dict)
    delta_outcome: bool = False
    window: int | None = None

    def __post_init__(self) -> None:
        if self.method not in ("average", "ebma", "crosslevel"):
            raise TypeError(f"unknown method {self.method}")
        if self.method == "crosslevel" and (len(self.models) != 2 or not self.area):
            raise TypeError("crosslevel takes a fine and a coarse model and an area column")
        if self.delta_outcome or self.window:
            raise NotImplementedError("ensembles know neither delta nor onset outcomes")

    @property
    def steps(self) -> list[int]:
        return sorted(set.intersection(*[set(m.steps) for m in self.models]))

    @property
    def cols_ss(self) -> dict[int, str]:
        return {s: f"ss_{self.name}_{s}" for s in self.steps}

    cols_ss_calibrated = cols_ss

    @property
    def col_sc(self) -> str:
        return f"sc_{self.name}"

    col_sc_calibrated = col_sc

    @property
    def cols_needed(self) -> list[str]:
        calibrated = self.method == "average"
        cols = [
            (m.cols_ss_calibrated if calibrated else m.cols_ss)[s]
            for m in self.models
            for s in self.steps
        ]
        extra = {"ebma": [self.col_outcome], "crosslevel": [self.area]}
        return [*extra.get(self.method, []), *cols]

    def predict(self, df: DataFrame, period_calib: Period, period_test: Period) -> DataFrame:
        require_columns(df, self.cols_needed, self.name)
        t = F.col(self.panel.time)
        test = df.filter(period_test.in_predict(t))
        weights: dict[int, dict[str, float]] = {}
        out = test
        for s in self.steps:
            target = self.cols_ss[s]
            if self.method == "average":
                out = mixing.average(out, [m.cols_ss_calibrated[s] for m in self.models], target)
                weights[s] = mixing.equal_weights([m.name for m in self.models])
            elif self.method == "ebma":
                cols = [m.cols_ss[s] for m in self.models]
                calib = df.filter(period_calib.in_predict(t)).select(self.col_outcome, *cols)
                fit = mixing.fit_ebma(calib, cols, self.col_outcome)
                weights[s] = {m.name: w for m, w in zip(self.models, fit.weights)}
                out = fit.predict(out, target)
            else:
                fine, coarse = self.models[0].cols_ss[s], self.models[1].cols_ss[s]
                low = out.groupBy(self.panel.time, self.area).agg(F.avg(coarse).alias(coarse))
                out = mixing.cross_level(
                    out, low, self.panel.time, self.area, fine, coarse, target
                )
        if weights:
            self.weights[period_calib.name] = weights
        out = out.select(*self.panel.keys, *self.cols_ss.values())
        return combine_steps(out, self.panel, self.cols_ss, period_test, self.col_sc)

    def evaluate(self, df: DataFrame, periods: Sequence[Period] | None = None) -> DataFrame:
        return evaluate_predictions(self, df, periods)
