"""The model contract: what a regressor has to offer to be fitted, searched, validated, saved, reloaded and reported."""

from __future__ import annotations

import itertools
import math
import random
from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool
from typing import Any, ClassVar

from pyspark import inheritable_thread_target
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow import fixed_values as fv
from gaugeflow.functions.scalars import quoted
from gaugeflow.operators.checks import input_checks
from gaugeflow.operators.lookups import missing_columns
from gaugeflow.operators.ranking import last_n
from gaugeflow.operators.split import contiguous_folds
from gaugeflow.storage import free, materialise

#: Fits that run side by side. The driver grows the nodes of a forest, so one fit alone leaves most cores idle.
PARALLEL_FITS = 4
#: Regressor classes by the name that saved metadata holds.
KINDS: dict[str, type[Regressor]] = {}


class Regressor:
    """A regressor with its settings, its feature names and, once fitted, its model.

    For a model of Spark ML a subclass names ``estimator_class`` and ``model_class``. For any other model it overrides
    ``fit_rows``, ``predict_rows``, ``write_model`` and ``read_model``; these get rows with the columns ``features`` (a
    vector), ``label`` and those to keep. Everything else works on this contract alone. A subclass is known to the model
    registry by ``type_name``, the name of its model class.
    """

    estimator_class: ClassVar[type | None] = None
    model_class: ClassVar[type | None] = None
    default_settings: ClassVar[Mapping[str, object]] = {}

    def __init_subclass__(cls, **options):
        super().__init_subclass__(**options)
        KINDS[cls.type_name()] = cls

    def __init__(self, settings: Mapping[str, object] | None = None, features: Sequence[str] = (), target: str = "label",
                 model: Any = None):
        self.settings = dict(self.default_settings if settings is None else settings)
        self.features, self.target, self.model = list(features), target, model

    @classmethod
    def type_name(cls) -> str:
        return cls.model_class.__name__ if cls.model_class else cls.__name__

    # --- what a subclass may replace ------------------------------------------------------------------
    def estimator(self):
        columns = {"featuresCol": "features", "labelCol": "label", "predictionCol": "prediction"}
        seed = {"seed": 42} if self.estimator_class().hasParam("seed") else {}
        return self.estimator_class(**columns, **{**seed, **self.settings})

    def fit_rows(self, rows: DataFrame, weight: str | None = None):
        """The model for ``rows(features, label)``."""
        estimator = self.estimator()
        return (estimator.setWeightCol(weight) if weight else estimator).fit(rows)

    def predict_rows(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``prediction``."""
        return self.trained().transform(rows)

    def write_model(self, spark: SparkSession, path: str) -> None:
        self.trained().write().overwrite().save(path)

    @classmethod
    def read_model(cls, spark: SparkSession, path: str):
        return cls.model_class.load(path)

    def importances(self) -> list[float] | None:
        """A weight of each feature, or None where the model tells none."""
        model = self.trained()
        if hasattr(model, "featureImportances"):
            return model.featureImportances.toArray().tolist()
        if hasattr(model, "coefficients"):
            weights = [abs(x) for x in model.coefficients.toArray().tolist()]
            return [w / (sum(weights) or 1.0) for w in weights]
        return None

    # --- common to all ----------------------------------------------------------------------------------
    def copy(self, **changes) -> Regressor:
        """An unfitted copy with some settings changed."""
        return type(self)({**self.settings, **changes}, self.features, self.target)

    def trained(self):
        if self.model is None:
            raise ValueError("Model has not been trained yet")
        return self.model

    def assembled(self, df: DataFrame, keep: Sequence[str] = (), with_label: bool = True) -> DataFrame:
        """Feature vector, label and the columns to keep. Inputs get plain names, so any column name works."""
        names = [f"__f{i}" for i in range(len(self.features))]
        label = [quoted(self.target).cast("double").alias("label")] if with_label else []
        inputs = df.select(*[quoted(c).alias(n) for c, n in zip(self.features, names)], *label,
                           *[quoted(k) for k in keep])
        vector = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="error")
        return vector.transform(inputs).drop(*names)

    def fit(self, df: DataFrame, features: Sequence[str], target: str, weight: str | None = None,
            check: bool = True) -> Regressor:
        self.features, self.target = list(features), target
        if check:
            input_checks(df.select(*[quoted(c) for c in [*features, target]]), target)
        self.model = self.fit_rows(self.assembled(df, keep=[weight] if weight else []), weight)
        return self

    def checked(self, df: DataFrame) -> None:
        self.trained()
        absent = missing_columns(df, self.features)
        if absent:
            raise ValueError(f"Missing columns: {absent}")

    def predict(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        self.checked(df)
        return self.predict_rows(self.assembled(df, keep, with_label=False)).drop("features")

    def feature_importance(self, spark: SparkSession, top: int | None = None) -> DataFrame:
        """Importance per feature, largest first; general names if their number does not fit."""
        weights = self.importances() or []
        names = self.features if len(self.features) == len(weights) else [f"feature_{i}" for i in range(len(weights))]
        table = spark.createDataFrame(list(zip(names, weights)), "Feature string, Importance double")
        order = [F.desc("Importance"), F.asc("Feature")]
        return last_n(table, order, top) if top else table.orderBy(*order)

    def errors(self, rows: DataFrame, settings: Sequence[Mapping[str, object]], fold: int) -> list[float]:
        """Mean squared error on ``fold`` of a fit on the other folds, for each of the settings."""
        found = []
        for changes in settings:
            one = self.copy(**changes)
            one.model = one.fit_rows(rows.where(F.col("fold") != fold))
            gap = F.col("prediction") - F.col("label")
            found.append(one.predict_rows(rows.where(F.col("fold") == fold)).agg(F.avg(gap * gap)).first()[0])
        return found

    def families(self, settings: Sequence[Mapping[str, object]]) -> list[list[int]]:
        """Places of the settings that one call of ``errors`` should get together."""
        return [[i] for i in range(len(settings))]


class Linear(Regressor):
    estimator_class, model_class = LinearRegression, LinearRegressionModel
    default_settings = {"regParam": 0.1, "elasticNetParam": 0.0}


class Boosted(Regressor):
    estimator_class, model_class = GBTRegressor, GBTRegressionModel
    default_settings = {"maxIter": 20, "maxDepth": 5}


def random_draws(grid: Mapping[str, Sequence], draws: int = fv.SEARCH_DRAWS, seed: int = 42) -> list[dict]:
    """Distinct settings drawn from the grid."""
    combos = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    return random.Random(seed).sample(combos, min(draws, len(combos)))


def cross_validate(
    learner: Regressor, df: DataFrame, features: Sequence[str], target: str, row_id: str,
    folds: int = fv.FOLDS, settings: Sequence[Mapping[str, object]] = ({},), parallelism: int = PARALLEL_FITS, seed: int = 42,
) -> list[dict]:
    """Squared error over hash-range folds for each of the given settings. Fits run as parallel Spark jobs.

    The assembled rows are a written table, so fits read them anew after an executor is lost.
    """
    learner.features, learner.target = list(features), target
    rows = materialise(learner.assembled(contiguous_folds(df, row_id, folds, seed), keep=["fold"]), "folds")
    families = learner.families(settings)

    def fold_errors(job: tuple[list[int], int]) -> list[float]:
        family, fold = job
        return learner.errors(rows, [settings[i] for i in family], fold)

    jobs = [(family, fold) for family in families for fold in range(folds)]
    with ThreadPool(parallelism) as pool:
        found = pool.map(inheritable_thread_target(df.sparkSession)(fold_errors), jobs, chunksize=1)
    free(rows)
    errors: dict[int, list[float]] = {i: [] for i in range(len(settings))}
    for (family, _), values in zip(jobs, found):
        for i, value in zip(family, values):
            errors[i].append(value)
    report = []
    for i, s in enumerate(settings):
        mean = sum(errors[i]) / folds
        report.append({
            **s, "mse_mean": mean, "mse_std": math.sqrt(sum((e - mean) ** 2 for e in errors[i]) / folds),
            "mse_min": min(errors[i]), "mse_max": max(errors[i]), "rmse": math.sqrt(mean),
        })
    return report


def random_search(
    learner: Regressor, df: DataFrame, features: Sequence[str], target: str, row_id: str,
    grid: Mapping[str, Sequence] = fv.SEARCH_GRID, draws: int = fv.SEARCH_DRAWS, folds: int = fv.FOLDS,
    seed: int = 42, parallelism: int = PARALLEL_FITS,
) -> list[dict]:
    """Try random settings by cross-validation, best first, and set the best on the learner."""
    tried = cross_validate(learner, df, features, target, row_id, folds, random_draws(grid, draws, seed), parallelism, seed)
    ranked = sorted(tried, key=lambda r: r["mse_mean"])
    learner.settings = {**learner.settings, **{k: ranked[0][k] for k in grid}}
    return ranked
