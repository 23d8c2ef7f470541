"""From engineered features to a saved, reloaded and evaluated regressor of any kind."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow import fixed_values as fv
from gaugeflow.functions.scalars import numeric_columns
from gaugeflow.operators.forest import Forest
from gaugeflow.operators.learners import Regressor, cross_validate, random_search
from gaugeflow.operators.scoring import regression_metrics
from gaugeflow.operators.lookups import split_overlap
from gaugeflow.operators.split import leakage_report, split_balance, split_train_val_test
from gaugeflow.sources.registry import load_regressor, save_regressor
from gaugeflow.storage import materialise


@dataclass
class TrainRun:
    learner: Regressor
    parts: DataFrame
    metrics: dict
    cv: dict | None = None
    search: list[dict] = field(default_factory=list)
    paths: dict[str, str] = field(default_factory=dict)
    leakage: list[dict] = field(default_factory=list)
    balance: dict = field(default_factory=dict)
    dropped: list[str] = field(default_factory=list)
    settings: dict = field(default_factory=dict)
    given: dict = field(default_factory=dict)  # settings before the search


def train_val(parts: DataFrame) -> DataFrame:
    """Train and validation rows together, as tuning, cross-validation and the last fit use them."""
    return parts.where(F.col("split").isin("train", "val"))


def train_run(
    df: DataFrame, target: str, row_id: str, folder: str, name: str, version: str,
    drop: Sequence[str] = tuple(fv.LEAKAGE_COLUMNS), settings: Mapping[str, object] | None = None,
    grid: Mapping[str, Sequence] | None = None, draws: int = fv.SEARCH_DRAWS, folds: int = fv.FOLDS,
    validate: bool = True, seed: int = 42, learner: type[Regressor] = Forest,
) -> TrainRun:
    """Split, search, validate, fit, evaluate, save and reload a regressor of the class ``learner``."""
    leakage = [r.asDict() for r in leakage_report(df.drop(*drop, row_id), target).collect()]  # a few rows per column
    parts = materialise(split_train_val_test(df, target, row_id, drop, seed=seed), "split")
    balance = split_balance(parts, target).first().asDict()
    both = split_overlap(train_val(parts), parts.where(F.col("split") == "test"), row_id)
    balance["n_overlap"] = both.count()
    features = [c for c in numeric_columns(parts) if c not in (target, row_id)]
    given = dict(settings or learner.default_settings)
    model = learner(given)
    fit_rows = train_val(parts)
    search = random_search(model, fit_rows, features, target, row_id, grid, draws, folds, seed) if grid else []
    # The search has validated its best settings on these folds already.
    cv = None if not validate else search[0] if search else cross_validate(
        model, fit_rows, features, target, row_id, folds, seed=seed
    )[0]
    model.fit(fit_rows, features, target)
    scored = model.predict(parts.where(F.col("split") == "test"), keep=[target])
    metrics = regression_metrics(scored, "prediction", target, cv["rmse"] if cv else None).first().asDict()
    numbers = {k: float(v) for k, v in metrics.items() if isinstance(v, float)}
    paths = save_regressor(model, df.sparkSession, folder, name, version, numbers)
    reloaded = load_regressor(df.sparkSession, folder, name, version)
    if reloaded.features != model.features:
        raise RuntimeError("the reloaded model has other features than the saved one")
    dropped = [c for c in df.columns if c not in parts.columns]
    return TrainRun(
        reloaded, parts, metrics, cv, search, paths, leakage, balance, dropped, dict(model.settings), given
    )


def model_report(run: TrainRun, top: int = 10) -> DataFrame:
    """One row about a training run: settings, errors, parts, dropped columns, leakage texts, the heaviest features."""
    spark = run.parts.sparkSession
    sizes = run.parts.groupBy().agg(*[
        F.count_if(F.col("split") == s).alias(f"n_{s}") for s in ("train", "val", "test")
    ])
    heaviest = [f"{r['Feature']}={r['Importance']:.4f}" for r in run.learner.feature_importance(spark, top).collect()]
    warnings = [" ".join(str(x) for x in (w["warning"], w["column"], w["value"]) if x is not None) for w in run.leakage]
    cv = run.cv or {}
    best = run.search[0] if run.search else {}
    return sizes.select(
        F.lit(run.learner.type_name()).alias("model_type"),
        F.lit(getattr(run.learner.trained(), "getNumTrees", None)).cast("int").alias("n_trees"),
        F.lit(len(run.learner.features)).alias("feature_count"),
        "n_train", "n_val", "n_test",
        *[F.lit(run.metrics.get(k)).cast("double").alias(k) for k in ("mae", "mse", "rmse", "r2", "mape_pct", "within_pct")],
        *[F.lit(cv.get(k)).cast("double").alias(f"cv_{k}") for k in ("mse_mean", "mse_std", "mse_min", "mse_max")],
        F.lit(", ".join(f"{k}={v}" for k, v in run.settings.items())).alias("settings"),
        F.lit(", ".join(f"{k}={v}" for k, v in run.given.items())).alias("given_settings"),
        F.lit(", ".join(run.dropped)).alias("dropped_columns"),
        F.lit(run.balance.get("diff_pct")).cast("double").alias("train_test_gap_pct"),
        F.lit(run.balance.get("n_overlap")).cast("long").alias("n_overlap"),
        F.lit(", ".join(f"{k}={v}" for k, v in best.items())).alias("best_settings"),
        F.lit(len(run.search)).alias("n_settings_tried"),
        F.lit(len(run.leakage)).alias("n_leakage_warnings"), F.lit("; ".join(warnings)).alias("leakage_warnings"),
        F.lit("; ".join(heaviest)).alias("top_features"),
    )
