from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeflow.operators import alerts, checks, drift, outliers, scoring, split
from gaugeflow.operators.forest import Forest
from gaugeflow.operators.learners import cross_validate, random_draws
from gaugeflow.operators.profile import feature_stats
from gaugeflow import fixed_values as fv
from gaugeflow.catalog import models
from gaugeflow.plans.train_run import model_report, train_run
from gaugeflow.sources import reference_stats, registry

SMALL = {"numTrees": 5, "maxDepth": 4, "seed": 1}


@pytest.fixture(scope="module")
def line(spark):
    return spark.range(400).selectExpr("id", "double(id) as f1", "double(id % 7) as f2", "3.0 * id + id % 7 as target")


def test_split_is_disjoint_complete_and_stable(spark, line):
    parts = split.split_train_val_test(line, "target", "id", drop=["f2"])
    sizes = {r[0]: r[1] for r in parts.groupBy("split").count().collect()}
    assert sum(sizes.values()) == 400 and abs(sizes["train"] - 280) < 40 and "f2" not in parts.columns
    again = split.split_train_val_test(line.repartition(9), "target", "id", drop=["f2"])
    assert parts.exceptAll(again).isEmpty()
    with pytest.raises(ValueError, match="not found"):
        split.split_train_val_test(line, "absent", "id")


def test_correlation_of_a_constant_is_null(spark, line):
    found = {r["feature"]: r for r in split.correlation_leakage(line.withColumn("same", F.lit(1)), "target").collect()}
    assert found["same"]["correlation"] is None and found["f1"]["suspicious"] and not found["f2"]["suspicious"]


def test_forest_contract(spark, line):
    forest = Forest(settings=SMALL)
    with pytest.raises(ValueError, match="not been trained"):
        forest.predict(line)
    forest.fit(line, ["f1", "f2"], "target")
    with pytest.raises(ValueError, match="Missing columns"):
        forest.predict(line.drop("f2"))
    with pytest.raises(ValueError, match="fit for training"):
        Forest(settings=SMALL).fit(line.withColumn("f1", F.lit(None).cast("double")), ["f1"], "target")
    scored = forest.predict(line, keep=["id", "target"])
    assert scored.count() == 400
    metrics = scoring.regression_metrics(scored, "prediction", "target").first()
    assert metrics["r2"] > 0.9 and metrics["within_pct"] == 100.0
    spread = forest.predict_interval(line, keep=["id"]).join(scored.withColumnRenamed("prediction", "p"), "id")
    assert spread.where("abs(prediction - p) > 1e-9 or confidence_lower > p + 1e-9 or confidence_upper < p - 1e-9").isEmpty()
    importance = forest.feature_importance(spark).collect()
    assert [r["Feature"] for r in importance] == ["f1", "f2"] and sum(r["Importance"] for r in importance) == pytest.approx(1)


def test_interval_is_population_spread_of_the_trees(spark, line):
    forest = Forest(settings=SMALL).fit(line, ["f1", "f2"], "target")
    row = forest.predict_interval(line.where("id = 77")).first()
    vector = forest.assembled(line.where("id = 77"), with_label=False).first()["features"]
    votes = [t.predict(vector) for t in forest.model.trees]
    assert row["prediction"] == pytest.approx(np.mean(votes)) and row["prediction_std"] == pytest.approx(np.std(votes))


def test_cross_validation_and_draws(spark, line):
    report = cross_validate(Forest(settings=SMALL), line, ["f1", "f2"], "target", "id", folds=2)[0]
    assert report["mse_min"] <= report["mse_mean"] <= report["mse_max"]
    grid = {"numTrees": [1, 2], "maxDepth": [3, 4]}
    drawn = random_draws(grid, 3)
    assert drawn == random_draws(grid, 3) and len({tuple(d.items()) for d in drawn}) == 3
    assert len(random_draws(grid, 15)) == 4


def test_training_query_runs_the_whole_search(spark, monkeypatch):
    asked = {}
    monkeypatch.setattr(models, "kept", lambda label, make, s, f: make(s, f))
    monkeypatch.setattr(models, "stored_features", lambda s, f: s.range(1))
    monkeypatch.setattr(models, "train_run", lambda *a, **k: asked.update(k))
    models.run(spark, "")
    assert asked == {"grid": fv.SEARCH_GRID, "draws": fv.SEARCH_DRAWS, "folds": fv.FOLDS}


def test_report_tells_what_the_search_found(spark, line, tmp_path):
    grid = {"numTrees": [2, 3], "maxDepth": [2]}
    run = train_run(line, "target", "id", str(tmp_path), "forest_search", "1.0", settings=SMALL, grid=grid, draws=2, folds=2)
    report = model_report(run).first()
    assert report["n_settings_tried"] == 2 and f"numTrees={report['n_trees']}," in report["best_settings"]
    assert report["given_settings"] == ", ".join(f"{k}={v}" for k, v in SMALL.items())


def test_train_run_saves_and_reloads(spark, line, tmp_path):
    run = train_run(line, "target", "id", str(tmp_path), "forest_vast", "1.0", settings=SMALL, folds=2)
    assert run.metrics["r2"] > 0.8 and run.learner.features == ["f1", "f2"]
    assert model_report(run).first()["feature_count"] == 2
    listed = registry.list_models(spark, str(tmp_path)).first()
    assert (listed["name"], listed["version"]) == ("forest_vast", "1.0")
    meta = registry.load_model_metadata(spark, str(tmp_path), "forest_vast", "1.0").first()
    assert meta["features"] == ["f1", "f2"] and meta["performance"]["r2"] == pytest.approx(run.metrics["r2"])


def test_prediction_check_raises(spark):
    df = spark.createDataFrame([(1.0, 1.0), (float("nan"), 2.0)], "p double, y double")
    with pytest.raises(ValueError, match="NaN"):
        checks.prediction_check(df, "p", "y", on_fail="raise")


def test_request_rules(spark):
    df = spark.createDataFrame([(2020, 0, 1.0, 36.0, -95.0, 1), (1999, 0, -1.0, 60.0, None, 2)],
                               "YearStart int, YearsSince2020 int, ConfidenceIntervalWidth double, Latitude double, Longitude double, Region_West int")
    good, bad = scoring.request_domain_filter(df, required_flags=["Region_West"])
    assert good.count() == 1
    assert set(bad.first()["violations"]) == {
        "YearStart is out of range", "ConfidenceIntervalWidth is out of range", "Latitude is out of range",
        "Longitude is required", "Region_West must be 0 or 1"}


# --- drift ------------------------------------------------------------------------------------------
def normal_frame(spark, n, shift=0.0, seed=42):
    rng = np.random.default_rng(seed)
    rows = zip(*[c.tolist() for c in (rng.normal(shift, 1, n), rng.normal(10.2, 2, n), rng.uniform(0, 100, n))], range(n))
    return spark.createDataFrame([(*r,) for r in rows], "feature1 double, feature2 double, feature3 double, i int").drop("i")


def test_drift_found_only_where_the_mean_moved(spark, tmp_path):
    path = str(tmp_path / "stats")
    reference_stats.save_reference_stats(normal_frame(spark, 1000), path)
    stats = reference_stats.load_reference_stats(spark, path)
    assert abs(stats.where("feature = 'feature1'").first()["mean"]) < 0.1
    calm = drift.drift_report(normal_frame(spark, 100, 0.1, 1), stats)
    assert drift.drift_summary(calm).first().asDict() == {
        "total_features": 3, "features_with_drift": 0, "features_missing": 0, "features_stable": 3, "drift_detected": False}
    moved = drift.drift_report(normal_frame(spark, 100, 5.0, 2).withColumn("extra", F.lit(1)), stats)
    found = {r["feature"]: r["status"] for r in moved.collect()}
    assert found == {"feature1": "drift_detected", "feature2": "stable", "feature3": "stable", "extra": "unknown"}
    raised = alerts.drift_alerts(moved).collect()
    assert [a["title"] for a in raised] == ["Data Drift Detected: feature1"]


def test_shift_below_two_deviations_is_stable(spark):
    stats = feature_stats(normal_frame(spark, 1000), ["feature1"])
    assert drift.drift_report(normal_frame(spark, 500, 1.3, 3), stats, ["feature1"]).first()["status"] == "stable"


def test_default_statistics_when_none_are_saved(spark, tmp_path):
    stats = reference_stats.load_reference_stats(spark, str(tmp_path / "absent"))
    assert {r["feature"]: r["mean"] for r in stats.collect()} == {"YearStart": 2020.0, "Latitude": 36.5, "Longitude": -95.0}
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "a.json").write_text("{not json")
    assert reference_stats.load_reference_stats(spark, str(tmp_path / "broken")).count() == 3
    assert drift.drift_detector_state(stats, "p").first()["reference_source"] == "default"


def test_outlier_report_names_the_columns(spark):
    rng = random.Random(1)
    rows = [(rng.gauss(0, 1), 1.0) for _ in range(200)] + [(50.0, 9.0)]
    report = outliers.outlier_report(spark.createDataFrame(rows, "a double, flat double")).collect()
    assert [(r["feature"], r["outlier_count"]) for r in report] == [("a", 1)]


def test_severity_gate(spark):
    df = spark.createDataFrame([("info",), ("warning",), ("error",), ("critical",), ("odd",)], "severity string")
    assert [r[0] for r in alerts.severity_filter(df, "error").collect()] == ["error", "critical"]
    assert alerts.severity_filter(df, "odd").count() == 5
