"""The model contract, nested evaluation of forests, leaf tables and the registry."""

from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from gaugeflow.operators import forest as forests
from gaugeflow.operators.forest import Forest, leaf_table
from gaugeflow.operators.learners import Boosted, Linear, Regressor, cross_validate, random_search
from gaugeflow.operators.split import contiguous_folds
from gaugeflow.plans.train_run import model_report, train_run
from gaugeflow.sources import registry
from gaugeflow.storage import located

SMALL = {"numTrees": 6, "maxDepth": 6, "seed": 3, "featureSubsetStrategy": "all"}


@pytest.fixture(scope="module")
def line(spark):
    return spark.range(600).selectExpr("id", "double(id) as f1", "double(id % 7) as f2", "3.0 * id + 20 * (id % 7) as target")


class MeanOfGroup(Regressor):
    """A regressor that is no Spark ML model: the mean of the target by the whole part of the first feature."""

    default_settings = {"width": 50.0}

    def fit_rows(self, rows, weight=None):
        from pyspark.ml.functions import vector_to_array

        group = F.floor(vector_to_array("features")[0] / self.settings["width"])
        means = rows.groupBy(group.alias("g")).agg(F.avg("label").alias("m")).collect()
        return {"width": self.settings["width"], "means": {int(r["g"]): r["m"] for r in means}}

    def predict_rows(self, rows):
        from pyspark.ml.functions import vector_to_array

        model = self.trained()
        known = F.create_map(*[F.lit(x) for pair in model["means"].items() for x in pair])
        return rows.withColumn("prediction", F.coalesce(
            known[F.floor(vector_to_array("features")[0] / model["width"]).cast("int")], F.lit(0.0)
        ))

    def write_model(self, spark, path):
        spark.createDataFrame([(json.dumps(self.trained()),)], "value string").write.text(path)

    @classmethod
    def read_model(cls, spark, path):
        model = json.loads(spark.read.text(path).first()[0])
        return {"width": model["width"], "means": {int(k): v for k, v in model["means"].items()}}


@pytest.mark.parametrize(("learner", "grid"), [
    (Linear, {"regParam": [0.01, 10.0]}), (Boosted, {"maxDepth": [2, 3], "maxIter": [3]}), (MeanOfGroup, {"width": [30.0, 500.0]}),
])
def test_other_kinds_of_models_go_through_the_whole_run(spark, line, tmp_path, learner, grid):
    run = train_run(line, "target", "id", str(tmp_path), "model_of", "2_x", learner=learner, grid=grid, draws=2, folds=2)
    assert run.metrics["r2"] > 0.8 and type(run.learner) is learner and len(run.search) == 2
    assert run.search[0]["mse_mean"] <= run.search[1]["mse_mean"]
    report = model_report(run).first()
    assert report["model_type"] == learner.type_name() and report["n_settings_tried"] == 2 and report["rmse"] > 0
    meta = registry.load_model_metadata(spark, str(tmp_path), "model_of", "2_x").first()
    assert meta["model_type"] == learner.type_name()
    name, best = next(iter(run.search[0].items()))
    assert meta["parameters"][name] == str(best)
    assert [r["version"] for r in registry.list_models(spark, str(tmp_path)).collect()] == ["2_x"]


def test_unknown_model_types_are_refused(spark, tmp_path):
    place = registry.new_publication(str(tmp_path), "odd", "1")
    registry.save_model_metadata(spark, place, "odd", "1", "NoSuchModel", [])
    registry.publish(spark, place)
    with pytest.raises(ValueError, match="NoSuchModel"):
        registry.load_regressor(spark, str(tmp_path), "odd", "1")


# --- leaf tables and nested evaluation --------------------------------------------------------------
def test_leaf_values_are_the_votes_of_the_trees(spark, line):
    forest = Forest(settings=SMALL).fit(line, ["f1", "f2"], "target")
    rows = forest.assembled(line, keep=["id"], with_label=False)
    leaves, scored = forest.leaves_of(rows)
    found = scored.select("features", leaves.alias("leaves")).limit(40).collect()
    table = leaf_table(spark, forest.model)
    votes = table.votes(np.array([r["leaves"] for r in found]))
    assert votes.tolist() == [[t.predict(r["features"]) for t in forest.model.trees] for r in found]


def test_cut_and_shortened_forests_err_like_smaller_ones(spark, line):
    """A tree cut at a depth is the tree grown to it: with all features and no resampling both are determined."""
    settings = {**SMALL, "bootstrap": False, "subsamplingRate": 1.0}
    forest = Forest(settings=settings)
    forest.features, forest.target = ["f1", "f2"], "target"
    rows = forest.assembled(contiguous_folds(line, "id", 2), keep=["fold"]).cache()
    asked = [{"numTrees": t, "maxDepth": d} for t in (2, 6) for d in (1, 3, 6)]
    nested = forest.errors(rows, asked, 0)
    assert nested == pytest.approx(Regressor.errors(forest, rows, asked, 0), rel=1e-9)
    assert len(set(nested)) > 2


def test_prefixes_are_the_first_trees_of_the_list(spark, line):
    forest = Forest(settings=SMALL)
    forest.features, forest.target = ["f1", "f2"], "target"
    rows = forest.assembled(contiguous_folds(line, "id", 2), keep=["fold"]).cache()
    nested = forest.errors(rows, [{"numTrees": t} for t in (1, 4, 6)], 1)
    model = RandomForestRegressor(**{**SMALL}).fit(rows.where("fold <> 1"))
    held = rows.where("fold = 1").collect()
    for t, error in zip((1, 4, 6), nested):
        votes = np.array([[tree.predict(r["features"]) for tree in model.trees[:t]] for r in held]).mean(1)
        assert error == pytest.approx(np.mean((votes - np.array([r["label"] for r in held])) ** 2))


def test_a_family_is_fitted_once_a_fold(spark, line, monkeypatch):
    fits = []
    whole = Forest.fit_rows
    monkeypatch.setattr(Forest, "fit_rows", lambda self, rows, weight=None: fits.append(dict(self.settings)) or whole(self, rows))
    grid = {"numTrees": [1, 3], "maxDepth": [2, 4], "minInstancesPerNode": [1, 5]}
    forest = Forest(settings=SMALL)
    tried = random_search(forest, line, ["f1", "f2"], "target", "id", grid, draws=8, folds=2)
    assert len(tried) == 8 and len(fits) == 4 and all(f["numTrees"] == 3 and f["maxDepth"] == 4 for f in fits)
    assert all(forest.settings[k] == tried[0][k] for k in grid)


def test_intervals_of_large_forests_are_the_same(spark, line, monkeypatch):
    forest = Forest(settings=SMALL).fit(line, ["f1", "f2"], "target")
    usual = forest.predict_interval(line, keep=["id"]).orderBy("id").collect()
    plan = forest.predict_interval(line, keep=["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("UDF") <= 6  # assembling, one transform, and the lookup; not one per tree
    monkeypatch.setattr(forests, "MOST_LEAVES", 1)
    large = forest.predict_interval(line, keep=["id"]).orderBy("id").collect()
    for a, b in zip(usual, large):
        assert a["id"] == b["id"] and list(a)[1:] == pytest.approx(list(b)[1:], rel=1e-9, abs=1e-7)
    asked = [{"numTrees": 2}]
    rows = forest.assembled(contiguous_folds(line, "id", 2), keep=["fold"])
    assert forest.errors(rows, asked, 0) == pytest.approx(Regressor.errors(forest, rows, asked, 0))


def test_a_fit_deals_rows_by_the_size_of_their_cached_form(spark, line, monkeypatch):
    forest = Forest(settings=SMALL)
    forest.features, forest.target = ["f1", "f2"], "target"
    rows = forest.assembled(line.coalesce(1))
    assert forest.dealt(rows).rdd.getNumPartitions() == 1
    monkeypatch.setattr(forests, "FIT_TASK_BYTES", 10_000)
    dealt = forest.dealt(rows)
    assert dealt.rdd.getNumPartitions() == 10  # 600 rows of 6 * 8 + 2 * 4 + 100 bytes
    assert dealt.count() == 600 and dealt.select("label").exceptAll(rows.select("label")).isEmpty()
    assert forest.fit(line.coalesce(1), ["f1", "f2"], "target").model.getNumTrees == 6


def test_a_forest_grows_in_batches_and_is_one_model(spark, line, monkeypatch, tmp_path):
    whole, asked, places = Regressor.fit_rows, [], []

    def watched(self, rows, weight=None):
        asked.append((self.settings["numTrees"], self.settings["seed"]))
        places.append(rows.storageLevel.useMemory)
        return whole(self, rows, weight)

    monkeypatch.setattr(Regressor, "fit_rows", watched)
    monkeypatch.setattr(forests, "TREES_AT_ONCE", 3)
    kept = spark.sparkContext._jsc.getPersistentRDDs().size()
    forest = Forest(settings={**SMALL, "numTrees": 8}).fit(line, ["f1", "f2"], "target")
    assert sorted(n for n, _ in asked) == [2, 3, 3] and len({s for _, s in asked}) == 3 and (3, 3) in asked and all(places)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == kept
    model = forest.model
    assert model.getNumTrees == len(model.trees) == 8 and model.getOrDefault("maxDepth") == 6
    first = RandomForestRegressor(**{**SMALL, "numTrees": 3}).fit(forest.assembled(line))
    texts = [t.toDebugString.split("\n", 1)[1] for t in model.trees]
    assert texts[:3] == [t.toDebugString.split("\n", 1)[1] for t in first.trees] and len(set(texts)) == 8
    assert sum(forest.importances()) == pytest.approx(1)
    registry.save_regressor(forest, spark, str(tmp_path), "batches", "1")
    again = registry.load_regressor(spark, str(tmp_path), "batches", "1")
    assert again.model.getNumTrees == 8
    votes = again.predict_interval(line.where("id < 50"), keep=["id"]).orderBy("id").collect()
    rows = forest.assembled(line.where("id < 50"), keep=["id"]).orderBy("id").collect()
    assert [r["prediction"] for r in votes] == pytest.approx([np.mean([t.predict(r["features"]) for t in model.trees]) for r in rows])
    scored = [r["prediction"] for r in forest.predict(line.where("id < 50"), keep=["id"]).orderBy("id").collect()]
    assert scored == pytest.approx([r["prediction"] for r in votes])


def test_batches_are_even_so_that_none_is_a_single_tree():
    for trees, sizes in ((100, [20] * 5), (21, [11, 10]), (150, [19] * 6 + [18] * 2), (1, [1]), (20, [20])):
        assert [b["numTrees"] for b in Forest({"numTrees": trees}).batches()] == sizes
    assert [b["seed"] for b in Forest({"numTrees": 40, "seed": 7}).batches()] == [7, 7 + forests.SEED_STEP]


def test_no_rows_have_no_interval(spark, line):
    forest = Forest(settings=SMALL).fit(line, ["f1", "f2"], "target")
    assert forest.predict_interval(line.limit(0), keep=["id"]).count() == 0


# --- registry -----------------------------------------------------------------------------------------
def test_a_broken_save_leaves_the_old_version(spark, line, tmp_path, monkeypatch):
    base = str(tmp_path)
    old = Linear().fit(line, ["f1"], "target")
    registry.save_regressor(old, spark, base, "price", "1.0")
    first = registry.published(spark, base, "price", "1.0")

    def fails(*_, **__):
        raise OSError("disk full")

    new = Boosted({"maxIter": 2}).fit(line, ["f1", "f2"], "target")
    with monkeypatch.context() as patch:
        patch.setattr(registry, "save_model_metadata", fails)
        with pytest.raises(OSError):
            registry.save_regressor(new, spark, base, "price", "1.0")
    again = registry.load_regressor(spark, base, "price", "1.0")
    assert type(again) is Linear and again.features == ["f1"] and registry.published(spark, base, "price", "1.0") == first
    size = registry.list_models(spark, base).first()["size_mb"]
    registry.save_regressor(new, spark, base, "price", "1.0")
    again = registry.load_regressor(spark, base, "price", "1.0")
    assert type(again) is Boosted and again.features == ["f1", "f2"]
    listed = registry.list_models(spark, base).collect()
    assert [(r["name"], r["version"]) for r in listed] == [("price", "1.0")] and listed[0]["size_mb"] != size
    assert registry.remove_unpublished(spark, base, "price", "1.0") == 2
    assert type(registry.load_regressor(spark, base, "price", "1.0")) is Boosted
    system, folder = located(spark, f"{base}/price_v1.0/saves")
    assert len(system.listStatus(folder)) == 1
    with pytest.raises(FileNotFoundError):
        registry.published(spark, base, "price", "9")


def test_cross_validation_of_one_setting(spark, line):
    found = cross_validate(Linear(), line, ["f1", "f2"], "target", "id", folds=3)
    assert len(found) == 1 and found[0]["mse_min"] <= found[0]["mse_mean"] <= found[0]["mse_max"]
