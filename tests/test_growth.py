"""Trees grown over packed rows, and rows that walk through a table of nodes, against Spark ML."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from gaugeflow.operators import forest as forests
from gaugeflow.operators import growth
from gaugeflow.operators.forest import Forest, node_table
from gaugeflow.operators.learners import Regressor
from gaugeflow.operators.split import contiguous_folds

FEATURES = ["wide", "seven", "flag", "noise"]
WHOLE = {"numTrees": 2, "maxDepth": 5, "seed": 3, "minInstancesPerNode": 4, "featureSubsetStrategy": "all", "bootstrap": False}


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(2000).selectExpr(
        "id", "double(id * 7919 % 2000) as wide", "double(id % 7) as seven", "double(id % 3 = 0) as flag", "double(id * 31 % 997) as noise",
    ).withColumn("target", F.expr("wide / 10 + 30 * seven + 200 * flag + wide * flag / 7")).cache()


@pytest.fixture
def packed(monkeypatch):
    monkeypatch.setattr(forests, "PACKED_ROWS", 1)


def _assembled(table):
    forest = Forest(WHOLE)
    forest.features, forest.target = FEATURES, "target"
    return forest.assembled(table)


def test_trees_without_chance_are_those_of_spark(spark, table, packed):
    """With all rows and all features a tree is determined; thresholds come from all rows in both."""
    found = Forest(WHOLE).fit(table, FEATURES, "target").model
    wanted = RandomForestRegressor(**WHOLE).fit(_assembled(table))
    assert found.getNumTrees == 2 and found.getOrDefault("maxDepth") == 5 and found.numFeatures == 4
    assert found.trees[0].toDebugString.split("\n", 1)[1] == found.trees[1].toDebugString.split("\n", 1)[1]
    assert found.totalNumNodes == wanted.totalNumNodes > 40
    rows = found.transform(_assembled(table).drop("prediction")).select("label", "features", F.col("prediction").alias("p"))
    both = wanted.transform(rows)
    assert both.where("abs(p - prediction) > 1e-9 * (1 + abs(p))").isEmpty()
    assert found.featureImportances.toArray() == pytest.approx(wanted.featureImportances.toArray(), abs=1e-9)


def test_large_tables_are_packed_and_small_ones_are_not(table, monkeypatch):
    fits = []
    monkeypatch.setattr(Regressor, "fit_rows", lambda self, rows, weight=None: fits.append(len(fits)))
    Forest(WHOLE).fit(table, FEATURES, "target")
    assert fits == [0]
    monkeypatch.setattr(forests, "PACKED_ROWS", 2000)
    assert Forest({**WHOLE, "bootstrap": True}).fit(table, FEATURES, "target").model.getNumTrees == 2
    Forest({**WHOLE, "subsamplingRate": 0.5}).fit(table, FEATURES, "target")  # a setting that only Spark knows
    assert fits == [0, 1]


def test_random_trees_are_as_good_as_those_of_spark(spark, table, packed):
    settings = {**WHOLE, "numTrees": 15, "maxDepth": 8, "featureSubsetStrategy": "sqrt", "bootstrap": True}
    train, test = table.where("id % 4 <> 0"), table.where("id % 4 = 0")
    forest = Forest(settings).fit(train, FEATURES, "target")
    wanted = RandomForestRegressor(**settings).fit(_assembled(train))
    errors = [m.transform(_assembled(test)).agg(F.avg(F.pow(F.col("prediction") - F.col("label"), 2))).first()[0]
              for m in (forest.model, wanted)]
    variance = test.agg(F.var_pop("target")).first()[0]
    assert errors[0] < 0.1 * variance and errors[0] < 1.5 * errors[1]
    assert abs(forest.model.totalNumNodes / wanted.totalNumNodes - 1) < 0.1
    again = Forest(settings).fit(train, FEATURES, "target").model
    texts = [t.toDebugString.split("\n", 1)[1] for t in forest.model.trees]
    assert len(set(texts)) == 15 and texts == [t.toDebugString.split("\n", 1)[1] for t in again.trees]


def test_nested_errors_are_those_of_refits(table, packed, monkeypatch):
    monkeypatch.setattr(forests, "WALKED_NODES", 1)
    forest = Forest({**WHOLE, "featureSubsetStrategy": "sqrt", "bootstrap": True})
    forest.features, forest.target = FEATURES, "target"
    rows = forest.assembled(contiguous_folds(table, "id", 2), keep=["fold"]).cache()
    asked = [{"numTrees": t, "maxDepth": d} for t in (1, 3) for d in (2, 6)]
    assert forest.errors(rows, asked, 1) == pytest.approx(Regressor.errors(forest, rows, asked, 1), rel=1e-9)


def test_rows_walk_through_a_table_of_nodes(spark, table, monkeypatch):
    """The same votes as the trees have, for a forest of Spark ML, too."""
    forest = Forest({**WHOLE, "numTrees": 5, "bootstrap": True}).fit(table, FEATURES, "target")
    found = _assembled(table).select(vector_to_array("features").alias("x"), "features").limit(50).collect()
    votes = node_table(spark, forest.model).votes(np.array([r["x"] for r in found]))[0]
    assert votes.tolist() == [[t.predict(r["features"]) for t in forest.model.trees] for r in found]
    usual = [forest.predict(table, ["id"]).orderBy("id").collect(), forest.predict_interval(table, ["id"]).orderBy("id").collect()]
    monkeypatch.setattr(forests, "WALKED_NODES", 1)
    walked = [forest.predict(table, ["id"]).orderBy("id").collect(), forest.predict_interval(table, ["id"]).orderBy("id").collect()]
    for a, b in zip(usual, walked):
        assert np.array(a) == pytest.approx(np.array(b), rel=1e-9, abs=1e-9)
    assert "transform" not in forest.predict(table)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("label", ["double('NaN')", "double('Infinity')", "cast(null as double)"])
def test_labels_must_be_numbers(table, packed, label):
    rows = _assembled(table).withColumn("label", F.when(F.rand(1) < 0.5, F.expr(label)).otherwise(F.col("label")))
    forest = Forest(WHOLE)
    forest.features = FEATURES
    with pytest.raises(Exception, match="must not be null, NaN or infinite"):
        forest.fit_rows(rows)


def _packed(n, features=70):
    """More features than one word holds."""
    rng = np.random.default_rng(1)
    x = np.where(np.arange(features) % 2, rng.integers(0, 2, (n, features)), rng.normal(size=(n, features)))
    layout = growth.Layout.of([growth.thresholds(x[:, i]) for i in range(features)])
    return layout, layout.packed(x), x[:, 0] * 5 + x[:, 1] * 3 + 2 * x[:, 66] * x[:, 69]


def test_ways_of_counting_and_of_keeping_rows_grow_the_same_tree(monkeypatch, tmp_path):
    layout, words, y = _packed(9000)
    assert layout.words > 2 and all((w >= 0).all() for w in words)
    rule = growth.Rule(layout, 9, 3, 40, True, 7)
    usual = growth.grow(growth.Room(None), words, y, rule, 4)
    assert len(usual["n"]) > 100
    for change in ({"LARGE_NODE": 1, "CHUNK_ROWS": growth.CHUNK_ROWS}, {"LARGE_NODE": 10**6}, {"JOINT_CELLS": 1}, {"GROUP_NODES": 3, "GROUP_ROWS": 500}):
        with monkeypatch.context() as patch:
            for name, value in change.items():
                patch.setattr(growth, name, value)
            other = growth.grow(growth.Room(None), words, y, rule, 4)
        assert other["n"].tolist() == usual["n"].tolist() and other["s"] == pytest.approx(usual["s"], abs=1e-6)
    mapped = growth.grow(growth.Room(str(tmp_path)), words, y, rule, 4)
    assert all(np.array_equal(usual[k], mapped[k], equal_nan=True) for k in usual) and not list(tmp_path.iterdir())
    inner = np.flatnonzero(usual["leftChild"] >= 0)
    for k in ("n", "s", "q"):
        below = usual[k][usual["leftChild"][inner]] + usual[k][usual["rightChild"][inner]]
        assert below == pytest.approx(usual[k][inner], rel=1e-9, abs=1e-6)


def test_a_large_node_is_treated_in_chunks(monkeypatch):
    layout, words, y = _packed(5000, 6 + 64)
    rule = growth.Rule(layout, 6, 3, 70, False, 7)
    usual = growth.grow(growth.Room(None), words, y, rule, 0)
    monkeypatch.setattr(growth, "CHUNK_ROWS", 400)
    monkeypatch.setattr(growth, "GROUP_ROWS", 300)
    monkeypatch.setattr(growth, "LARGE_NODE", 100)
    chunked = growth.grow(growth.Room(None), words, y, rule, 0)
    assert chunked["n"].tolist() == usual["n"].tolist() and chunked["feature"].tolist() == usual["feature"].tolist()


def test_thresholds_lie_between_values_and_bins_are_even():
    assert growth.thresholds(np.array([3.0, 1.0, 1.0, 2.0])).tolist() == [1.5, 2.5]
    assert growth.thresholds(np.ones(5)).tolist() == []
    ends = growth.thresholds(np.arange(3200.0))
    assert len(ends) == 31 and ends[0] == pytest.approx(99.5, abs=1) and len(np.unique(ends)) == 31


@pytest.mark.parametrize(("strategy", "size"), [("sqrt", 7), ("log2", 6), ("onethird", 15), ("all", 44), ("auto", 15), ("5", 5), ("0.25", 11)])
def test_subset_sizes_have_the_names_of_spark(strategy, size):
    assert growth.subset_size(strategy, 44, 10) == size
