"""Random-forest regression on Spark ML: leaf tables, intervals from one transform, nested evaluation of settings."""

from __future__ import annotations

import math
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow import fixed_values as fv
from gaugeflow.functions.scalars import quoted
from gaugeflow.operators import growth
from gaugeflow.operators.learners import Regressor
from gaugeflow.storage import new_path

#: Leaves of a forest up to which their values travel with a task (8 bytes a leaf and depth).
MOST_LEAVES = 1 << 22
#: A setting that changes the speed of a fit only: the node of each row and tree is kept instead of found anew.
FIT_SETTINGS = {"cacheNodeIds": True}
#: Trees that are grown together. Each row updates the statistics of one node a tree, so with few trees these stay near the core.
TREES_AT_ONCE = 20
#: Batches of trees that grow side by side, so that tasks run while the driver picks the splits of another batch.
BATCHES_AT_ONCE = 2
#: Distance of the seeds of two batches. Spark adds the partition number to a seed, so neighbours would share random numbers.
SEED_STEP = 1_000_003
#: Bytes of a fit's cached rows that one task may read: a row holds two numbers a tree and one a feature.
FIT_TASK_BYTES = 256 << 20
#: Rows from which on trees grow over packed rows (``growth``) and not in Spark ML.
PACKED_ROWS = 10_000
#: Nodes from which on rows walk through a table of all nodes by array operations and not through the objects of Spark ML.
WALKED_NODES = 20_000


@dataclass
class LeafTable:
    """Values of all leaves of a forest, tree by tree in the order of Spark's leaf numbers, cut at several depths."""

    first: np.ndarray  # place of each tree's first leaf
    values: np.ndarray  # one row per depth

    def votes(self, leaves: np.ndarray, depth: int = 0) -> np.ndarray:
        """What each tree says, for rows of leaf numbers."""
        return self.values[depth][leaves.astype(np.int64) + self.first[:leaves.shape[1]]]


@dataclass
class NodeTable:
    """All nodes of a forest, tree by tree: what a row needs on its way down, and the values at several depths.

    A step is one number: the feature, the last bin on its left side and the place of the left child, which the right
    one follows; a leaf leads to itself. Bins are numbers of the thresholds that the forest has for a feature.
    """

    roots: np.ndarray
    steps: np.ndarray
    values: np.ndarray  # one row per depth
    ends: list[np.ndarray]
    depth: int

    FEATURE, BIN = 16, 15  # bits

    def votes(self, x: np.ndarray) -> list[np.ndarray]:
        """What each tree says about rows of features, for every depth."""
        bins = np.stack([np.searchsorted(e, x[:, i], "left") for i, e in enumerate(self.ends)], 1).astype(np.int16).ravel()
        found = [np.empty((len(x), len(self.roots))) for _ in self.values]
        first = np.arange(len(x), dtype=np.int64) * len(self.ends)
        for t, root in enumerate(self.roots):
            at = np.full(len(x), root, np.int64)
            for _ in range(self.depth):
                step = self.steps[at]
                feature, last = step & ((1 << self.FEATURE) - 1), (step >> self.FEATURE) & ((1 << self.BIN) - 1)
                at = (step >> (self.FEATURE + self.BIN)) + (bins[first + feature] > last)
            for votes, values in zip(found, self.values):
                votes[:, t] = values[at]
        return found


def node_table(spark: SparkSession, model: RandomForestRegressionModel, depths: Sequence[int] = (31,)) -> NodeTable | None:
    """All nodes from the saved form of the model, or None where a feature has categories or too many thresholds."""
    feature, threshold, left, right, starts, cut = _saved_nodes(spark, model, depths)
    inner = np.flatnonzero(left >= 0)
    ends = [np.empty(0)] * model.numFeatures
    for f in np.unique(feature[inner]):
        ends[f] = np.unique(threshold[feature == f])
    if max(map(len, ends)) >= (1 << NodeTable.BIN) - 1 or len(ends) >= 1 << NodeTable.FEATURE or np.isnan(threshold[inner]).any():
        return None
    place = np.arange(len(left))  # nodes in the order in which siblings are neighbours
    level, depth, at = starts, 0, len(starts)
    place[starts] = np.arange(len(starts))
    offset = np.repeat(starts, np.diff([*starts, len(left)]))
    while len(level):
        parents = level[left[level] >= 0]
        below = np.stack([offset[parents] + left[parents], offset[parents] + right[parents]], 1).ravel()
        place[below] = np.arange(at, at + len(below))
        at, depth, level = at + len(below), depth + 1, below
    last = np.full(len(left), (1 << NodeTable.BIN) - 1)
    for f in np.unique(feature[inner]):
        own = inner[feature[inner] == f]
        last[own] = np.searchsorted(ends[f], threshold[own])
    child = place.copy()
    child[inner] = place[offset[inner] + left[inner]]
    steps, values = np.empty(len(left), np.int64), np.empty_like(cut)
    steps[place] = (child << (NodeTable.FEATURE + NodeTable.BIN)) | (last << NodeTable.FEATURE) | np.maximum(feature, 0)
    values[:, place] = cut
    return NodeTable(place[starts], steps, values, ends, depth - 1)


def _saved_nodes(spark: SparkSession, model: RandomForestRegressionModel, depths: Sequence[int]):
    """Feature, threshold and children of all nodes, first nodes of the trees, and values at the depths.

    Nodes are read from the saved form of the model, where a tree lies in pre-order; a node below a depth has the value of
    its ancestor there.
    """
    path = getattr(model, "saved_at", None)
    if path is None:
        path = new_path(spark, "trees")
        model.write().save(path)
    split = F.col("nodeData.split")
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.prediction", "nodeData.leftChild", "nodeData.rightChild", split["featureIndex"].alias("f"),
        F.when(split["numCategories"] == -1, F.get(split["leftCategoriesOrThreshold"], 0)).alias("end"),
    ).toArrow()  # the driver holds the model anyway
    tree, number, value, left, right, feature, threshold = (nodes.column(c).to_numpy() for c in nodes.column_names)
    order = np.lexsort((number, tree))
    tree, value, left, right = tree[order], value[order], left[order], right[order]
    starts = np.searchsorted(tree, np.arange(tree.max() + 1))
    cut = np.tile(value, (len(depths), 1))
    level, depth = starts, 0
    while len(level):
        parents = level[left[level] >= 0]
        below = [starts[tree[parents]] + side[parents] for side in (left, right)]
        depth += 1
        for k, most in enumerate(depths):
            if depth > most:
                for children in below:
                    cut[k, children] = cut[k, parents]
        level = np.concatenate(below)
    return feature[order], threshold[order].astype(float), left, right, starts, cut


def leaf_table(spark: SparkSession, model: RandomForestRegressionModel, depths: Sequence[int] = (31,)) -> LeafTable:
    """Leaf values read from the saved form of the model, where leaves are numbered from left to right."""
    _, _, left, _, starts, cut = _saved_nodes(spark, model, depths)
    leaves = np.flatnonzero(left < 0)
    return LeafTable(np.searchsorted(leaves, starts), cut[:, leaves])


def _rows_of(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1) if len(lists) else np.zeros((0, 1))


def mean_and_spread(table: LeafTable | NodeTable):
    """Arrow function from leaf numbers, or from features, to mean and population deviation over the trees."""
    @F.arrow_udf("struct<mean double, spread double>")
    def judged(found: pa.Array) -> pa.Array:
        votes = table.votes(_rows_of(found)) if isinstance(table, LeafTable) else _walked(table, found)[0]
        return pa.StructArray.from_arrays([pa.array(votes.mean(1)), pa.array(votes.std(1))], ["mean", "spread"])

    return judged


def _walked(table: NodeTable, features: pa.Array) -> list[np.ndarray]:
    return table.votes(features.flatten().to_numpy(zero_copy_only=False).reshape(len(features), len(table.ends)))


def mean_of_trees(table: NodeTable):
    """Arrow function from features to the mean over the trees."""
    @F.arrow_udf("double")
    def judged(features: pa.Array) -> pa.Array:
        return pa.array(_walked(table, features)[0].mean(1))

    return judged


def nested_squares(table: LeafTable | NodeTable, members: Sequence[tuple[int, int]]):
    """Arrow function from leaf numbers, or features, and label to the squared errors of (trees, place of depth) members."""
    @F.arrow_udf("array<double>")
    def judged(found: pa.Array, label: pa.Array) -> pa.Array:
        y, depths = label.to_numpy(zero_copy_only=False), {d for _, d in members}
        if isinstance(table, LeafTable):
            numbers = _rows_of(found)
            votes = {d: table.votes(numbers, d) for d in depths}
        else:
            votes = dict(enumerate(_walked(table, found)))
        sums = {d: np.cumsum(votes[d], 1) for d in depths}
        errors = np.stack([(sums[d][:, t - 1] / t - y) ** 2 for t, d in members], 1)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1) * len(members), pa.int32()), pa.array(errors.ravel()))

    return judged


class Forest(Regressor):
    estimator_class, model_class = RandomForestRegressor, RandomForestRegressionModel
    default_settings = fv.FOREST_SETTINGS

    def estimator(self):
        return RandomForestRegressor(
            featuresCol="features", labelCol="label", predictionCol="prediction", **{"seed": 42, **FIT_SETTINGS, **self.settings}
        )

    def batches(self) -> list[dict]:
        """Changes of the settings for each batch of trees; the first one has the seed of the whole."""
        trees, seed = int(self.settings.get("numTrees", 20)), int(self.settings.get("seed", 42))
        n = max(1, math.ceil(trees / TREES_AT_ONCE))
        return [{"numTrees": (trees + n - 1 - k) // n, "seed": seed + k * SEED_STEP} for k in range(n)]

    def fit_rows(self, rows: DataFrame, weight: str | None = None):
        """All trees see all rows, but grow in batches: trees are drawn independently of each other.

        The rows are kept under a mark of their own, since Spark would share them with another fit on the same fold, and
        the first of the two that ends would drop them. Large tables are packed first and their trees grow by array operations.
        """
        if weight is None and growth.knows(self.settings, rows) and rows.count() >= PACKED_ROWS:
            return self.grown(rows)
        batches, rows = self.batches(), self.dealt(rows)
        if len(batches) == 1:
            return super().fit_rows(rows, weight)
        rows = rows.withColumn("__fit", F.lit(uuid.uuid4().hex)).persist()
        try:
            def grown(changes: Mapping[str, object]) -> RandomForestRegressionModel:
                return super(Forest, self.copy(**changes)).fit_rows(rows, weight)

            with ThreadPool(BATCHES_AT_ONCE) as pool:
                models = pool.map(inheritable_thread_target(rows.sparkSession)(grown), batches, chunksize=1)
        finally:
            rows.unpersist()
        return self.joined(rows.sparkSession, models)

    def grown(self, rows: DataFrame) -> RandomForestRegressionModel:
        path = new_path(rows.sparkSession, "forest")
        growth.write_forest(rows, self.settings, self.batches(), len(self.features), self.estimator(), path)
        model = self.estimator()._copyValues(RandomForestRegressionModel.load(path))
        model.saved_at = path  # the folder lasts as long as the application
        return model

    def walked(self, spark: SparkSession, depths: Sequence[int] = (31,)) -> NodeTable | None:
        """The table of all nodes of a forest that is large, but not too large to travel with a task."""
        if not WALKED_NODES <= self.trained().totalNumNodes <= 2 * MOST_LEAVES:
            return None
        return node_table(spark, self.trained(), depths)

    def predict_rows(self, rows: DataFrame) -> DataFrame:
        table = self.walked(rows.sparkSession)
        if table is None:
            return super().predict_rows(rows)
        return rows.withColumn("prediction", mean_of_trees(table)(vector_to_array("features")))

    def joined(self, spark: SparkSession, models: Sequence[RandomForestRegressionModel]) -> RandomForestRegressionModel:
        """One forest of the trees of several, in their order."""
        trees = [t for m in models for t in m._java_obj.trees()]
        kinds, first = spark._jvm.org.apache.spark.ml.regression, models[0]._java_obj
        array = spark.sparkContext._gateway.new_array(kinds.DecisionTreeRegressionModel, len(trees))
        for i, tree in enumerate(trees):
            array[i] = tree
        whole = RandomForestRegressionModel(kinds.RandomForestRegressionModel(first.uid(), array, first.numFeatures()))
        return self.estimator()._copyValues(whole).copy()  # the copy has the settings on both sides

    def dealt(self, rows: DataFrame) -> DataFrame:
        """Rows in as many partitions as their cached form needs, which is far larger than the file that they come from."""
        row_bytes = 8 * int(self.settings.get("numTrees", 20)) + 4 * len(self.features) + 100
        needed = math.ceil(rows.count() * row_bytes / FIT_TASK_BYTES)
        return rows if rows.rdd.getNumPartitions() >= needed else rows.repartition(needed)

    def leaves_of(self, rows: DataFrame) -> tuple[Column, DataFrame]:
        """Leaf numbers of all trees as a column, and the rows that have it, from one transform."""
        return vector_to_array(F.col("__leaves")), self.trained().copy().setLeafCol("__leaves").transform(rows)

    def predict_interval(self, df: DataFrame, keep: Sequence[str] = (), width: float = fv.INTERVAL_WIDTH) -> DataFrame:
        """Mean and population deviation over the trees, and mean ± width · deviation.

        One transform names the leaf of each tree and a table of leaf values gives mean and spread. A forest with more
        leaves than a task may hold is asked tree by tree instead, with the same result.
        """
        self.checked(df)
        rows = self.assembled(df, keep, with_label=False)
        kept = [quoted(k) for k in keep]
        if self.trained().totalNumNodes <= 2 * MOST_LEAVES:
            table = self.walked(df.sparkSession)
            if table is None:
                table, (asked, scored) = leaf_table(df.sparkSession, self.trained()), self.leaves_of(rows)
            else:
                asked, scored = vector_to_array("features"), rows
            judge = mean_and_spread(table)
            found = scored.select(*kept, judge(asked).alias("__found")).select(
                *kept, F.col("__found.mean").alias("prediction"), F.col("__found.spread").alias("prediction_std")
            )
        else:
            found = self._tree_by_tree(rows, kept)
        return found.withColumns({
            "confidence_lower": F.col("prediction") - width * F.col("prediction_std"),
            "confidence_upper": F.col("prediction") + width * F.col("prediction_std"),
        })

    def _tree_by_tree(self, rows: DataFrame, kept: Sequence[Column]) -> DataFrame:
        names = []
        for i, tree in enumerate(self.trained().trees):
            names.append(f"__tree{i}")
            rows = tree.setPredictionCol(names[-1]).transform(rows)
        n = float(len(names))
        mean = F.aggregate("__votes", F.lit(0.0), lambda a, x: a + x, lambda a: a / n)
        spread = F.aggregate(
            "__votes", F.lit(0.0), lambda a, x: a + (x - F.col("prediction")) * (x - F.col("prediction")),
            lambda a: F.sqrt(a / n),
        )
        return rows.select(*kept, F.array(*names).alias("__votes")).withColumn("prediction", mean).withColumn(
            "prediction_std", spread
        ).drop("__votes")

    def families(self, settings: Sequence[Mapping[str, object]]) -> list[list[int]]:
        """Settings that differ in the number of trees and in depth alone are one family."""
        found: dict[tuple, list[int]] = {}
        for i, s in enumerate(settings):
            rest = tuple(sorted((k, repr(v)) for k, v in s.items() if k not in ("numTrees", "maxDepth")))
            found.setdefault(rest, []).append(i)
        return list(found.values())

    def errors(self, rows: DataFrame, settings: Sequence[Mapping[str, object]], fold: int) -> list[float]:
        """One fit for a family, with its most trees and its largest depth.

        A smaller member is the first trees of the list, cut at its depth: trees are drawn independently of each other and
        grow level by level, and a cut node predicts the mean of the rows that it held. So all errors come from one
        scoring pass with the leaf table.
        """
        whole = [{**self.settings, **s} for s in settings]
        trees, depths = [int(s["numTrees"]) for s in whole], [int(s["maxDepth"]) for s in whole]
        largest = self.copy(**{**settings[0], "numTrees": max(trees), "maxDepth": max(depths)})
        largest.model = largest.fit_rows(rows.where(F.col("fold") != fold))
        held_out = rows.where(F.col("fold") == fold)
        if largest.model.totalNumNodes > 2 * MOST_LEAVES:
            return super().errors(rows, settings, fold)
        each = sorted(set(depths))
        table = largest.walked(rows.sparkSession, each)
        if table is None:
            table, (asked, scored) = leaf_table(rows.sparkSession, largest.model, each), largest.leaves_of(held_out)
        else:
            asked, scored = vector_to_array("features"), held_out
        squares = nested_squares(table, [(t, each.index(d)) for t, d in zip(trees, depths)])
        found = scored.select(squares(asked, F.col("label")).alias("e"))
        return list(found.agg(*[F.avg(F.col("e")[i]) for i in range(len(settings))]).first())
