"""Queries that train, score and report a forest with the fixed settings on the engineered view.

Predictions depend on the engine, so each query returns what must hold of them, next to what SQL can tell of the rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeflow import fixed_values as fv
from gaugeflow.catalog.data import kept, stored_features, table
from gaugeflow.catalog.registry import query, rounded
from gaugeflow.catalog.twins import CLEANED, features_from, num
from gaugeflow.functions.scalars import numeric_columns
from gaugeflow.operators.forest import Forest
from gaugeflow.operators.learners import Boosted, cross_validate, random_search
from gaugeflow.operators.split import contiguous_folds, split_train_val_test, with_row_hash
from gaugeflow.plans.batch_score import batch_score
from gaugeflow.plans.train_run import model_report, train_run, train_val
from gaugeflow.sources import logs, registry
from gaugeflow.storage import materialise, new_path
from gaugeflow.streaming import jobs

TARGET = fv.VALUE
USED = f"""WITH {CLEANED}, {features_from("cleaned")},
far AS (SELECT quantile_cont("{TARGET}", 0.01) AS a, quantile_cont("{TARGET}", 0.99) AS b FROM features),
used AS (SELECT features.* FROM features, far WHERE "{TARGET}" IS NULL
  OR "{TARGET}" BETWEEN a - {num(fv.FENCE_WIDTH)} * (b - a) AND b + {num(fv.FENCE_WIDTH)} * (b - a))
"""


def parts(spark, folder):
    def make(s, f):
        rows = with_row_hash(stored_features(s, f))
        return materialise(split_train_val_test(rows, TARGET, "row_id", fv.LEAKAGE_COLUMNS), "parts")
    return kept("parts", make, spark, folder)


def features(rows):
    return [c for c in numeric_columns(rows) if c != TARGET]


def trained(spark, folder) -> Forest:
    def make(s, f):
        rows = parts(s, f)
        return Forest().fit(train_val(rows), features(rows), TARGET)
    return kept("forest", make, spark, folder)


def run(spark, folder):
    def make(s, f):
        rows = with_row_hash(stored_features(s, f))
        return train_run(rows, TARGET, "row_id", new_path(s, "models"), "indicator_forest", "1.0",
                         grid=fv.SEARCH_GRID, draws=fv.SEARCH_DRAWS, folds=fv.FOLDS)
    return kept("run", make, spark, folder)


def ordered():
    low, high, p = F.col("confidence_lower"), F.col("confidence_upper"), F.col("prediction")
    return F.coalesce((low <= p) & (p <= high), F.lit(False))


@query("fit_forest", USED + f"""SELECT count(*) AS n_rows, {fv.FOREST_SETTINGS["numTrees"]} AS n_trees, true AS has_splits FROM used""")
def _fit_forest(spark, folder):
    forest = trained(spark, folder)
    rows = parts(spark, folder).agg(F.count("*").alias("n_rows"))
    return rows.withColumns({
        "n_trees": F.lit(forest.model.getNumTrees),
        "has_splits": F.lit(forest.model.totalNumNodes > 10 * forest.model.getNumTrees),
    })


def _predicted(forest, rows):
    """Rows, missing predictions, and predictions outside of the range of the target, which no mean of leaves can leave."""
    ends = rows.agg(F.min(TARGET), F.max(TARGET)).first()
    scored = forest.predict(rows, keep=["row_id"])
    return scored.agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("prediction").isNull()).alias("n_null"),
        F.count_if(~F.col("prediction").between(ends[0] - 1e-6, ends[1] + 1e-6)).alias("n_outside"),
    )


PREDICTED = USED + "SELECT count(*) AS n_rows, 0::BIGINT AS n_null, 0::BIGINT AS n_outside FROM used"


@query("predict", PREDICTED)
def _predict(spark, folder):
    return _predicted(trained(spark, folder), parts(spark, folder))


@query("predict_interval", USED + "SELECT count(*) AS n_rows, count(*) AS n_ordered, count(*) AS n_mean_of_trees FROM used")
def _predict_interval(spark, folder):
    """The interval holds the prediction, and the mean of the trees is what the forest itself predicts."""
    forest, rows = trained(spark, folder), parts(spark, folder)
    scored = forest.predict_interval(rows, keep=forest.features)
    again = forest.predict(
        scored.withColumnsRenamed({"prediction": "mean_of_trees"}).withColumn("in_order", _in_order("mean_of_trees")),
        keep=["mean_of_trees", "in_order"],
    )
    same = F.abs(F.col("prediction") - F.col("mean_of_trees")) <= 1e-6 * (1 + F.abs("prediction"))
    return again.agg(
        F.count("*").alias("n_rows"), F.count_if("in_order").alias("n_ordered"), F.count_if(same).alias("n_mean_of_trees")
    )


def _in_order(name):
    return (F.col("confidence_lower") <= F.col(name)) & (F.col(name) <= F.col("confidence_upper"))


def _errors_hold(tried):
    return all(r["mse_min"] <= r["mse_mean"] <= r["mse_max"] and abs(r["rmse"] ** 2 - r["mse_mean"]) <= 1e-6 * r["mse_mean"]
               for r in tried)


@query("random_search", USED + f"""SELECT count(*) AS n_rows, {fv.SEARCH_DRAWS} AS n_settings, {fv.SEARCH_DRAWS} AS n_distinct,
  true AS best_first, true AS errors_hold, true AS better_than_mean FROM used""")
def _random_search(spark, folder):
    """The search of the training run: all draws from the whole grid. Rows are those of all folds and of the test part."""
    result = run(spark, folder)
    tried, means = result.search, [r["mse_mean"] for r in result.search]
    rows = contiguous_folds(train_val(result.parts), "row_id", fv.FOLDS).groupBy("fold").count()
    tested = result.parts.where(F.col("split") == "test").agg(F.count("*").alias("count"), F.lit(fv.FOLDS).alias("fold"))
    variance = train_val(result.parts).agg(F.var_pop(TARGET)).first()[0]
    return rows.unionByName(tested.withColumn("fold", F.col("fold").cast(rows.schema["fold"].dataType))).agg(
        F.sum("count").alias("n_rows"),
    ).withColumns({
        "n_settings": F.lit(len(tried)), "n_distinct": F.lit(len({tuple(r[k] for k in fv.SEARCH_GRID) for r in tried})),
        "best_first": F.lit(means == sorted(means)), "errors_hold": F.lit(_errors_hold(tried)),
        "better_than_mean": F.lit(max(means) < variance),
    })


@query("cross_validate", "SELECT 1 AS n_settings, true AS errors_hold, true AS better_than_mean")
def _cross_validate(spark, folder):
    """Fixed settings, fixed number of folds; the error stays below the variance of the target."""
    rows = parts(spark, folder)
    report = cross_validate(Forest(), train_val(rows), features(rows), TARGET, "row_id", fv.FOLDS)
    variance = rows.agg(F.var_pop(TARGET)).first()[0]
    return spark.range(1).select(
        F.lit(len(report)).alias("n_settings"), F.lit(_errors_hold(report)).alias("errors_hold"),
        F.lit(report[0]["mse_mean"] < variance).alias("better_than_mean"),
    )


@query("final_fit", USED + "SELECT count(*) AS n_rows, 3::BIGINT AS n_parts, 3::BIGINT AS n_better_than_mean FROM used")
def _final_fit(spark, folder):
    """The last fit sees train and validation rows; on each part its squared error is below that of the part's mean."""
    scored = trained(spark, folder).predict(parts(spark, folder), keep=["split", TARGET])
    gap = F.col("prediction") - F.col(TARGET)
    each = scored.groupBy("split").agg(
        F.count("*").alias("n"), F.avg(gap * gap).alias("mse"), F.var_pop(TARGET).alias("variance")
    )
    return each.agg(
        F.sum("n").alias("n_rows"), F.count("*").alias("n_parts"), F.count_if(F.col("mse") < F.col("variance")).alias("n_better_than_mean")
    )


@query("feature_importance", "SELECT 1.0::DOUBLE AS total, 0::BIGINT AS n_negative, 0::BIGINT AS n_unknown, 0::BIGINT AS n_rising")
def _feature_importance(spark, folder):
    """Importances of known features only: none is negative, they sum to one and fall."""
    forest = trained(spark, folder)
    found = forest.feature_importance(spark)
    values = [r["Importance"] for r in found.collect()]  # one row a feature
    return found.agg(
        F.round(F.sum("Importance"), 6).alias("total"), F.count_if(F.col("Importance") < 0).alias("n_negative"),
        F.count_if(~F.col("Feature").isin(forest.features)).alias("n_unknown"),
        F.lit(sum(a < b for a, b in zip(values, values[1:]))).cast("long").alias("n_rising"),
    )


@query("feature_importance_topk", "SELECT 10::BIGINT AS n_rows, true AS largest")
def _feature_importance_topk(spark, folder):
    forest = trained(spark, folder)
    top = forest.feature_importance(spark, top=10)
    least = top.agg(F.count("*").alias("n_rows"), F.min("Importance").alias("least"))
    above = sorted(forest.model.featureImportances.toArray().tolist())[-10]
    return least.select("n_rows", (F.abs(F.col("least") - F.lit(above)) < 1e-12).alias("largest"))


@query("model_report", USED + f"""SELECT count(*) AS n_rows, 'RandomForestRegressionModel' AS model_type,
  {fv.FOREST_SETTINGS["numTrees"]} AS n_trees, 'maxDepth={fv.FOREST_SETTINGS["maxDepth"]}' AS depth, true AS complete FROM used""")
def _model_report(spark, folder):
    """Trees and depth are those given to the run, as in the SQL; ``complete`` tells that the model has those found."""
    report = model_report(run(spark, folder))
    told = ["mae", "mse", "rmse", "r2", "cv_mse_mean", "cv_mse_std", "train_test_gap_pct", "top_features", "leakage_warnings", "dropped_columns"]
    complete = F.lit(True)
    for name in told:
        complete = complete & F.col(name).isNotNull()
    found = F.regexp_extract("best_settings", r"numTrees=(\d+)", 1)
    complete = complete & (F.col("n_settings_tried") == fv.SEARCH_DRAWS) & (found == F.col("n_trees").cast("string"))
    return report.select(
        (F.col("n_train") + F.col("n_val") + F.col("n_test")).alias("n_rows"), "model_type",
        F.regexp_extract("given_settings", r"numTrees=(\d+)", 1).cast("int").alias("n_trees"),
        F.regexp_extract("given_settings", r"maxDepth=\d+", 0).alias("depth"), complete.alias("complete"),
    )


@query("train_run", PREDICTED)
def _train_run(spark, folder):
    result = run(spark, folder)
    return _predicted(result.learner, result.parts)


@query("boosted_run", PREDICTED)
def _boosted_run(spark, folder):
    """Another kind of model through the same run: search, validation, fit, saving, reloading and scoring."""
    rows = with_row_hash(stored_features(spark, folder))
    result = train_run(rows, TARGET, "row_id", new_path(spark, "models"), "indicator_boosted", "1.0", learner=Boosted,
                       settings={"maxIter": 5, "maxDepth": 4}, grid={"maxDepth": [3, 4]}, draws=2, folds=2)
    ends = result.parts.agg(F.min(TARGET), F.max(TARGET)).first()
    low, high = ends[0] - (ends[1] - ends[0]), ends[1] + (ends[1] - ends[0])  # sums of trees may leave the range a little
    scored = result.learner.predict(result.parts, keep=["row_id"])
    return scored.agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("prediction").isNull()).alias("n_null"),
        F.count_if(~F.col("prediction").between(low, high)).alias("n_outside"),
    )


SCORING_RULES = {
    "ranges": [("YearStart", 2000.0, 2030.0, True), ("ConfidenceIntervalWidth", 0.0, None, False),
               ("Latitude", 20.0, 50.0, True), ("Longitude", -130.0, -60.0, True)],
    "required_flags": [], "optional_flags": [],
}


def scored_rows(spark, folder):
    """Accept, complete, predict with interval, flag and round: the whole batch scoring job."""
    rows = with_row_hash(stored_features(spark, folder))
    keep = ["row_id", "YearStart", "Latitude", "Longitude"]
    return batch_score(trained(spark, folder), rows, SCORING_RULES, keep=keep)


@query("batch_score", f"""WITH {CLEANED}, {features_from("cleaned")}
SELECT "YearStart", round("Latitude", 6) AS latitude, round("Longitude", 6) AS longitude, true AS ordered, 0 AS missing_features
FROM features WHERE "ConfidenceIntervalWidth" >= 0 AND "Latitude" BETWEEN 20 AND 50 AND "Longitude" BETWEEN -130 AND -60
  AND "YearStart" BETWEEN 2000 AND 2030""")
def _batch_score(spark, folder):
    scored = scored_rows(spark, folder)
    return scored.select(
        "YearStart", F.round("Latitude", 6).alias("latitude"), F.round("Longitude", 6).alias("longitude"),
        ordered().alias("ordered"), F.col("missing_features").cast("int").alias("missing_features"),
    )


@query("batch_score_counts", f"""WITH {CLEANED}, {features_from("cleaned")}
SELECT count(*) AS n_rows, 0::BIGINT AS n_unordered, 0::BIGINT AS n_missing FROM features
WHERE "ConfidenceIntervalWidth" >= 0 AND "Latitude" BETWEEN 20 AND 50 AND "Longitude" BETWEEN -130 AND -60
  AND "YearStart" BETWEEN 2000 AND 2030""")
def _batch_score_counts(spark, folder):
    scored = scored_rows(spark, folder)
    p = F.col("prediction")
    return scored.agg(
        F.count("*").alias("n_rows"),
        F.count_if((p < F.col("confidence_lower")) | (p > F.col("confidence_upper")) | p.isNull()).alias("n_unordered"),
        F.sum(F.col("missing_features").cast("bigint")).alias("n_missing"),
    )


@query("save_load_model", f"""WITH {CLEANED} SELECT count(*) AS n_rows, 0.0::DOUBLE AS max_difference FROM cleaned""")
def _save_load_model(spark, folder):
    """Predictions of the saved and reloaded model, against those of the model in memory."""
    forest, base = trained(spark, folder), new_path(spark, "models")
    registry.save_regressor(forest, spark, base, "indicator_forest", "1.1")
    again = registry.load_regressor(spark, base, "indicator_forest", "1.1")
    rows = stored_features(spark, folder)
    first = forest.predict(again.predict(rows, keep=forest.features).withColumnRenamed("prediction", "reloaded"), keep=["reloaded"])
    return rounded(first.agg(
        F.count("*").alias("n_rows"), F.max(F.abs(F.col("prediction") - F.col("reloaded"))).alias("max_difference")))


@query("list_models", """SELECT 'forest_vivid' AS name, v AS version, 'forest_vivid_v' || v AS file, true AS has_size
FROM (VALUES ('1.0'), ('2_beta')) AS t(v)""")
def _list_models(spark, folder):
    forest, base = trained(spark, folder), new_path(spark, "models")
    for version in ("1.0", "2_beta"):
        registry.save_regressor(forest, spark, base, "forest_vivid", version)
    return registry.list_models(spark, base).select("name", "version", "file", (F.col("size_mb") > 0).alias("has_size"))


@query("score_stream", "SELECT ts AS timestamp, 2 AS features_used, true AS ordered FROM events")
def _score_stream(spark, folder):
    def make(s, f):
        events = table(s, f, "events").select("event_id", "user_id", F.hour("ts").alias("hour"), "value")
        return Forest().fit(events, ["user_id", "hour"], "value")
    forest = kept("event-forest", make, spark, folder)
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    rows = jobs.read_stream(spark, folder, schema, pattern="events.parquet").withColumn("hour", F.hour("ts"))
    path = new_path(spark, "score-stream")

    def score(batch):
        scored = forest.predict_interval(batch, keep=["ts"]).withColumnRenamed("ts", "timestamp")
        return logs.prediction_records(scored, len(forest.features))

    jobs.score_stream(rows, score, path).awaitTermination()
    naive = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col("timestamp").cast("timestamp_ntz"))
    return logs.read_predictions(spark, path).select(naive.alias("timestamp"), "features_used", ordered().alias("ordered"))
