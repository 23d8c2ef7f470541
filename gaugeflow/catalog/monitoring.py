"""Queries for noise injection, splits, scoring, drift, alerts and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeflow import fixed_values as fv
from gaugeflow.catalog.data import stored_view, table
from gaugeflow.catalog.quality import stats_sql, union
from gaugeflow.catalog.registry import query, rounded
from gaugeflow.catalog.twins import CENTROIDS, COLUMNS, INDICATORS, coordinate, num, rnd, share, text
from gaugeflow.operators import alerts, checks, drift, inject, ranking, scoring, split
from gaugeflow.operators.columns import geo_extract
from gaugeflow.operators.lookups import centroid_fill
from gaugeflow.operators.outliers import fences
from gaugeflow.operators.profile import feature_stats
from gaugeflow.sources import logs, reference_stats, registry
from gaugeflow.storage import new_path
from gaugeflow.streaming import jobs

VIEW = f"WITH {INDICATORS}\n"


def drawn(label: str, row_id: str = '"ResponseID"') -> str:
    return share(42, f"{text(label + '|')} || {row_id}")


# --- noise injection --------------------------------------------------------------------------------
@query("inject_missing", VIEW + "SELECT " + ", ".join(
    f'CASE WHEN {drawn(c)} >= 0.2 THEN "{c}" END AS "{c}"' if c in inject.MISSING_COLUMNS else f'"{c}"' for c in COLUMNS
) + " FROM ind")
def _inject_missing(spark, folder):
    return inject.inject_missing(stored_view(spark, folder), "ResponseID")


@query("inject_outliers", VIEW + f''', drawn AS (SELECT *, {drawn("row")} < 0.05 AS chosen, {drawn("value")} AS far FROM ind)
SELECT {", ".join(
    """CASE WHEN chosen THEN CAST(CAST(floor(500 + 2500 * far) AS DOUBLE) AS VARCHAR) ELSE "DataValue" END AS "DataValue" """ if c == "DataValue"
    else """CASE WHEN chosen THEN 'Number' ELSE "DataValueType" END AS "DataValueType" """ if c == "DataValueType" else f'"{c}"'
    for c in COLUMNS)} FROM drawn''')
def _inject_outliers(spark, folder):
    return inject.inject_outliers(stored_view(spark, folder), "ResponseID")


@query("inject_duplicates", f"""
SELECT event_id, value FROM events UNION ALL
SELECT event_id, value FROM events WHERE {share(42, "'copy|' || event_id")} < 0.1""")
def _inject_duplicates(spark, folder):
    return inject.inject_duplicates(table(spark, folder, "events").select("event_id", "value"), "event_id")


@query("inject_constants", """SELECT event_id, value, 'Diabetes' AS "Constant_Topic", 'Prevalence' AS "Constant_Question",
  2020 AS "Constant_Year" FROM events""")
def _inject_constants(spark, folder):
    return inject.inject_constants(table(spark, folder, "events").select("event_id", "value"))


# --- splits and their checks ------------------------------------------------------------------------
TRAIN, VAL = 1.0 - 0.1 - 0.2, 1.0 - 0.1 - 0.2 + 0.1
SPLIT = f"""shared AS (SELECT event_id, user_id, value, {share(42, "event_id")} AS s FROM events),
far AS (SELECT quantile_cont(value, 0.01) AS a, quantile_cont(value, 0.99) AS b FROM events),
parts AS (
  SELECT event_id, user_id, value,
    CASE WHEN s < {num(TRAIN)} THEN 'train' WHEN s < {num(VAL)} THEN 'val' ELSE 'test' END AS split
  FROM shared, far WHERE value BETWEEN a - 3 * (b - a) AND b + 3 * (b - a))"""


def split_events(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "value", "props")
    return split.split_train_val_test(events, "value", "event_id", drop=["props"])


@query("split_train_val_test", f"WITH {SPLIT} SELECT * FROM parts")
def _split(spark, folder):
    return split_events(spark, folder)


@query("contiguous_folds", f"""
SELECT CAST(floor({share(42, "event_id")} * 3) AS INTEGER) AS fold, count(*) AS n_rows FROM events GROUP BY 1""")
def _folds(spark, folder):
    return split.contiguous_folds(table(spark, folder, "events"), "event_id").groupBy("fold").agg(F.count("*").alias("n_rows"))


SIDES = """sides AS (SELECT avg(value) FILTER (split = 'train') AS train_mean, avg(value) FILTER (split = 'val') AS val_mean,
  avg(value) FILTER (split = 'test') AS test_mean, count(*) FILTER (split = 'train') AS n_train,
  count(*) FILTER (split = 'test') AS n_test FROM parts)"""


@query("split_balance", f"""WITH {SPLIT}, {SIDES}, gaps AS (
  SELECT *, abs(train_mean - test_mean) / greatest(abs(train_mean), 1e-10) * 100 AS gap, n_train::DOUBLE / (n_train + n_test) AS part FROM sides)
SELECT {rnd("train_mean")} AS train_mean, {rnd("test_mean")} AS test_mean, n_train, n_test, {rnd("gap")} AS diff_pct,
  {rnd("part")} AS train_share, gap > 10 AS mean_warning, part NOT BETWEEN 0.6 AND 0.9 AS share_warning FROM gaps""")
def _split_balance(spark, folder):
    return rounded(split.split_balance(split_events(spark, folder), "value"))


@query("split_mean_spread", f"""WITH {SPLIT}, {SIDES}, gaps AS (SELECT *, 100 * greatest(
    abs(train_mean - val_mean) / greatest(abs(train_mean), 1e-10), abs(train_mean - test_mean) / greatest(abs(train_mean), 1e-10),
    abs(val_mean - test_mean) / greatest(abs(val_mean), 1e-10)) AS gap FROM sides)
SELECT {rnd("train_mean")} AS train_mean, {rnd("val_mean")} AS val_mean, {rnd("test_mean")} AS test_mean,
  {rnd("gap")} AS max_diff_pct, gap > 20 AS warning FROM gaps""")
def _split_mean_spread(spark, folder):
    return rounded(split.split_mean_spread(split_events(spark, folder), "value"))


def scaled(spark, folder, scaler: str):
    """Lineitem numbers scaled with the statistics of their train part."""
    cols = ["l_quantity", "l_extendedprice", "l_discount"]
    lines = table(spark, folder, "lineitem").select("l_orderkey", *cols)
    part = F.when(split.hash_share(F.col("l_orderkey"), 42) < 0.7, F.lit("train")).otherwise(F.lit("test"))
    lines = lines.withColumn("split", part)
    row = lines.where("split = 'train'").agg(*[
        agg.alias(f"{name}_{c}") for c in cols for name, agg in (
            ("mean", F.avg(c)), ("std", F.stddev_samp(c)), ("min", F.min(c)), ("max", F.max(c)))
    ]).first()
    middle, width = ("mean", "std") if scaler == "StandardScaler" else ("min", "max")

    def apply(c):
        scale = row[f"std_{c}"] if width == "std" else row[f"max_{c}"] - row[f"min_{c}"]
        return ((F.col(c) - row[f"{middle}_{c}"]) / scale).alias(c)

    done = lines.select("split", *[apply(c) for c in cols])
    return checks.scaling_check(done.where("split = 'train'"), done.where("split = 'test'"), cols, scaler)


def _scaling_sql(scaler: str) -> str:
    cols = ["l_quantity", "l_extendedprice", "l_discount"]
    scale = {
        "StandardScaler": "({c} - avg({c}) FILTER (split = 'train') OVER ()) / (stddev_samp({c}) FILTER (split = 'train') OVER ())",
        "MinMaxScaler": "({c} - min({c}) FILTER (split = 'train') OVER ()) / "
                        "(max({c}) FILTER (split = 'train') OVER () - min({c}) FILTER (split = 'train') OVER ())",
    }[scaler]
    first = {"StandardScaler": "abs(avg({c}) FILTER (split = 'train')) > 0.01",
             "MinMaxScaler": "min({c}) FILTER (split = 'train') NOT BETWEEN -0.01 AND 0.01"}[scaler]
    second = {"StandardScaler": "stddev_samp({c}) FILTER (split = 'train') NOT BETWEEN 0.9 AND 1.1",
              "MinMaxScaler": "max({c}) FILTER (split = 'train') NOT BETWEEN 0.99 AND 1.01"}[scaler]
    low = "least(" + ", ".join(f"min({c}) FILTER (split = 'test')" for c in cols) + ")"
    high = "greatest(" + ", ".join(f"max({c}) FILTER (split = 'test')" for c in cols) + ")"
    return f"""WITH parts AS (SELECT *, CASE WHEN {share(42, "l_orderkey")} < 0.7 THEN 'train' ELSE 'test' END AS split FROM lineitem),
scaled AS (SELECT split, {", ".join(f"{scale.format(c=c)} AS {c}" for c in cols)} FROM parts)
SELECT '{scaler}' AS scaler, {" + ".join(f"CAST({first.format(c=c)} AS BIGINT)" for c in cols)} AS n_first_off,
  {" + ".join(f"CAST({second.format(c=c)} AS BIGINT)" for c in cols)} AS n_second_off,
  {rnd(low)} AS test_min, {rnd(high)} AS test_max, {low} < -5 OR {high} > 5 AS extreme_warning FROM scaled"""


@query("scaling_check", _scaling_sql("StandardScaler"))
def _scaling_standard(spark, folder):
    return rounded(scaled(spark, folder, "StandardScaler"))


@query("scaling_check_minmax", _scaling_sql("MinMaxScaler"))
def _scaling_minmax(spark, folder):
    return rounded(scaled(spark, folder, "MinMaxScaler"))


@query("prediction_check", f"""WITH p AS (SELECT o_totalprice AS y, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice * 4 ELSE o_totalprice - 9 END AS p FROM orders)
SELECT 'regression' AS task, 0::BIGINT AS n_nan, 0::BIGINT AS n_infinite, {rnd("min(p)")} AS pred_min, {rnd("max(p)")} AS pred_max,
  min(y) AS target_min, max(y) AS target_max, min(p) < min(y) - 2 * (max(y) - min(y)) AS low_warning,
  max(p) > max(y) + 2 * (max(y) - min(y)) AS high_warning FROM p""")
def _prediction_check(spark, folder):
    y = F.col("o_totalprice")
    orders = table(spark, folder, "orders").select(
        y.alias("y"), F.when(F.col("o_orderkey") % 3 == 0, y * 4).otherwise(y - 9).alias("p"))
    return rounded(checks.prediction_check(orders, "p", "y"))


@query("prediction_check_classes", f"""WITH p AS (SELECT quality AS y, (quality + toxic * 0.5::DOUBLE) * 0.9::DOUBLE - 0.05::DOUBLE AS p FROM labels)
SELECT 'classification' AS task, 0::BIGINT AS n_nan, 0::BIGINT AS n_infinite, {rnd("min(p)")} AS pred_min, {rnd("max(p)")} AS pred_max,
  min(y)::DOUBLE AS target_min, max(y)::DOUBLE AS target_max, min(p) < 0 AS low_warning, max(p) > 1 AS high_warning FROM p""")
def _prediction_check_classes(spark, folder):
    p = (F.col("quality") + F.col("toxic") * 0.5) * 0.9 - 0.05
    labels = table(spark, folder, "labels").select(F.col("quality").alias("y"), p.alias("p"))
    return rounded(checks.prediction_check(labels, "p", "y", task="classification"))


LEAKY = """leaky AS (SELECT l_extendedprice AS price, l_extendedprice * 1.02 + l_tax AS price_code, l_quantity AS quantity,
  l_discount AS discount, 7 AS same, year(l_shipdate) AS "YearStart", year(o_orderdate) AS "YearEnd"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def leaky(spark, folder):
    return table(spark, folder, "lineitem").join(
        table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    ).select(
        F.col("l_extendedprice").alias("price"), (F.col("l_extendedprice") * 1.02 + F.col("l_tax")).alias("price_code"),
        F.col("l_quantity").alias("quantity"), F.col("l_discount").alias("discount"), F.lit(7).alias("same"),
        F.year("l_shipdate").alias("YearStart"), F.year("o_orderdate").alias("YearEnd"),
    )


def _r(c: str) -> str:
    return f"covar_samp({c}, price) / nullif(stddev_samp({c}) * stddev_samp(price), 0)"


@query("correlation_leakage", f"WITH {LEAKY}\n" + union([
    f"""SELECT '{c}' AS feature, {rnd(_r(q))} AS correlation, coalesce(abs({_r(q)}) > 0.95, false) AS suspicious FROM leaky"""
    for c, q in [("price_code",) * 2, ("quantity",) * 2, ("discount",) * 2, ("same",) * 2, ("YearStart", '"YearStart"'), ("YearEnd", '"YearEnd"')]
]))
def _correlation_leakage(spark, folder):
    return rounded(split.correlation_leakage(leaky(spark, folder), "price"))


@query("leakage_report", f"""WITH {LEAKY}
SELECT 'target_in_features' AS warning, 'price' AS "column", CAST(NULL AS DOUBLE) AS value
UNION ALL SELECT 'identifier_name', 'price_code', NULL
UNION ALL SELECT 'end_after_start', 'YearEnd', count(*)::DOUBLE FROM leaky WHERE "YearEnd" > "YearStart"
UNION ALL SELECT 'correlation', 'price_code', {rnd(_r("price_code"))} FROM leaky""")
def _leakage_report(spark, folder):
    return rounded(split.leakage_report(leaky(spark, folder), "price"))


# --- around a model ---------------------------------------------------------------------------------
@query("complete_feature_vector", """
SELECT event_id, value, 0 AS "Demo_Male", user_id, 0 AS "Region_West", 2 AS missing_features FROM events""")
def _complete_feature_vector(spark, folder):
    return scoring.complete_feature_vector(
        table(spark, folder, "events"), ["value", "Demo_Male", "user_id", "Region_West"], keep=["event_id"]
    )


REQUEST = VIEW + f''', {CENTROIDS}, located AS (
  SELECT "ResponseID", "YearStart", "YearStart" - 2012 AS "YearsSince2020", "HighConfidenceLimit" - "LowConfidenceLimit" AS "ConfidenceIntervalWidth",
    coalesce({coordinate(fv.LATITUDE_PATTERN)}, centre_lat, 39.8283) AS "Latitude",
    coalesce({coordinate(fv.LONGITUDE_PATTERN)}, centre_lon, -98.5795) AS "Longitude",
    CASE WHEN "LocationID" % 5 <> 0 THEN "LocationID" % 3 END AS "Region_West"
  FROM ind LEFT JOIN centres ON "LocationAbbr" = state),
tested AS (SELECT *, concat_ws('; ',
  CASE WHEN "YearsSince2020" < 0 OR "YearsSince2020" > 10 THEN 'YearsSince2020 is out of range' END,
  CASE WHEN "ConfidenceIntervalWidth" < 0 THEN 'ConfidenceIntervalWidth is out of range' END,
  CASE WHEN "Latitude" < 20 OR "Latitude" > 50 THEN 'Latitude is out of range' END,
  CASE WHEN "Longitude" < -130 OR "Longitude" > -60 THEN 'Longitude is out of range' END,
  CASE WHEN "Region_West" IS NULL THEN 'Region_West is required' END,
  CASE WHEN "Region_West" NOT IN (0, 1) THEN 'Region_West must be 0 or 1' END) AS broken FROM located)
'''


@query("request_domain_filter", REQUEST + 'SELECT "ResponseID", broken AS violations, broken = \'\' AS accepted FROM tested')
def _request_domain_filter(spark, folder):
    view = stored_view(spark, folder)
    located = centroid_fill(geo_extract(view)).select(
        "ResponseID", "YearStart", (F.col("YearStart") - 2012).alias("YearsSince2020"),
        (F.col("HighConfidenceLimit") - F.col("LowConfidenceLimit")).alias("ConfidenceIntervalWidth"),
        "Latitude", "Longitude",
        F.when(F.col("LocationID") % 5 != 0, F.col("LocationID") % 3).alias("Region_West"),
    )
    accepted, rejected = scoring.request_domain_filter(located, required_flags=["Region_West"], optional_flags=[])
    return accepted.select("ResponseID", F.lit("").alias("violations"), F.lit(True).alias("accepted")).unionByName(
        rejected.select("ResponseID", F.concat_ws("; ", "violations").alias("violations"), F.lit(False).alias("accepted"))
    )


@query("score_anomaly_flag", "SELECT c_custkey, c_acctbal AS prediction, c_acctbal < 0 OR c_acctbal > 1000 AS anomaly FROM customer")
def _score_anomaly_flag(spark, folder):
    return scoring.score_anomaly_flag(table(spark, folder, "customer").select("c_custkey", F.col("c_acctbal").alias("prediction")))


@query("round_prediction", f"""SELECT l_orderkey, {rnd("p")} AS prediction, {rnd("p", 2)} AS prediction_rounded, {rnd("p * 0.3")} AS ci_width
FROM (SELECT l_orderkey, l_extendedprice * (1 - l_discount) * 0.123456789::DOUBLE AS p FROM lineitem)""")
def _round_prediction(spark, folder):
    p = F.col("l_extendedprice") * (1 - F.col("l_discount")) * 0.123456789
    scored = table(spark, folder, "lineitem").select(
        "l_orderkey", p.alias("prediction"), (p * 0.9).alias("confidence_lower"), (p * 1.2).alias("confidence_upper"))
    return rounded(scoring.round_prediction(scored).drop("confidence_lower", "confidence_upper"))


@query("regression_metrics", f"""WITH scored AS (SELECT l_extendedprice AS y, l_quantity * 1500 AS p FROM lineitem),
m AS (SELECT count(*) AS n_rows, avg(abs(p - y)) AS mae, avg((p - y) * (p - y)) AS mse,
  1 - sum((p - y) * (p - y)) / sum((y - (SELECT avg(y) FROM scored)) * (y - (SELECT avg(y) FROM scored))) AS r2,
  avg(abs(p - y) / greatest(abs(y), 2.220446049250313e-16)) * 100 AS mape_pct, min(p) AS prediction_min, max(p) AS prediction_max,
  min(y) AS target_min, max(y) AS target_max,
  100.0::DOUBLE * count(*) FILTER (p BETWEEN (SELECT min(y) FROM scored) AND (SELECT max(y) FROM scored)) / count(*) AS within_pct FROM scored)
SELECT n_rows, {rnd("mae", 3)} AS mae, {rnd("mse", 3)} AS mse, {rnd("sqrt(mse)", 3)} AS rmse, {rnd("r2", 3)} AS r2,
  {rnd("mape_pct", 3)} AS mape_pct, {rnd("prediction_min", 3)} AS prediction_min, {rnd("prediction_max", 3)} AS prediction_max,
  {rnd("target_min", 3)} AS target_min, {rnd("target_max", 3)} AS target_max, {rnd("within_pct", 3)} AS within_pct,
  r2 > 0.99 AS leakage_warning, within_pct < 90 AS range_warning, sqrt(mse) / 20000 NOT BETWEEN 0.8 AND 1.2 AS cv_warning FROM m""")
def _regression_metrics(spark, folder):
    scored = table(spark, folder, "lineitem").select(
        F.col("l_extendedprice").alias("label"), (F.col("l_quantity") * 1500).alias("prediction"))
    return rounded(scoring.regression_metrics(scored, cv_rmse=20000.0), 3)


@query("batch_size_stats", f"""SELECT count(*) AS n_predictions, {rnd("sum(value)", 4)} AS processing_time_ms,
  CAST(sum(user_id % 3) AS BIGINT) AS missing_features FROM events""")
def _batch_size_stats(spark, folder):
    scored = table(spark, folder, "events").select(
        F.col("value").alias("processing_time_ms"), (F.col("user_id") % 3).alias("missing_features"))
    return rounded(scoring.batch_size_stats(scored), 4)


@query("append_predictions", """SELECT ts AS timestamp, value AS prediction, value * 0.5::DOUBLE AS confidence_lower,
  value * 1.5::DOUBLE AS confidence_upper, CAST(NULL AS DOUBLE) AS processing_time_ms, 3 AS features_used,
  CAST(user_id % 3 AS INTEGER) AS missing_features FROM events""")
def _append_predictions(spark, folder):
    scored = table(spark, folder, "events").select(
        jobs.utc_time(F.col("ts")).alias("timestamp"), "event_type", F.col("value").alias("prediction"),
        (F.col("value") * 0.5).alias("confidence_lower"), (F.col("value") * 1.5).alias("confidence_upper"),
        (F.col("user_id") % 3).alias("missing_features"),
    )
    path = new_path(spark, "predictions")
    for batch in (scored.where("event_type = 'view'"), scored.where("event_type <> 'view'")):
        logs.append_predictions(logs.prediction_records(batch, features_used=3), path)
    back = logs.read_predictions(spark, path)
    naive = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col("timestamp").cast("timestamp_ntz"))
    return back.withColumn("timestamp", naive)


# --- reference statistics and drift -----------------------------------------------------------------
@query("save_reference_stats", f"""SELECT s.*, 'training_data' AS source, (SELECT count(*) FROM orders) AS n_samples
FROM ({stats_sql(["o_orderkey", "o_custkey", "o_totalprice"], "orders")}) AS s""")
def _save_reference_stats(spark, folder):
    stats = reference_stats.save_reference_stats(table(spark, folder, "orders"), new_path(spark, "reference"))
    return rounded(stats.drop("created_at"), 4)


@query("load_reference_stats", VIEW + f''', {CENTROIDS}, located AS (SELECT "YearStart",
  coalesce({coordinate(fv.LATITUDE_PATTERN)}, centre_lat, 39.8283) AS "Latitude",
  coalesce({coordinate(fv.LONGITUDE_PATTERN)}, centre_lon, -98.5795) AS "Longitude" FROM ind LEFT JOIN centres ON "LocationAbbr" = state)
''' + union([
    f'''SELECT '{c}' AS feature, {num(m)} AS ref_mean, {num(s)} AS ref_std, {rnd(f'avg("{c}")')} AS current_mean,
  {rnd(f'stddev_samp("{c}")')} AS current_std, count("{c}") AS n_samples, 'default' AS source FROM located'''
    for c, (m, s) in fv.DEFAULT_REFERENCE_STATS.items()
]))
def _load_reference_stats(spark, folder):
    """No statistics were saved at the path, so the defaults are compared with the view."""
    stats = reference_stats.load_reference_stats(spark, new_path(spark, "no-reference"))
    located = centroid_fill(geo_extract(stored_view(spark, folder).select("YearStart", "LocationAbbr", "GeoLocation")))
    now = drift.current_moments(located, ["YearStart", "Latitude", "Longitude"])
    joined = drift.reference_stats_join(now, stats).join(stats.select("feature", "source"), "feature")
    return rounded(joined.drop("known"))


DRIFT_COLUMNS = ["value", "user_id", "event_id"]
FIRST, SECOND = "ts < TIMESTAMP '2024-01-16'", "ts >= TIMESTAMP '2024-01-16'"
DRIFT = f"""WITH old AS (SELECT * FROM events WHERE {FIRST}), new AS (SELECT *, user_id * 2 AS late FROM events WHERE {SECOND}),
ref AS ({union([f"SELECT '{c}' AS feature, avg({c}) AS ref_mean, stddev_samp({c}) AS ref_std FROM old" for c in DRIFT_COLUMNS])}),
cur AS ({union([f"SELECT '{c}' AS feature, avg({c}) AS current_mean, stddev_samp({c}) AS current_std, count({c}) AS n_samples FROM new"
                for c in [*DRIFT_COLUMNS, "late"]])}),
joined AS (SELECT cur.*, ref_mean, ref_std, ref.feature IS NOT NULL AS known,
  CASE WHEN ref.feature IS NOT NULL THEN CASE WHEN ref_std > 0 THEN abs(current_mean - ref_mean) / ref_std ELSE 0 END END AS deviation
  FROM cur LEFT JOIN ref USING (feature)),
report AS (SELECT *, CASE WHEN NOT known THEN 'unknown' WHEN deviation > 1.5 THEN 'drift_detected' ELSE 'stable' END AS status FROM joined),
told AS (SELECT *, CASE WHEN status = 'drift_detected' THEN printf('Mean shifted from %.2f to %.2f (%.2f std deviations)', ref_mean, current_mean, deviation)
  WHEN status = 'unknown' THEN printf('Feature ''%s'' not in reference stats', feature) END AS message FROM report)
"""


def halves(spark, folder):
    events = table(spark, folder, "events")
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    old = events.where(F.col("ts") < cut)
    new = events.where(F.col("ts") >= cut).withColumn("late", F.col("user_id") * 2)
    return old, new


def events_drift(spark, folder):
    old, new = halves(spark, folder)
    reference = feature_stats(old, DRIFT_COLUMNS)
    return drift.drift_report(new, reference, [*DRIFT_COLUMNS, "late"], threshold=1.5)


DRIFT_COLS = f"""feature, status, {rnd("ref_mean", 4)} AS ref_mean, {rnd("current_mean", 4)} AS current_mean, {rnd("ref_std", 4)} AS ref_std,
  {rnd("current_std", 4)} AS current_std, {rnd("deviation", 4)} AS deviation, n_samples, message"""


@query("reference_stats_join", DRIFT + f"""SELECT feature, {rnd("current_mean", 4)} AS current_mean, {rnd("current_std", 4)} AS current_std,
  n_samples, {rnd("ref_mean", 4)} AS ref_mean, {rnd("ref_std", 4)} AS ref_std, known FROM told""")
def _reference_stats_join(spark, folder):
    old, new = halves(spark, folder)
    now = drift.current_moments(new, [*DRIFT_COLUMNS, "late"])
    return rounded(drift.reference_stats_join(now, feature_stats(old, DRIFT_COLUMNS)), 4)


@query("drift_report", DRIFT + f"SELECT {DRIFT_COLS} FROM told")
def _drift_report(spark, folder):
    return rounded(events_drift(spark, folder), 4)


@query("drift_summary", DRIFT + """SELECT count(*) AS total_features, count(*) FILTER (status = 'drift_detected') AS features_with_drift,
  count(*) FILTER (status = 'unknown') AS features_missing, count(*) FILTER (status = 'stable') AS features_stable,
  count(*) FILTER (status = 'drift_detected') > 0 AS drift_detected FROM told""")
def _drift_summary(spark, folder):
    return drift.drift_summary(events_drift(spark, folder))


@query("drift_detector_state", """SELECT 'stats' AS reference_stats_path, 2.0::DOUBLE AS threshold, 3::BIGINT AS features_monitored,
  'training_data' AS reference_source, count(*) AS n_samples FROM events""")
def _drift_detector_state(spark, folder):
    path = new_path(spark, "reference")
    stats = reference_stats.save_reference_stats(table(spark, folder, "events"), path)
    state = drift.drift_detector_state(stats, "stats").drop("reference_created_at")
    return state.withColumn("n_samples", F.lit(stats.first()["n_samples"]).cast("bigint"))


# --- alerts -----------------------------------------------------------------------------------------
def stamp():
    return F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")


STAMP_SQL = "TIMESTAMP '2024-02-01 00:00:00' AS timestamp"


def shown(df):
    """Alert rows without the JSON payload, whose number format differs between engines."""
    return df.drop("data")


@query("drift_alerts", DRIFT + f"""SELECT 'warning' AS severity, 'Data Drift Detected: ' || feature AS title, message, {STAMP_SQL},
  'drift_detector' AS source, {rnd("ref_mean", 4)} AS ref_mean, {rnd("current_mean", 4)} AS current_mean, {rnd("deviation", 4)} AS deviation
  FROM told WHERE status = 'drift_detected'""")
def _drift_alerts(spark, folder):
    found = alerts.drift_alerts(events_drift(spark, folder), timestamp=stamp())
    return with_payload(found, ["ref_mean", "current_mean", "deviation"])


def daily(spark, folder):
    """Error share per day and the mean value per day as a metric history."""
    return table(spark, folder, "events").groupBy(F.to_date("ts").alias("day")).agg(
        (F.avg((F.col("event_type") == "error").cast("double")) * 100).alias("error_rate"), F.avg("value").alias("mean_value"),
        F.count("*").alias("n_rows"),
    )


DAILY = """daily AS (SELECT CAST(ts AS DATE) AS day, avg(CASE WHEN event_type = 'error' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100 AS error_rate,
  avg(value) AS mean_value, count(*) AS n_rows FROM events GROUP BY 1)"""
DROPS = f"""{DAILY}, history AS (SELECT 'mean_value' AS metric, day AS version, mean_value AS value FROM daily
  UNION ALL SELECT 'n_rows', day, n_rows::DOUBLE FROM daily),
lagged AS (SELECT *, lag(value) OVER (PARTITION BY metric ORDER BY version) AS old FROM history)"""
DROP_SQL = f"""SELECT 'error' AS severity, 'Model Performance Drop: ' || metric AS title,
  printf('%s dropped from %.4f to %.4f', metric, old, value) AS message, {STAMP_SQL}, 'model_performance' AS source FROM lagged WHERE value < old"""
RATE_SQL = f"""SELECT 'error' AS severity, 'High Error Rate Detected' AS title,
  printf('Error rate %.2f%% exceeds threshold 20.00%%', error_rate) AS message, {STAMP_SQL}, 'monitoring' AS source FROM daily WHERE error_rate > 20"""
RETRAIN_SQL = f"""SELECT 'info' AS severity, 'Model Retrained: ' || CAST(day AS VARCHAR) AS title,
  'Model retrained successfully with R²: ' || CASE WHEN mean_value > 50 THEN printf('%.4f', mean_value / 100) ELSE 'N/A' END AS message,
  {STAMP_SQL}, 'retraining' AS source FROM daily"""
ANOMALY_SQL = f"""SELECT 'warning' AS severity, 'Anomalous Prediction Detected' AS title,
  printf('Prediction %.2f outside expected range [1.00, 200.00]', value) AS message, {STAMP_SQL}, 'anomaly_detection' AS source
FROM events WHERE value < 1 OR value > 200"""


def history(spark, folder):
    days = daily(spark, folder)
    return days.select(F.inline(F.array(
        F.struct(F.lit("mean_value").alias("metric"), F.col("day").alias("version"), F.col("mean_value").alias("value")),
        F.struct(F.lit("n_rows").alias("metric"), F.col("day").alias("version"), F.col("n_rows").cast("double").alias("value")),
    )))


def with_payload(df, fields):
    """Numbers of the JSON payload as columns of their own, rounded."""
    values = F.from_json("data", ", ".join(f"{f} double" for f in fields))
    return shown(df.withColumns({f: F.round(values.getField(f), 4) for f in fields}))


DROP_FIELDS = ["old_value", "new_value", "drop_percent"]


@query("performance_drop_alerts", f"""WITH {DROPS} {DROP_SQL.replace(" FROM lagged", f""",
  {rnd("old", 4)} AS old_value, {rnd("value", 4)} AS new_value, {rnd("(old - value) * 100 / old", 4)} AS drop_percent FROM lagged""")}""")
def _performance_drop_alerts(spark, folder):
    return with_payload(alerts.performance_drop_alerts(history(spark, folder), timestamp=stamp()), DROP_FIELDS)


def anomalies(spark, folder):
    scored = table(spark, folder, "events").select(F.col("value").alias("prediction"))
    return alerts.anomaly_alerts(scored, 1.0, 200.0, timestamp=stamp())


@query("anomaly_alerts", ANOMALY_SQL)
def _anomaly_alerts(spark, folder):
    return shown(anomalies(spark, folder))


@query("error_rate_alerts", f"WITH {DAILY} {RATE_SQL}")
def _error_rate_alerts(spark, folder):
    return shown(alerts.error_rate_alerts(daily(spark, folder), 20.0, timestamp=stamp()))


def retrained(spark, folder):
    models = daily(spark, folder).select(
        F.col("day").cast("string").alias("version"),
        F.when(F.col("mean_value") > 50, F.col("mean_value") / 100).alias("r2"))
    return alerts.retrain_alerts(models, timestamp=stamp())


@query("retrain_alerts", f"WITH {DAILY} {RETRAIN_SQL}")
def _retrain_alerts(spark, folder):
    return shown(retrained(spark, folder))


def all_alerts(spark, folder):
    critical = alerts.critical(
        daily(spark, folder).where("error_rate > 25"), F.lit("Model Service Unavailable"),
        F.format_string("%d rows on %s", "n_rows", F.col("day").cast("string")), source="monitoring", timestamp=stamp(),
    )
    return (
        alerts.performance_drop_alerts(history(spark, folder), timestamp=stamp())
        .unionByName(anomalies(spark, folder)).unionByName(retrained(spark, folder)).unionByName(critical)
        .unionByName(alerts.error_rate_alerts(daily(spark, folder), 20.0, timestamp=stamp()))
    )


CRITICAL_SQL = f"""SELECT 'critical' AS severity, 'Model Service Unavailable' AS title,
  printf('%d rows on %s', n_rows, CAST(day AS VARCHAR)) AS message, {STAMP_SQL}, 'monitoring' AS source FROM daily WHERE error_rate > 25"""
ALL_SQL = f"WITH {DROPS}, alerts AS (" + union([DROP_SQL, ANOMALY_SQL, RETRAIN_SQL, CRITICAL_SQL, RATE_SQL]) + ")\n"


@query("alert_rows", ALL_SQL + "SELECT * FROM alerts")
def _alert_rows(spark, folder):
    return shown(all_alerts(spark, folder))


@query("severity_filter", ALL_SQL + "SELECT * FROM alerts WHERE severity IN ('error', 'critical')")
def _severity_filter(spark, folder):
    return shown(alerts.severity_filter(all_alerts(spark, folder), "error"))


@query("append_alerts", ALL_SQL + "SELECT * FROM alerts WHERE severity <> 'info'")
def _append_alerts(spark, folder):
    path = new_path(spark, "alerts")
    logs.append_alerts(alerts.severity_filter(all_alerts(spark, folder)), path)
    back = logs.read_alerts(spark, path)
    naive = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col("timestamp").cast("timestamp_ntz"))
    return shown(back.withColumn("timestamp", naive))


@query("monitoring_summary", ALL_SQL + f"""SELECT (SELECT count(*) FROM events) AS n_predictions, count(*) AS n_alerts,
  count(*) FILTER (severity = 'error') AS n_errors, count(*) FILTER (severity = 'critical') AS n_critical,
  (SELECT {rnd("avg(value)", 4)} FROM events) AS mean_prediction, (SELECT CAST(sum(user_id % 3) AS BIGINT) FROM events) AS missing_features
FROM alerts WHERE severity <> 'info'""")
def _monitoring_summary(spark, folder):
    """What the stored logs of predictions and alerts say together."""
    predictions, told = new_path(spark, "predictions"), new_path(spark, "alerts")
    scored = table(spark, folder, "events").select(
        jobs.utc_time(F.col("ts")).alias("timestamp"), F.col("value").alias("prediction"), (F.col("user_id") % 3).alias("missing_features"),
    )
    logs.append_predictions(logs.prediction_records(scored, features_used=3), predictions)
    logs.append_alerts(alerts.severity_filter(all_alerts(spark, folder)), told)
    return rounded(logs.log_summary(logs.read_predictions(spark, predictions), logs.read_alerts(spark, told)), 4)


@query("last_n", """SELECT event_id, ts, event_type, value FROM events WHERE event_type = 'error' ORDER BY ts DESC, event_id DESC LIMIT 10""")
def _last_n(spark, folder):
    events = table(spark, folder, "events").select("event_id", "ts", "event_type", "value")
    return ranking.last_n(events, [F.desc("ts"), F.desc("event_id")], 10, F.col("event_type") == "error")


@query("alert_history", f"""WITH a AS (SELECT 'warning' AS severity, 'Anomalous Prediction Detected' AS title,
  printf('Prediction %.2f outside expected range [1.00, 200.00]', value) AS message, ts AS timestamp, 'anomaly_detection' AS source
  FROM events WHERE value < 1 OR value > 200) SELECT * FROM a ORDER BY timestamp DESC, title, message LIMIT 10""")
def _alert_history(spark, folder):
    scored = table(spark, folder, "events").select(F.col("value").alias("prediction"), "ts")
    found = alerts.anomaly_alerts(scored, 1.0, 200.0, timestamp=F.col("ts"))
    return shown(alerts.alert_history(found, 10, "warning"))


# --- streams ----------------------------------------------------------------------------------------
def event_stream(spark, folder):
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    return jobs.read_stream(spark, folder, schema, pattern="events.parquet")


# A window is out once the watermark, the latest time minus one hour, has passed its end.
CLOSED = """windows AS (SELECT *, date_trunc('day', ts) AS day FROM events),
closed AS (SELECT * FROM windows WHERE day + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events))"""
STREAM_DRIFT = f"""WITH {CLOSED}, ref AS (SELECT avg(value) AS ref_mean, stddev_samp(value) AS ref_std FROM events),
cur AS (SELECT day, avg(value) AS current_mean, stddev_samp(value) AS current_std, count(value) AS n_samples FROM closed GROUP BY 1),
told AS (SELECT strftime(day, '%Y-%m-%d %H:%M:%S') AS window_start, 'value' AS feature, *, abs(current_mean - ref_mean) / ref_std AS deviation FROM cur, ref),
report AS (SELECT *, CASE WHEN deviation > 0.05 THEN 'drift_detected' ELSE 'stable' END AS status, CASE WHEN deviation > 0.05 THEN
  printf('Mean shifted from %.2f to %.2f (%.2f std deviations)', ref_mean, current_mean, deviation) END AS message FROM told)
"""


def stream_drift(spark, folder, **options):
    reference = feature_stats(table(spark, folder, "events"), ["value"])
    return jobs.drift_stream(event_stream(spark, folder), ["value"], reference, "1 day", "1 hour", threshold=0.05, **options)


@query("drift_stream", STREAM_DRIFT + f"SELECT window_start, {DRIFT_COLS} FROM report")
def _drift_stream(spark, folder):
    return rounded(jobs.run_available(stream_drift(spark, folder), label="drift"), 4)


@query("outlier_stream", f"""WITH {CLOSED}, q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events),
report AS (SELECT day, count(*) FILTER (value < a - 3 * (b - a) OR value > b + 3 * (b - a)) AS outlier_count, count(value) AS n_values,
  min(value) AS min_value, max(value) AS max_value FROM closed, q GROUP BY 1)
SELECT strftime(day, '%Y-%m-%d %H:%M:%S') AS window_start, 'value' AS feature, outlier_count, n_values, min_value, max_value
FROM report WHERE outlier_count > 0""")
def _outlier_stream(spark, folder):
    bounds = fences(table(spark, folder, "events"), ["value"])
    return jobs.run_available(jobs.outlier_stream(event_stream(spark, folder), bounds, "1 day", "1 hour"), label="outliers")


@query("alert_stream", STREAM_DRIFT + """, q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events),
most AS (SELECT day, max(value) AS top, any_value(a - 3 * (b - a)) AS low, any_value(b + 3 * (b - a)) AS high FROM closed, q GROUP BY day
  HAVING count(*) FILTER (value < a - 3 * (b - a) OR value > b + 3 * (b - a)) > 0)
SELECT 'warning' AS severity, 'Data Drift Detected: value' AS title, message, 'drift_detector' AS source, 'value' AS feature,
  window_start FROM report WHERE status = 'drift_detected'
UNION ALL SELECT 'warning', 'Anomalous Prediction Detected',
  printf('Prediction %.2f outside expected range [%.2f, %.2f]', top, low, high), 'anomaly_detection', 'value',
  strftime(day, '%Y-%m-%d %H:%M:%S') FROM most WHERE top > high OR top < low""")
def _alert_stream(spark, folder):
    """Two reports and two rules in one stream: drifting windows, and windows whose largest value is beyond the fences."""
    path = new_path(spark, "alert-stream")
    bounds = fences(table(spark, folder, "events"), ["value"])
    low, high = bounds["value"]
    beyond = jobs.outlier_stream(event_stream(spark, folder), bounds, "1 day", "1 hour", keep_time=True)
    found = jobs.unique_alerts([
        (stream_drift(spark, folder, keep_time=True), alerts.drift_alerts),
        (beyond, lambda rows, **options: alerts.anomaly_alerts(rows, low, high, prediction="max_value", **options)),
    ])
    jobs.alert_stream(found, lambda batch: batch, path).awaitTermination()
    schema = "severity string, title string, message string, source string, feature string, window_start string"
    return spark.read.schema(schema).option("recursiveFileLookup", True).json(path)


@query("prediction_volume", f"""WITH {CLOSED}
SELECT strftime(day, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n_predictions,
  CAST(sum(user_id % 3) AS BIGINT) AS missing_features FROM closed GROUP BY day, event_type""")
def _prediction_volume(spark, folder):
    rows = event_stream(spark, folder).withColumn("missing", F.col("user_id") % 3)
    return jobs.run_available(
        jobs.prediction_volume(rows, "1 day", "1 hour", by=["event_type"], missing="missing"), label="volume"
    )


# --- model metadata without a model -----------------------------------------------------------------
@query("model_metadata", f"""SELECT 'price_mean' AS model_name, '2.0' AS version, 'mean' AS model_type, 'l_quantity,l_tax' AS features,
  2 AS feature_count, 'l_extendedprice' AS target, {rnd("avg(l_extendedprice)", 4)} AS mean_price, count(*)::VARCHAR AS n_rows FROM lineitem""")
def _model_metadata(spark, folder):
    row = table(spark, folder, "lineitem").agg(F.avg("l_extendedprice").alias("m"), F.count("*").alias("n")).first()
    base = new_path(spark, "registry")
    publication = registry.new_publication(base, "price_mean", "2.0")
    registry.save_model_metadata(
        spark, publication, "price_mean", "2.0", "mean", ["l_quantity", "l_tax"], "l_extendedprice",
        {"mean_price": row["m"]}, {"n_rows": row["n"]},
    )
    registry.publish(spark, publication)
    meta = registry.load_model_metadata(spark, base, "price_mean", "2.0")
    return rounded(meta.select(
        "model_name", "version", "model_type", F.concat_ws(",", "features").alias("features"), "feature_count", "target",
        F.col("performance")["mean_price"].alias("mean_price"), F.col("parameters")["n_rows"].alias("n_rows"),
    ), 4)
