"""Append-only logs of predictions and alerts, one JSON object per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PREDICTION_LOG = (
    "timestamp timestamp, prediction double, confidence_lower double, confidence_upper double,"
    " processing_time_ms double, features_used int, missing_features int"
)
# The default format would cut times to milliseconds.
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
ALERT_LOG = "severity string, title string, message string, timestamp timestamp, source string, data string"


def prediction_records(scored: DataFrame, features_used: int) -> DataFrame:
    """Scored rows in the shape of the log; absent columns are null."""
    have = set(scored.columns)

    def pick(name: str, kind: str):
        return (F.col(name) if name in have else F.lit(None)).cast(kind).alias(name)

    return scored.select(
        (F.col("timestamp") if "timestamp" in have else F.current_timestamp()).alias("timestamp"),
        *[pick(c, "double") for c in ("prediction", "confidence_lower", "confidence_upper", "processing_time_ms")],
        F.lit(features_used).alias("features_used"), pick("missing_features", "int"),
    )


def append_predictions(records: DataFrame, path: str) -> None:
    records.write.mode("append").option("timestampFormat", TIME_FORMAT).json(path)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PREDICTION_LOG).option("timestampFormat", TIME_FORMAT).json(path)


def append_alerts(alerts: DataFrame, path: str) -> None:
    """Times without a zone are written as UTC; without that they could not be read back."""
    if dict(alerts.dtypes).get("timestamp") == "timestamp_ntz":
        instant = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("timestamp")).cast("timestamp")
        alerts = alerts.withColumn("timestamp", instant)
    alerts.write.mode("append").option("timestampFormat", TIME_FORMAT).json(path)


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ALERT_LOG).option("timestampFormat", TIME_FORMAT).json(path)


def log_summary(predictions: DataFrame, alerts: DataFrame) -> DataFrame:
    """One row about the stored logs: predictions, their mean and missing features, and alerts by severity."""
    scored = predictions.agg(
        F.count("*").alias("n_predictions"), F.avg("prediction").alias("mean_prediction"),
        F.sum(F.col("missing_features").cast("long")).alias("missing_features"),
    )
    told = alerts.agg(
        F.count("*").alias("n_alerts"), F.count_if(F.col("severity") == "error").alias("n_errors"),
        F.count_if(F.col("severity") == "critical").alias("n_critical"),
    ).first()  # three numbers
    return scored.withColumns({k: F.lit(n).cast("long") for k, n in told.asDict().items()})
