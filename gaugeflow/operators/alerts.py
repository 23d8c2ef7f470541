"""Alert rows: one uniform record, the rules that make them, and the severity gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow import fixed_values as fv
from gaugeflow.operators.ranking import last_n


def severity_rank(severity: Column) -> Column:
    """Order of a severity; an unknown label counts as the lowest."""
    rank = F.lit(0)
    for name, value in fv.SEVERITIES.items():
        rank = F.when(severity == name, F.lit(value)).otherwise(rank)
    return rank


def severity_filter(alerts: DataFrame, minimum: str = "warning") -> DataFrame:
    return alerts.where(severity_rank(F.col("severity")) >= fv.SEVERITIES.get(minimum, 0))


def alert_rows(
    df: DataFrame,
    severity: str,
    title: Column,
    message: Column,
    source: str = "system",
    data: dict[str, Column] | None = None,
    timestamp: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One alert per row of ``df``; ``data`` becomes a JSON text. ``keep`` names columns to hand on."""
    payload = F.to_json(F.struct(*[c.alias(k) for k, c in data.items()])) if data else F.lit(None).cast("string")
    return df.select(
        F.lit(severity).alias("severity"), title.alias("title"), message.alias("message"),
        (timestamp if timestamp is not None else F.current_timestamp()).alias("timestamp"),
        F.lit(source).alias("source"), payload.alias("data"), *keep,
    )


def info(df: DataFrame, title: Column, message: Column, **options) -> DataFrame:
    return alert_rows(df, "info", title, message, **options)


def warning(df: DataFrame, title: Column, message: Column, **options) -> DataFrame:
    return alert_rows(df, "warning", title, message, **options)


def error(df: DataFrame, title: Column, message: Column, **options) -> DataFrame:
    return alert_rows(df, "error", title, message, **options)


def critical(df: DataFrame, title: Column, message: Column, **options) -> DataFrame:
    return alert_rows(df, "critical", title, message, **options)


def drift_alerts(report: DataFrame, **options) -> DataFrame:
    """A warning per drifting feature of a drift report."""
    return warning(
        report.where(F.col("status") == "drift_detected"),
        F.concat(F.lit("Data Drift Detected: "), F.col("feature")), F.col("message"), source="drift_detector",
        data={"ref_mean": F.col("ref_mean"), "current_mean": F.col("current_mean"), "deviation": F.col("deviation")},
        **options,
    )


def performance_drop_alerts(history: DataFrame, order: str = "version", **options) -> DataFrame:
    """An error for each metric that fell from one version to the next.

    The history holds ``metric, version, value`` rows: a few per trained version.
    """
    before = F.lag("value").over(Window.partitionBy("metric").orderBy(order))
    drops = history.withColumn("old", before).where(F.col("value") < F.col("old"))
    lost = F.try_divide((F.col("old") - F.col("value")) * 100, F.col("old"))
    return error(
        drops, F.concat(F.lit("Model Performance Drop: "), F.col("metric")),
        F.format_string("%s dropped from %.4f to %.4f", "metric", "old", "value"), source="model_performance",
        data={"metric": F.col("metric"), "old_value": F.col("old"), "new_value": F.col("value"), "drop_percent": lost},
        **options,
    )


def anomaly_alerts(scored: DataFrame, low: float, high: float, prediction: str = "prediction", **options) -> DataFrame:
    """A warning per prediction outside the expected range."""
    p = F.col(prediction)
    return warning(
        scored.where((p < low) | (p > high)), F.lit("Anomalous Prediction Detected"),
        F.format_string(f"Prediction %.2f outside expected range [{low:.2f}, {high:.2f}]", p),
        source="anomaly_detection",
        data={"prediction": p, "expected_low": F.lit(float(low)), "expected_high": F.lit(float(high))}, **options,
    )


def error_rate_alerts(rates: DataFrame, threshold: float, rate: str = "error_rate", **options) -> DataFrame:
    """An error per row whose error rate in percent exceeds the threshold."""
    r = F.col(rate)
    return error(
        rates.where(r > threshold), F.lit("High Error Rate Detected"),
        F.format_string(f"Error rate %.2f%% exceeds threshold {threshold:.2f}%%", r), source="monitoring",
        data={"error_rate": r, "threshold": F.lit(float(threshold))}, **options,
    )


def retrain_alerts(models: DataFrame, version: str = "version", r2: str = "r2", **options) -> DataFrame:
    """An info row per newly trained model with its R²."""
    shown = F.coalesce(F.format_string("%.4f", F.col(r2)), F.lit("N/A"))
    shown = F.when(F.col(r2).isNull(), F.lit("N/A")).otherwise(shown)
    return info(
        models, F.concat(F.lit("Model Retrained: "), F.col(version)),
        F.concat(F.lit("Model retrained successfully with R²: "), shown), source="retraining",
        data={"R2": F.col(r2)}, **options,
    )


def alert_history(alerts: DataFrame, limit: int = 10, severity: str | None = None) -> DataFrame:
    """The latest alerts, of one severity on request."""
    where = None if severity is None else F.col("severity") == severity
    return last_n(alerts, [F.desc("timestamp"), F.asc("title"), F.asc("message")], limit, where)
