"""Feature drift against reference statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow import fixed_values as fv
from gaugeflow.functions.scalars import as_number, numeric_columns, quoted
from gaugeflow.operators.profile import report_rows


def current_moments(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Mean, sample deviation and count per numeric column, in one pass."""
    cols = list(columns or numeric_columns(df))
    numbers = df.select(*[as_number(df, c).cast("double").alias(c) for c in cols])
    wide = numbers.agg(*[
        agg.alias(f"{name}{i}") for i, c in enumerate(cols)
        for name, agg in (("mean", F.avg(quoted(c))), ("std", F.stddev_samp(quoted(c))), ("n", F.count(quoted(c))))
    ])
    return report_rows(wide, [
        {
            "feature": F.lit(c), "current_mean": F.col(f"mean{i}"), "current_std": F.col(f"std{i}"),
            "n_samples": F.col(f"n{i}"),
        }
        for i, c in enumerate(cols)
    ])


def reference_stats_join(current: DataFrame, reference: DataFrame) -> DataFrame:
    """Reference mean and deviation beside each current feature. One row per monitored column on both sides."""
    side = reference.select("feature", F.col("mean").alias("ref_mean"), F.col("std").alias("ref_std"),
                            F.lit(True).alias("known"))
    return current.join(side, "feature", "left").withColumn(  # Spark broadcasts the reference if it is small
        "known", F.coalesce("known", F.lit(False))
    )


def judged(joined: DataFrame, threshold: float = fv.DRIFT_THRESHOLD) -> DataFrame:
    """Deviation in reference deviations, and the status drawn from it."""
    deviation = F.when(
        F.col("ref_std") > 0, F.abs(F.col("current_mean") - F.col("ref_mean")) / F.col("ref_std")
    ).otherwise(F.lit(0.0))
    status = (
        F.when(~F.col("known"), F.lit("unknown")).when(deviation > threshold, F.lit("drift_detected"))
        .otherwise(F.lit("stable"))
    )
    return joined.withColumns({
        "deviation": F.when(F.col("known"), deviation), "status": status,
    }).withColumn("message", _message())


def _message() -> Column:
    return F.when(
        F.col("status") == "drift_detected",
        F.format_string("Mean shifted from %.2f to %.2f (%.2f std deviations)", "ref_mean", "current_mean", "deviation"),
    ).when(F.col("status") == "unknown", F.format_string("Feature '%s' not in reference stats", "feature"))


def drift_report(
    df: DataFrame, reference: DataFrame, columns: Sequence[str] | None = None, threshold: float = fv.DRIFT_THRESHOLD
) -> DataFrame:
    """One row per numeric feature; the reference holds ``feature, mean, std`` rows."""
    return judged(reference_stats_join(current_moments(df, columns), reference), threshold).select(
        "feature", "status", "ref_mean", "current_mean", "ref_std", "current_std", "deviation", "n_samples", "message"
    )


def drift_summary(report: DataFrame) -> DataFrame:
    def count(status: str) -> Column:
        return F.count_if(F.col("status") == status)

    return report.agg(
        F.count("*").alias("total_features"),
        count("drift_detected").alias("features_with_drift"),
        count("unknown").alias("features_missing"),
        count("stable").alias("features_stable"),
        (count("drift_detected") > 0).alias("drift_detected"),
    )


def drift_detector_state(reference: DataFrame, path: str, threshold: float = fv.DRIFT_THRESHOLD) -> DataFrame:
    """What is monitored and where the reference comes from."""
    return reference.agg(
        F.count("*").alias("features_monitored"),
        F.coalesce(F.max("created_at").cast("string"), F.lit("unknown")).alias("reference_created_at"),
        F.coalesce(F.max("source"), F.lit("unknown")).alias("reference_source"),
    ).select(F.lit(path).alias("reference_stats_path"), F.lit(threshold).alias("threshold"), "*")
