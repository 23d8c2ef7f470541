"""Reference statistics kept as JSON, one row per feature."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow import fixed_values as fv
from gaugeflow.functions.scalars import numeric_columns
from gaugeflow.operators.profile import feature_stats

STATS_SCHEMA = (
    "feature string, mean double, std double, min double, max double, q25 double, q50 double, q75 double,"
    " n bigint, created_at timestamp, source string, n_samples bigint"
)


def save_reference_stats(
    df: DataFrame, path: str, columns: Sequence[str] | None = None, source: str = "training_data", mode: str = "exact"
) -> DataFrame:
    """Write mean, deviation, range and quartiles per numeric column; gives back what was written."""
    stats = feature_stats(df, list(columns or numeric_columns(df)), mode=mode)
    stamped = stats.withColumns({
        "created_at": F.current_timestamp(), "source": F.lit(source), "n_samples": F.lit(df.count()),
    })
    stamped.write.mode("overwrite").json(path)
    return df.sparkSession.read.schema(STATS_SCHEMA).json(path)


def default_reference_stats(spark: SparkSession) -> DataFrame:
    rows = [(name, mean, std) for name, (mean, std) in fv.DEFAULT_REFERENCE_STATS.items()]
    return spark.createDataFrame(rows, "feature string, mean double, std double").select(
        "feature", "mean", "std", *[F.lit(None).cast("double").alias(c) for c in ("min", "max", "q25", "q50", "q75")],
        F.lit(None).cast("bigint").alias("n"), F.current_timestamp().alias("created_at"),
        F.lit("default").alias("source"), F.lit(None).cast("bigint").alias("n_samples"),
    )


def load_reference_stats(spark: SparkSession, path: str) -> DataFrame:
    """Saved statistics, or the defaults when there are none or they cannot be read."""
    try:
        stats = spark.read.schema(STATS_SCHEMA).json(path)
        usable = not stats.where(F.col("feature").isNotNull() & F.col("mean").isNotNull()).isEmpty()
    except AnalysisException:
        usable = False
    return stats if usable else default_reference_stats(spark)
