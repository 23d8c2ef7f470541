"""Raw table to model-ready table in one call."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gaugeflow import fixed_values as fv
from gaugeflow.operators.checks import raw_validation_suite
from gaugeflow.operators.columns import ensure_all_numeric
from gaugeflow.plans.clean import clean_data
from gaugeflow.plans.engineer import CategoryLists, engineer_features
from gaugeflow.sources.files import write_features_csv


def prepare(
    raw: DataFrame, validate: bool = True, lists: CategoryLists | None = None, csv_path: str | None = None,
    mode: str = "exact", report_path: str | None = None,
) -> DataFrame:
    """Validate, clean, engineer, force numeric, and write CSV on request.

    ``report_path`` receives the validation report, warnings included, as a table.
    """
    if validate:
        report = raw_validation_suite(raw, on_fail="raise")
        if report_path:
            report.write.mode("overwrite").parquet(report_path)
    features = ensure_all_numeric(engineer_features(clean_data(raw, mode), lists, mode))
    if fv.VALUE not in features.columns:
        raise ValueError(f"'{fv.VALUE}' is missing after feature engineering")
    if csv_path:
        write_features_csv(features, csv_path)
    return features
