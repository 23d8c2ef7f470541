"""Inputs shared by the registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.catalog.twins import FEATURE_NUMBERS
from gaugeflow.functions.scalars import quoted
from gaugeflow.plans.clean import clean_data
from gaugeflow.plans.engineer import engineer_features
from gaugeflow.plans.indicator_view import indicator_view, table
from gaugeflow.storage import drop_unused_shuffles, materialise

_KEPT: dict[tuple[str, str, str], object] = {}


def kept(label: str, make: Callable[[SparkSession, str], object], spark: SparkSession, folder: str):
    """Build an intermediate once per application and input folder."""
    key = (label, spark.sparkContext.applicationId, folder)
    if key not in _KEPT:
        _KEPT[key] = make(spark, folder)
    return _KEPT[key]


def forget(keep: tuple[str, ...] = ()) -> None:
    """Drop kept intermediates, but those with the given labels."""
    for key in [k for k in _KEPT if k[0] not in keep]:
        del _KEPT[key]


def stored_view(spark: SparkSession, folder: str) -> DataFrame:
    """The indicator view written as a raw table."""
    def make(s: SparkSession, f: str) -> DataFrame:
        view = materialise(indicator_view(s, f), "view")
        drop_unused_shuffles(s)  # those of the joins
        return view
    return kept("view", make, spark, folder)


def stored_features(spark: SparkSession, folder: str) -> DataFrame:
    """The engineered features of the view written as a table."""
    return kept(
        "features",
        lambda s, f: materialise(engineer_features(clean_data(stored_view(s, f))), "features"), spark, folder,
    )


def row_form(features: DataFrame) -> DataFrame:
    """Engineered table with its one-hot columns folded into one text, so that it has fixed columns."""
    hot = [c for c in features.columns if c not in FEATURE_NUMBERS and c != "row_id"]
    active = F.concat_ws("|", *[F.when(quoted(c) == 1, F.lit(c)) for c in hot])
    return features.select(
        *[quoted(c) for c in FEATURE_NUMBERS if c in features.columns], active.alias("active_features")
    )


