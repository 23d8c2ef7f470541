"""The feature plan: from a cleaned table to a wide numeric one, with the category lists fitted once."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow import fixed_values as fv
from gaugeflow.functions.scalars import flag, quoted
from gaugeflow.operators import columns as col_ops
from gaugeflow.operators.encode import MAX_CATEGORIES, OTHER, column_names, frequent_values
from gaugeflow.operators.impute import group_median_impute
from gaugeflow.operators.lookups import centroid_fill, region_lookup

REGION = "US_Region"
ENCODED = {REGION: "Region", "Stratification1": "Demo", "Topic": "Topic", "Question": "Question"}


@dataclass(frozen=True)
class CategoryLists:
    """Categories per encoded column, in output order, and the frequent questions if they are bucketed."""

    values: Mapping[str, list[str]] = field(default_factory=dict)
    frequent: list[str] | None = None


def fit_categories(df: DataFrame, k: int = fv.TOP_CATEGORIES, limit: int = MAX_CATEGORIES) -> CategoryLists:
    """One job for the plain columns and one for the frequent questions; list lengths are checked."""
    present = [c for c in ENCODED if c in df.columns]
    frequent = frequent_values(df, "Question", k) if "Question" in present else None
    listed = [c for c in present if c != "Question" or frequent is None]
    values: dict[str, list[str]] = {c: [] for c in present}
    if listed:
        long = df.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), quoted(c).cast("string").alias("value")) for c in listed
        ]))).where(F.col("value").isNotNull()).distinct()
        rows = long.take(limit + 1)
        if len(rows) > limit:
            raise ValueError(f"more than {limit} categories in {listed}; bucket them before encoding")
        for r in rows:
            values[r["column"]].append(r["value"])
    if frequent is not None:
        other = df.where(~F.coalesce(quoted("Question").isin(*frequent), F.lit(False)))
        values["Question"] = [*frequent, *([] if other.isEmpty() else [OTHER])]
    return CategoryLists({c: sorted(set(v)) for c, v in values.items()}, frequent)


def encode(df: DataFrame, lists: CategoryLists) -> DataFrame:
    """All one-hot columns in one projection; categories that were not fitted are 0 everywhere."""
    kept = [quoted(c) for c in df.columns if c not in lists.values]
    dummies = []
    for c, members in lists.values.items():
        source = quoted(c)
        if c == "Question" and lists.frequent is not None:
            source = F.when(source.isin(*lists.frequent), source).otherwise(F.lit(OTHER))
        names = column_names(ENCODED[c], members)
        dummies += [flag(source == F.lit(m)).alias(n) for m, n in zip(members, names)]
    return df.select(*kept, *dummies)


def add_features(df: DataFrame, mode: str = "exact") -> DataFrame:
    """Everything before the encoding: flag, imputation, width, coordinates and region."""
    if fv.VALUE in df.columns:
        df = col_ops.missing_flag(col_ops.coerce_numeric(df, [fv.VALUE]))
        df = group_median_impute(df, mode=mode)
    df = col_ops.ci_width(col_ops.drop_columns(df, fv.IDENTIFIER_COLUMNS))
    if "GeoLocation" in df.columns:
        df = centroid_fill(col_ops.geo_extract(df)).drop("GeoLocation")
        if "LocationAbbr" in df.columns:
            df = region_lookup(df, output=REGION)
    if "Stratification1" in df.columns:
        df = df.withColumn("Stratification1", F.coalesce("Stratification1", F.lit("Unknown")))
    return df


def engineer_features(df: DataFrame, lists: CategoryLists | None = None, mode: str = "exact") -> DataFrame:
    """Numeric feature table. Pass the lists of the training run to encode a later batch alike."""
    df = add_features(df, mode)
    df = encode(df, lists or fit_categories(df))
    df = col_ops.years_since(df)
    return col_ops.drop_non_numeric(col_ops.drop_columns(df, fv.DESCRIPTIVE_COLUMNS))
