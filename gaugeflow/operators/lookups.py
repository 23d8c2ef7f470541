"""Lookups against the fixed geography, membership and overlap checks, unions and duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow import fixed_values as fv
from gaugeflow.functions.scalars import quoted


def region_table(spark: SparkSession) -> DataFrame:
    rows = [(state, region) for region, states in fv.REGIONS.items() for state in states]
    return spark.createDataFrame(rows, "state string, region string")


def centroid_table(spark: SparkSession) -> DataFrame:
    rows = [(state, lat, lon) for state, (lat, lon) in fv.CENTROIDS.items()]
    return spark.createDataFrame(rows, "state string, centre_lat double, centre_lon double")


def region_lookup(df: DataFrame, column: str = "LocationAbbr", output: str = "US_Region") -> DataFrame:
    """Census region of a state code; anything else is ``Unknown``. The table has a fixed 51 rows."""
    regions = F.broadcast(region_table(df.sparkSession))
    return (
        df.join(regions, quoted(column) == regions["state"], "left")
        .withColumn(output, F.coalesce("region", F.lit(fv.NO_REGION)))
        .drop("state", "region")
    )


def centroid_fill(
    df: DataFrame, column: str = "LocationAbbr", lat: str = "Latitude", lon: str = "Longitude"
) -> DataFrame:
    """Fill each missing coordinate from the state centre, else from the country centre."""
    if lat not in df.columns or lon not in df.columns:
        return df
    country_lat, country_lon = fv.COUNTRY_CENTROID
    if column not in df.columns:
        return df.withColumns({
            lat: F.coalesce(lat, F.lit(country_lat)), lon: F.coalesce(lon, F.lit(country_lon)),
        })
    centres = F.broadcast(centroid_table(df.sparkSession))
    return (
        df.join(centres, quoted(column) == centres["state"], "left")
        .withColumns({
            lat: F.coalesce(quoted(lat), "centre_lat", F.lit(country_lat)),
            lon: F.coalesce(quoted(lon), "centre_lon", F.lit(country_lon)),
        })
        .drop("state", "centre_lat", "centre_lon")
    )


def split_overlap(train: DataFrame, test: DataFrame, row_id: str) -> DataFrame:
    """Row ids that are in both parts, with their number of test rows."""
    return test.join(train.select(quoted(row_id)), row_id, "left_semi").groupBy(row_id).agg(F.count("*").alias("n_rows"))


def unexpected_members(df: DataFrame, column: str = "LocationAbbr", allowed: Sequence[str] = fv.STATES) -> DataFrame:
    """Distinct values outside the allowed set, with row counts. The set is a fixed list of literals."""
    return (
        df.where(quoted(column).isNotNull() & ~quoted(column).isin(*allowed))
        .groupBy(quoted(column).alias("member"))
        .agg(F.count("*").alias("n_rows"))
    )


def missing_columns(df: DataFrame, required: Sequence[str] = fv.REQUIRED_COLUMNS) -> list[str]:
    return [c for c in required if c not in df.columns]


def schema_diff(df: DataFrame, required: Sequence[str] = fv.REQUIRED_COLUMNS, on_fail: str = "report") -> DataFrame:
    """One row per required column: is it there, and how many values it holds."""
    absent = missing_columns(df, required)
    if absent and on_fail == "raise":
        raise ValueError(f"Missing required columns: {absent}")
    counts = df.agg(*[
        (F.count(quoted(c)) if c in df.columns else F.lit(None).cast("bigint")).alias(c) for c in required
    ])
    rows = F.array(*[
        F.struct(
            F.lit(c).alias("column"), F.lit(c in df.columns).alias("present"), quoted(c).alias("n_values")
        ) for c in required
    ])
    return counts.select(F.inline(rows))


def union_parts(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def dedupe_full_row(df: DataFrame) -> DataFrame:
    """Hash aggregation on all columns: copies are dropped before the shuffle, so hot copies cost nothing."""
    return df.dropDuplicates()


def row_digest(df: DataFrame, names: Sequence[str] = ("__d0", "__d1")) -> list[Column]:
    """128 bits that tell the rows of a table apart, as two numbers: as group keys they are short where whole rows are wide.

    Hashing passes over nulls, so their places are hashed, too. Zeros of either sign and all NaN are equal, as in a group.
    """
    values = [quoted(c) for c in df.columns]
    gaps = [F.concat(*[F.when(v.isNull(), "1").otherwise("0") for v in values])] if values else []
    return [F.xxhash64(F.lit(seed), *gaps, *values).alias(name) for seed, name in enumerate(names)]


def count_duplicates(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row."""
    digest = row_digest(df)
    per_row = df.select(*digest).groupBy("__d0", "__d1").agg(F.count("*").alias("copies"))
    return per_row.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("n_duplicates"),
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.where(quoted(column).isNotNull()).select(quoted(column).alias("member")).distinct()
