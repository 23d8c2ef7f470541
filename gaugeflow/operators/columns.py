"""Row-local column operators: renaming, text and number clean-up, flags, simple derived columns.

Each one builds a single projection from the columns that are present and skips those that are not.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow import fixed_values as fv
from gaugeflow.functions.scalars import (
    as_number, clipped, coordinate, flag, normalised_text, quoted, text_columns, to_number,
)

TIME_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)

def replace_columns(df: DataFrame, changed: Mapping[str, Column]) -> DataFrame:
    """Replace or add columns in one projection, keeping the column order."""
    kept = [changed[c].alias(c) if c in changed else quoted(c) for c in df.columns]
    added = [expr.alias(c) for c, expr in changed.items() if c not in df.columns]
    return df.select(*kept, *added)


def strip_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def normalise_strings(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    chosen = text_columns(df) if columns is None else [c for c in columns if c in df.columns]
    return replace_columns(df, {c: normalised_text(quoted(c)) for c in chosen})


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Read the given columns as numbers; unreadable text becomes null."""
    return replace_columns(df, {c: as_number(df, c) for c in columns if c in df.columns})


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def ci_width(
    df: DataFrame, low: str = fv.LOW_LIMIT, high: str = fv.HIGH_LIMIT, output: str = "ConfidenceIntervalWidth"
) -> DataFrame:
    if low not in df.columns or high not in df.columns:
        return df
    df = coerce_numeric(df, [low, high])
    return replace_columns(df, {output: quoted(high) - quoted(low)})


def geo_extract(df: DataFrame, column: str = "GeoLocation") -> DataFrame:
    """Latitude and longitude out of ``(lat, lon)`` text."""
    if column not in df.columns:
        return df
    return replace_columns(df, {
        "Latitude": coordinate(quoted(column), fv.LATITUDE_PATTERN),
        "Longitude": coordinate(quoted(column), fv.LONGITUDE_PATTERN),
    })


def years_since(
    df: DataFrame, year: str = fv.YEAR_START, end: str = fv.YEAR_END, base: int = fv.BASE_YEAR
) -> DataFrame:
    """Years since the base year; the end year is dropped."""
    if year not in df.columns:
        return df
    df = coerce_numeric(df, [year])
    return replace_columns(df, {f"YearsSince{base}": quoted(year) - F.lit(base)}).drop(end)


def missing_flag(df: DataFrame, column: str = fv.VALUE) -> DataFrame:
    """0/1 flag of missing values, to be taken before imputation."""
    if column not in df.columns:
        return df
    return replace_columns(df, {f"{column}_Missing_Flag": quoted(column).isNull().cast("int")})


def ci_missing_flag(df: DataFrame, low: str = fv.LOW_LIMIT, high: str = fv.HIGH_LIMIT) -> DataFrame:
    if low not in df.columns or high not in df.columns:
        return df
    return replace_columns(df, {"CI_Missing_Flag": (quoted(low).isNull() | quoted(high).isNull()).cast("int")})


def flag_above(df: DataFrame, column: str, limit: float | None, output: str) -> DataFrame:
    above = flag(quoted(column) > F.lit(limit)) if limit is not None else F.lit(0)
    return replace_columns(df, {output: above})


def clip_range(
    df: DataFrame, columns: Sequence[str] = (fv.YEAR_START, fv.YEAR_END), bounds=fv.VALID_YEARS
) -> DataFrame:
    return replace_columns(df, {c: clipped(quoted(c), *bounds) for c in columns if c in df.columns})


def drop_non_numeric(df: DataFrame) -> DataFrame:
    """Numbers, dates and times stay as they are, booleans become 0 and 1; text and nested columns go."""
    kept = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.BooleanType):
            kept.append(quoted(field.name).cast("int").alias(field.name))
        elif isinstance(field.dataType, (T.NumericType, *TIME_TYPES)):
            kept.append(quoted(field.name))
    return df.select(*kept)


def ensure_all_numeric(df: DataFrame, max_coerced: int | None = None) -> DataFrame:
    """Read text columns as numbers. With ``max_coerced``, only the first ones; every further one is dropped.

    Booleans become 0 and 1, dates and times seconds since 1970.
    """
    others = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.BooleanType):
            others[field.name] = quoted(field.name).cast("int")
        elif isinstance(field.dataType, TIME_TYPES):
            others[field.name] = quoted(field.name).cast("timestamp").cast("double")
    df = replace_columns(df, others)
    text = text_columns(df)
    coerced = text if max_coerced is None else text[:max_coerced]
    df = replace_columns(df, {c: to_number(quoted(c)) for c in coerced})
    return df.drop(*text[len(coerced):])
