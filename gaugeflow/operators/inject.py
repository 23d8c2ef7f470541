"""Noise put into a table by rule, for tests of the operators above. Deterministic in a row id and a seed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow import fixed_values as fv
from gaugeflow.functions.scalars import quoted
from gaugeflow.operators.columns import replace_columns
from gaugeflow.operators.split import hash_share

MISSING_COLUMNS = ["DataValue", "LocationAbbr", "LowConfidenceLimit", "HighConfidenceLimit", "GeoLocation"]


def inject_missing(
    df: DataFrame, row_id: str, rate: float = 0.2, columns: Sequence[str] = tuple(MISSING_COLUMNS), seed: int = 42
) -> DataFrame:
    """Set a share of each column to null, drawn apart per column."""
    present = [c for c in columns if c in df.columns]
    ids = quoted(row_id).cast("string")
    return replace_columns(df, {
        c: F.when(hash_share(F.concat_ws("|", F.lit(c), ids), seed) >= rate, quoted(c)) for c in present
    })


def inject_outliers(
    df: DataFrame, row_id: str, rate: float = 0.05, value: str = fv.VALUE, type_col: str = fv.VALUE_TYPE,
    low: float = 500.0, high: float = 3000.0, seed: int = 42,
) -> DataFrame:
    """Give a share of the rows an extreme value and the type ``Number``."""
    ids = quoted(row_id).cast("string")
    chosen = hash_share(F.concat_ws("|", F.lit("row"), ids), seed) < rate
    extreme = F.floor(low + (high - low) * hash_share(F.concat_ws("|", F.lit("value"), ids), seed)).cast("double")
    kind = df.schema[value].dataType
    changed = {value: F.when(chosen, extreme.cast(kind)).otherwise(quoted(value))}
    if type_col in df.columns:
        changed[type_col] = F.when(chosen, F.lit("Number")).otherwise(quoted(type_col))
    return replace_columns(df, changed)


def inject_duplicates(df: DataFrame, row_id: str, rate: float = 0.1, seed: int = 42) -> DataFrame:
    """Repeat a share of the rows once, in place: one scan and no shuffle."""
    again = hash_share(F.concat_ws("|", F.lit("copy"), quoted(row_id).cast("string")), seed) < rate
    return df.withColumn(
        "__copy", F.explode(F.when(again, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    ).drop("__copy")


def inject_constants(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "Constant_Topic": F.lit("Diabetes"), "Constant_Question": F.lit("Prevalence"), "Constant_Year": F.lit(2020),
    })
