"""The cleaning plan: text and numbers first, then imputation, capping, deduplication and flags.

Three fits depend on each other (medians, caps on imputed values, the flag limit on deduplicated rows), so
the table is written twice on the way; every fit then reads only its own columns. Nulls are counted while it is written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow import fixed_values as fv
from gaugeflow.functions.scalars import numeric_columns, quoted
from gaugeflow.operators.columns import (
    ci_missing_flag, clip_range, coerce_numeric, flag_above, normalise_strings, strip_column_names,
)
from gaugeflow.operators.impute import group_median_impute, median_impute_all
from gaugeflow.operators.lookups import dedupe_full_row
from gaugeflow.operators.outliers import iqr_cap
from gaugeflow.operators.quantiles import quantile_values
from gaugeflow.storage import drop_unused_shuffles, free, materialise_observed


def extreme_flag(
    df: DataFrame, column: str = fv.VALUE, prob: float = 0.99, mode: str = "exact"
) -> DataFrame:
    """1 for values above the percentile of their own column."""
    if column not in df.columns:
        return df
    limit = quantile_values(df, [column], [prob], mode)[column]
    return flag_above(df, column, limit[0] if limit else None, f"{column}_Extreme_Flag")


def _written(df: DataFrame, label: str, columns: Sequence[str]) -> tuple[DataFrame, dict[str, int]]:
    """The table as written, and the nulls of the given columns, counted on the way."""
    names = {f"n{i}": c for i, c in enumerate(columns)}
    kept, seen = materialise_observed(df, label, {n: F.count_if(quoted(c).isNull()) for n, c in names.items()})
    drop_unused_shuffles(df.sparkSession)
    return kept, {c: seen[n] for n, c in names.items()}


def clean_data(df: DataFrame, mode: str = "exact") -> DataFrame:
    df = coerce_numeric(normalise_strings(strip_column_names(df)), [fv.VALUE, *fv.COERCED_COLUMNS])
    df, gaps = _written(df, "coerced", numeric_columns(df))
    coerced = df
    if fv.VALUE_TYPE in df.columns:
        df = group_median_impute(df, mode=mode, gaps=gaps.get(fv.VALUE, 0))
    df = median_impute_all(df, mode=mode, gaps=gaps)
    df = iqr_cap(df, mode=mode)
    last = [c for c in (fv.VALUE, *fv.COERCED_COLUMNS) if c in df.columns]
    df, gaps = _written(dedupe_full_row(df), "deduplicated", last)
    free(coerced)
    df = clip_range(df)
    df = extreme_flag(df, mode=mode)
    df = ci_missing_flag(df)
    # Only a value column without a type column can still have gaps here.
    return median_impute_all(df, skip=(), columns=last, mode=mode, gaps=gaps)
