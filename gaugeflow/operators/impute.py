"""Median imputation: per group with a global second step, and per column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow import fixed_values as fv
from gaugeflow.functions.scalars import numeric_columns, quoted, text_columns
from gaugeflow.operators.columns import replace_columns
from gaugeflow.operators.quantiles import quantile_values, quantiles
from gaugeflow.storage import join_stats


def null_counts(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Nulls per column from one narrow pass."""
    row = df.agg(F.lit(0).alias("_"), *[
        F.count_if(quoted(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)
    ]).first()
    return {c: row[f"n{i}"] for i, c in enumerate(columns)}


def _with_medians(df: DataFrame, stats: DataFrame, small: bool, value: str, group: str, output: str) -> DataFrame:
    stats = stats.where(quoted(group).isNotNull()).select(quoted(group), quoted(value)[0].alias(output))
    return join_stats(df, stats, [group], small).select(*[quoted(c) for c in df.columns], quoted(output))


def group_transform(
    df: DataFrame, value: str = fv.VALUE, group: str = fv.VALUE_TYPE, output: str = "group_median", mode: str = "exact"
) -> DataFrame:
    """Median of the row's group beside each row.

    An aggregate joined back, not a window: a window would sort a hot group inside one task.
    """
    stats, small = quantiles(df, [value], [0.5], by=[group], mode=mode)
    return _with_medians(df, stats, small, value, group, output)


def group_median_impute(
    df: DataFrame,
    value: str = fv.VALUE,
    group: str = fv.VALUE_TYPE,
    mode: str = "exact",
    gaps: int | None = None,
) -> DataFrame:
    """Fill nulls with the group median, then what is left with the median taken after that fill.

    Rows without a group keep their value; if it is missing they get the global median. ``gaps`` is the
    number of nulls where the caller knows it.
    """
    if value not in df.columns:
        return df
    if not (null_counts(df, [value])[value] if gaps is None else gaps):
        return df
    if group in df.columns:
        stats, small = quantiles(df, [value], [0.5], by=[group], mode=mode)
        name = "__group_median"
        df = replace_columns(
            _with_medians(df, stats, small, value, group, name), {value: F.coalesce(quoted(value), quoted(name))}
        ).drop(name)
        if stats.where(quoted(group).isNull() | quoted(value)[0].isNull()).isEmpty():
            return df
    middle = quantile_values(df, [value], [0.5], mode)[value]
    return replace_columns(df, {value: F.coalesce(quoted(value), F.lit(middle[0] if middle else None))})


def median_impute_all(
    df: DataFrame,
    skip: Sequence[str] = (fv.VALUE,),
    columns: Sequence[str] | None = None,
    mode: str = "exact",
    gaps: Mapping[str, int] | None = None,
) -> DataFrame:
    """Fill nulls of numeric columns with the column median and of text columns with ``unknown``."""
    numbers = [c for c in (columns or numeric_columns(df)) if c in df.columns and c not in skip]
    texts = [] if columns else [c for c in text_columns(df) if c not in skip]
    gaps = null_counts(df, numbers) if gaps is None else gaps
    numbers = [c for c in numbers if gaps[c]]
    medians = quantile_values(df, numbers, [0.5], mode)
    filled = {c: F.coalesce(quoted(c), F.lit(medians[c][0])) for c in numbers if medians[c]}
    filled |= {c: F.coalesce(quoted(c), F.lit(fv.NULL_TEXT)) for c in texts}
    return replace_columns(df, filled)
