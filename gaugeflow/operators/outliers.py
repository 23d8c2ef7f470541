"""The four outlier rules. They differ on purpose: bounds, what happens to a row, and what counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow import fixed_values as fv
from gaugeflow.functions.scalars import clipped, numeric_columns, percent, quoted
from gaugeflow.operators.columns import replace_columns
from gaugeflow.operators.profile import report_rows
from gaugeflow.operators.quantiles import quantile_values, quantiles
from gaugeflow.storage import join_stats, pin_small

CAP_PROBS = [0.0, 0.005, 0.01, 0.25, 0.75, 0.99, 0.995, 1.0]


def iqr_caps(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    value: str = fv.VALUE,
    limits: Sequence[str] = (fv.LOW_LIMIT, fv.HIGH_LIMIT),
    mode: str = "exact",
) -> dict[str, tuple[float | None, float | None]]:
    """Caps of the columns that hold an outlier.

    A column has an outlier exactly when its minimum or maximum is outside the fences, so the quantiles
    with both ends are enough and nothing has to be counted.
    """
    cols = [c for c in (columns or numeric_columns(df)) if c not in fv.UNCAPPED_COLUMNS]
    caps = {}
    for c, parts in quantile_values(df, cols, CAP_PROBS, mode).items():
        if parts is None:
            continue
        lowest, p005, p01, q1, q3, p99, p995, highest = parts
        reach = fv.FENCE_WIDTH * (q3 - q1)
        if reach and (lowest < q1 - reach or highest > q3 + reach):
            caps[c] = (p005, p995) if c == value else (None, p99) if c in limits else (p01, p99)
    return caps


def iqr_cap(df: DataFrame, columns: Sequence[str] | None = None, **options) -> DataFrame:
    """Cap columns that have values beyond three interquartile ranges; no row is removed."""
    caps = iqr_caps(df, columns, **options)
    return replace_columns(df, {c: clipped(quoted(c), low, high) for c, (low, high) in caps.items()})


def outlier_remove_by_group(
    df: DataFrame,
    column: str,
    group: str = fv.VALUE_TYPE,
    method: str = "iqr",
    threshold: float = 3.0,
    min_rows: int = fv.MIN_GROUP_ROWS,
    mode: str = "exact",
) -> DataFrame:
    """Keep the rows inside their group's bounds.

    Groups below ``min_rows``, groups without values and rows without a group are kept. In the ``iqr``
    rule a missing value is dropped, in the ``zscore`` rule it is kept.
    """
    value = quoted(column)
    if method == "iqr":
        sizes, small_sizes = pin_small(df.groupBy(quoted(group)).agg(F.count("*").alias("__rows")))
        parts, small = quantiles(df, [column], [0.25, 0.75], by=[group], mode=mode)
        parts = parts.select(quoted(group), value[0].alias("__q1"), value[1].alias("__q3"))
        stats = join_stats(sizes, parts, [group], small)
        small = small and small_sizes
        width = threshold * (F.col("__q3") - F.col("__q1"))
        inside = F.coalesce(value.between(F.col("__q1") - width, F.col("__q3") + width), F.lit(False))
        judged = F.col("__q1").isNotNull()
    elif method == "zscore":
        stats, small = pin_small(df.groupBy(quoted(group)).agg(
            F.count("*").alias("__rows"), F.avg(value).alias("__mean"), F.stddev_pop(value).alias("__std"),
        ))
        score = F.abs(value - F.col("__mean")) / F.nullif(F.col("__std"), F.lit(0.0))
        # A group of equal values has no score, and a row without a score is not inside.
        inside = value.isNull() | F.coalesce(score <= threshold, F.lit(False))
        judged = F.col("__mean").isNotNull()
    else:
        raise ValueError(f"unknown method: {method}")
    stats = stats.where(quoted(group).isNotNull())
    joined = join_stats(df, stats, [group], small)
    keep = F.coalesce(F.col("__rows") < min_rows, F.lit(True)) | ~F.coalesce(judged, F.lit(False)) | inside
    return joined.where(keep).select(*[quoted(c) for c in df.columns])


def fences(df: DataFrame, columns: Sequence[str], width: float = fv.FENCE_WIDTH, mode: str = "exact") -> dict:
    """Lower and upper fence of every column that has a positive interquartile range."""
    parts = quantile_values(df, list(columns), [0.25, 0.75], mode)
    found = {}
    for c, quarter in parts.items():
        if quarter and quarter[1] != quarter[0]:
            spread = quarter[1] - quarter[0]
            found[c] = (quarter[0] - width * spread, quarter[1] + width * spread)
    return found


def outlier_report(
    df: DataFrame, columns: Sequence[str] | None = None, width: float = fv.FENCE_WIDTH, mode: str = "exact"
) -> DataFrame:
    """Columns with values beyond the fences: count, share, fences and range."""
    cols = list(columns or numeric_columns(df))
    bounds = fences(df, cols, width, mode)
    judged = [c for c in cols if c in bounds]
    if not judged:
        return df.sparkSession.createDataFrame(
            [], "feature string, outlier_count bigint, outlier_percent double, lower_bound double,"
            " upper_bound double, min_value double, max_value double"
        )
    wide = df.agg(*[
        agg.alias(f"{name}{i}") for i, c in enumerate(judged)
        for name, agg in (
            ("out", F.count_if((quoted(c) < bounds[c][0]) | (quoted(c) > bounds[c][1]))),
            ("n", F.count(quoted(c))), ("min", F.min(quoted(c))), ("max", F.max(quoted(c))),
        )
    ])
    rows = report_rows(wide, [
        {
            "feature": F.lit(c), "outlier_count": F.col(f"out{i}"),
            "outlier_percent": percent(F.col(f"out{i}"), F.col(f"n{i}")),
            "lower_bound": F.lit(bounds[c][0]), "upper_bound": F.lit(bounds[c][1]),
            "min_value": F.col(f"min{i}").cast("double"), "max_value": F.col(f"max{i}").cast("double"),
        }
        for i, c in enumerate(judged)
    ])
    return rows.where(F.col("outlier_count") > 0)


def outlier_totals(report: DataFrame, rows: int) -> DataFrame:
    """Totals of an outlier report: columns with outliers, outliers in all, rows looked at, and the time."""
    return report.agg(
        F.count("*").alias("n_columns"), F.coalesce(F.sum("outlier_count"), F.lit(0)).cast("long").alias("total_outliers"),
    ).withColumns({"total_rows": F.lit(rows).cast("long"), "reported_at": F.current_timestamp()})


def target_range_filter(df: DataFrame, target: str, width: float = fv.FENCE_WIDTH, mode: str = "exact") -> DataFrame:
    """Remove rows whose target is far outside its 1–99 % range; rows without a target stay."""
    parts = quantile_values(df, [target], [0.01, 0.99], mode)[target]
    if parts is None:
        return df
    reach = width * (parts[1] - parts[0])
    return df.where(quoted(target).isNull() | quoted(target).between(parts[0] - reach, parts[1] + reach))
