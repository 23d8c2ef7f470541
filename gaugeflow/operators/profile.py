"""Profiles: null counts, numeric validity, frequencies, years, strata, feature statistics.

Statistics of all columns come out of one wide aggregate; only its single row is turned into report rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow import fixed_values as fv
from gaugeflow.functions.scalars import as_number, flag, nan_to_null, percent, quoted
from gaugeflow.operators.quantiles import quantiles


def report_rows(wide: DataFrame, items: Sequence[dict[str, Column]]) -> DataFrame:
    """Turn a one-row aggregate into one report row per item."""
    return wide.select(F.inline(F.array(*[
        F.struct(*[expr.alias(name) for name, expr in item.items()]) for item in items
    ])))


def not_empty(df: DataFrame, on_fail: str = "report") -> DataFrame:
    """Whether there is a row at all; looks at one row only."""
    out = df.limit(1).agg((F.count("*") > 0).alias("has_rows"))
    if on_fail == "raise" and not out.first()[0]:
        raise ValueError("The table is empty")
    return out


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls per column plus the line ``*`` for all cells, with the warning above 30 %."""
    cols = df.columns
    counts = df.agg(F.count("*").alias("rows"), *[
        F.count_if(quoted(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)
    ])
    total = sum((F.col(f"n{i}") for i in range(len(cols))), F.lit(0).cast("bigint"))
    wide = counts.select("*", total.alias("all"), (F.col("rows") * len(cols)).alias("cells"))
    items = [(c, F.col(f"n{i}"), F.col("rows")) for i, c in enumerate(cols)]
    items.append(("*", F.col("all"), F.col("cells")))
    lines = report_rows(wide, [
        {"column": F.lit(name), "n_null": nulls, "n_cells": cells} for name, nulls, cells in items
    ])
    # Derived columns come after the rows are formed, which keeps the expressions small.
    return lines.withColumn("null_pct", percent(F.col("n_null"), F.col("n_cells"))).withColumn(
        "warning", F.coalesce(F.col("null_pct") > fv.MAX_NULL_PERCENT, F.lit(False))
    )


def numeric_validity(df: DataFrame, column: str = fv.VALUE, type_col: str = fv.VALUE_TYPE) -> DataFrame:
    """Share of readable numbers, their range and median, and the warnings drawn from them."""
    has_type = type_col in df.columns
    percent_type = F.lit(False)
    if has_type:
        for word in fv.PERCENT_TYPE_WORDS:
            percent_type = percent_type | quoted(type_col).contains(word)
    values = df.select(as_number(df, column).cast("double").alias("v"), flag(percent_type).alias("p"))
    stats = values.agg(
        F.count("*").alias("n_rows"), F.count("v").alias("n_valid"),
        F.min("v").alias("min"), F.max("v").alias("max"), F.max("p").alias("p"),
    )
    middle, _ = quantiles(values, ["v"], [0.5])
    merged = stats.withColumn("median", F.lit(_first_number(middle.first()["v"])).cast("double"))
    valid_pct = percent(F.col("n_valid"), F.col("n_rows"))
    return merged.select(
        F.lit(column).alias("column"), "n_rows", "n_valid", valid_pct.alias("valid_pct"), "min", "median", "max",
        F.coalesce(F.col("min") < 0, F.lit(False)).alias("negative_warning"),
        F.coalesce((F.col("p") == 1) & (F.col("max") > 100), F.lit(False)).alias("above_100_warning"),
        F.coalesce(100 - valid_pct > fv.MAX_NON_NUMERIC_PERCENT, F.lit(False)).alias("non_numeric_warning"),
        (F.col("n_valid") == 0).alias("no_numbers_error"),
    )


def _first_number(values: list[float] | None) -> float | None:
    return values[0] if values else None


def non_numeric_values(df: DataFrame, column: str = fv.VALUE, k: int = 10) -> DataFrame:
    """Most frequent texts that are not numbers."""
    return value_counts_topk(df.where(as_number(df, column).isNull()), column, k)


def value_counts_topk(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values; ties go to the smaller value."""
    counts = (
        df.where(quoted(column).isNotNull())
        .groupBy(quoted(column).alias("value"))
        .agg(F.count("*").alias("n_rows"))
    )
    return counts.orderBy(F.desc("n_rows"), F.asc("value")).limit(k)


def year_profile(df: DataFrame) -> DataFrame:
    """Range and median of the start and end year with their warnings."""
    found = [next((c for c in ("Year", fv.YEAR_START) if c in df.columns), None)]
    found.append(fv.YEAR_END if fv.YEAR_END in df.columns else None)
    cols = [c for c in found if c]
    limits = dict(zip(found, [(1990, 2030), (2000, 2030)]))
    years = df.select(*[as_number(df, c).cast("double").alias(c) for c in cols])
    wide = years.agg(*[
        agg.alias(f"{name}_{c}") for c in cols
        for name, agg in (("n", F.count(c)), ("min", F.min(c)), ("max", F.max(c)))
    ])
    middle, _ = quantiles(years, cols, [0.5])
    medians = middle.first()
    return report_rows(wide, [
        {
            "column": F.lit(c), "n_valid": F.col(f"n_{c}"), "min": F.col(f"min_{c}"),
            "median": F.lit(_first_number(medians[c])).cast("double"), "max": F.col(f"max_{c}"),
            "warning": F.coalesce(
                ~F.lit(_first_number(medians[c])).cast("double").between(*limits[c]), F.lit(True)
            ),
        }
        for c in cols
    ])


def stratification_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("Stratification") and not c.endswith("ID")]


def stratification_profile(df: DataFrame, columns: Sequence[str] | None = None, top: int = 3) -> DataFrame:
    """Distinct values and the most frequent ones of each stratum column; null counts if all are null.

    The rows are counted per (column, value) before the shuffle, and the ranking keeps ``top`` rows per task.
    """
    cols = list(columns or stratification_columns(df))
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), quoted(c).cast("string").alias("value")) for c in cols
    ])))
    counts = long.groupBy("column", "value").agg(F.count("*").alias("n_rows"))
    totals = counts.groupBy("column").agg(F.count("value").alias("n_distinct"))
    order = Window.partitionBy("column").orderBy(F.desc("n_rows"), F.asc("value"))
    ranked = (
        counts.where(F.col("value").isNotNull())
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    )
    # One total row per column of the table: as small as the schema.
    return ranked.join(F.broadcast(totals), "column", "right").select(
        "column", "n_distinct", "rank", "value", "n_rows"
    )


def feature_stats(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), mode: str = "exact") -> DataFrame:
    """Mean, sample deviation, range and quartiles per numeric column (and group), in long form."""
    numbers = df.select(*[quoted(b) for b in by], *[as_number(df, c).cast("double").alias(c) for c in columns])
    wide = numbers.groupBy(*[quoted(b) for b in by]).agg(*[
        agg.alias(f"{name}_{i}") for i, c in enumerate(columns)
        for name, agg in (
            ("mean", F.avg(quoted(c))), ("std", F.stddev_samp(quoted(c))), ("min", F.min(quoted(c))),
            ("max", F.max(quoted(c))), ("n", F.count(quoted(c))),
        )
    ])
    parts, small = quantiles(numbers, columns, [0.25, 0.5, 0.75], by=by, mode=mode)
    parts = parts.toDF(*by, *[f"q_{i}" for i in range(len(columns))])
    if by:
        side = F.broadcast(parts) if small else parts
        same = F.lit(True)
        for b in by:
            same = same & wide[f"`{b}`"].eqNullSafe(parts[f"`{b}`"])
        joined = wide.join(side, same).drop(*[parts[f"`{b}`"] for b in by])
    else:
        row = parts.first()
        joined = wide.select("*", *[
            F.lit(row[f"q_{i}"]).cast("array<double>").alias(f"q_{i}") for i in range(len(columns))
        ])
    items = F.array(*[
        F.struct(
            F.lit(c).alias("feature"),
            *[nan_to_null(F.col(f"{n}_{i}")).alias(n) for n in ("mean", "std", "min", "max")],
            *[F.col(f"q_{i}")[j].alias(q) for j, q in enumerate(("q25", "q50", "q75"))],
            F.col(f"n_{i}").alias("n"),
        )
        for i, c in enumerate(columns)
    ])
    return joined.select(*[quoted(b) for b in by], F.inline(items))
