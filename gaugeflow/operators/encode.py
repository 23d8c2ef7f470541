"""One-hot encoding with fitted category lists, frequency bucketing, and feature assembly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow import fixed_values as fv
from gaugeflow.functions.scalars import flag, quoted
from gaugeflow.operators.columns import replace_columns
from gaugeflow.operators.profile import value_counts_topk
from gaugeflow.operators.ranking import numbered_rows

MAX_CATEGORIES = 5_000
OTHER = "Other"


def column_names(prefix: str, values: Sequence[str]) -> list[str]:
    """Output names in order. Dots become ``_``; a name that differs from an earlier one only in case gets the first
    free number, because Spark resolves column names without regard to case. Plain names come before made ones."""
    plain = [f"{prefix}_{value}".replace(".", "_") for value in values]
    taken = {name.lower() for name in plain}
    used: set[str] = set()
    names: list[str] = []
    for name in plain:
        made, number = name, 1
        while made.lower() in used or (number > 1 and made.lower() in taken):
            number += 1
            made = f"{name}_{number}"
        used.add(made.lower())
        names.append(made)
    return names


def categories(df: DataFrame, column: str, limit: int = MAX_CATEGORIES) -> list[str]:
    """Sorted distinct values. They become columns, so their number is checked instead of cut."""
    rows = df.where(quoted(column).isNotNull()).select(quoted(column).cast("string")).distinct().take(limit + 1)
    if len(rows) > limit:
        raise ValueError(f"column {column} has more than {limit} categories; bucket it before encoding")
    return sorted(r[0] for r in rows)


def one_hot(
    df: DataFrame, column: str, prefix: str, values: Sequence[str] | None = None, drop: bool = True
) -> DataFrame:
    """One 0/1 column per category; a missing value is 0 everywhere."""
    values = categories(df, column) if values is None else values
    kept = [quoted(c) for c in df.columns if c != column or not drop]
    dummies = [flag(quoted(column) == F.lit(v)).alias(n) for v, n in zip(values, column_names(prefix, values))]
    return df.select(*kept, *dummies)


def category_codes(df: DataFrame, column: str, output: str | None = None) -> DataFrame:
    """The sparse form for any number of categories: the rank of the value among the sorted distinct ones, null kept.

    The categories are a numbered table and are joined, so none has to become a column.
    """
    values = df.select(quoted(column).alias("__value")).where("__value IS NOT NULL").distinct()
    codes = numbered_rows(values, ["__value"], "__code").select("__value", (F.col("__code") - 1).alias("__code"))
    joined = df.join(codes, quoted(column) == F.col("__value"), "left")
    return joined.withColumn(output or f"{column}_code", F.col("__code")).drop("__value", "__code")


def frequent_values(df: DataFrame, column: str, k: int = fv.TOP_CATEGORIES) -> list[str] | None:
    """The k most frequent values, or None when there are no more than k."""
    top = [r["value"] for r in value_counts_topk(df, column, k + 1).collect()]
    return top[:k] if len(top) > k else None


def topk_bucket(df: DataFrame, column: str, k: int = fv.TOP_CATEGORIES, output: str | None = None) -> DataFrame:
    """Keep the k most frequent values and call the rest, missing ones included, ``Other``."""
    top = frequent_values(df, column, k)
    bucket = quoted(column) if top is None else F.when(
        quoted(column).isin(*top), quoted(column)
    ).otherwise(F.lit(OTHER))
    return replace_columns(df, {output or column: bucket})


def assemble_features(df: DataFrame, target: str, skip: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """Features vector of all columns but the target, in order, with the target as label."""
    names = [c for c in df.columns if c != target and c not in skip]
    inputs = [f"__f{i}" for i in range(len(names))]  # plain names, so columns like a.b and a_b can stand together
    safe = df.select(*[quoted(c).alias(n) for c, n in zip(names, inputs)], quoted(target).cast("double").alias("label"),
                     *[quoted(c).alias(f"__keep_{c}") for c in keep])
    out = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error").transform(safe)
    return out.select("features", "label", *[quoted(f"__keep_{c}").alias(c) for c in keep])
