"""Ordered results: the last n, every n-th row, first samples per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.functions.scalars import quoted
from gaugeflow.storage import materialise


def last_n(df: DataFrame, order: Sequence[Column], n: int, where: Column | None = None) -> DataFrame:
    """The last n rows of an order given newest first."""
    kept = df if where is None else df.where(where)
    return kept.orderBy(*order).limit(n)


def numbered_rows(df: DataFrame, order: Sequence[str], output: str = "row_number") -> DataFrame:
    """Global row number without a global window.

    A range-partitioned sort gives every row its place inside its partition; the sizes of the earlier
    partitions, one row per partition, give the offset. The order has to be total.
    """
    placed = materialise(
        df.sort(*[quoted(c) for c in order]).withColumn("__place", F.monotonically_increasing_id()), "numbered"
    )
    part = F.shiftright("__place", 33)
    upto = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("__size")).select(
        "__part", F.coalesce(F.sum("__size").over(upto), F.lit(0)).alias("__offset")
    )
    # One row per sort partition, bounded by spark.sql.shuffle.partitions.
    return (
        placed.join(F.broadcast(offsets), part == F.col("__part"))
        .withColumn(output, F.col("__place").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("__offset") + 1)
        .drop("__place", "__part", "__offset")
    )


def every_n(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    return numbered_rows(df, order).where(F.col("row_number") % n == 0)


def first_k_samples(df: DataFrame, group: Sequence[str], value: str, k: int = 5) -> DataFrame:
    """The k smallest values per group; Spark keeps k rows per task before it shuffles."""
    order = Window.partitionBy(*[quoted(g) for g in group]).orderBy(quoted(value))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
