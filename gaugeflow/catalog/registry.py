"""Registered queries: a Spark callable per operator and, where one exists, the same question as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.functions.scalars import quoted

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            TWINS[name] = sql
        return fn
    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, because sums are built in another order in every engine."""
    return df.select(*[
        (F.round(quoted(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else quoted(f.name))
        for f in df.schema.fields
    ])
