"""Reading and writing of tables: CSV with missing-value markers, CSV output, parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow import fixed_values as fv
from gaugeflow.functions.scalars import quoted, text_columns
from gaugeflow.operators.columns import replace_columns


def read_indicators(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    markers: Sequence[str] = tuple(fv.MISSING_MARKERS),
    multiline: bool = False,
) -> DataFrame:
    """CSV with a header and quoted text; marker texts become null. A missing path raises at once.

    ``multiline`` is needed for line breaks inside quotes only: such files cannot be split.
    """
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    reader = reader.option("multiLine", multiline)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    df = reader.csv(list(path) if not isinstance(path, str) else path)
    return replace_columns(df, {
        c: F.when(~quoted(c).isin(*markers), quoted(c)) for c in text_columns(df)
    })


def write_features_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    writer = df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
    # White space at the ends of a text is data.
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*[quoted(c) for c in columns]) if columns else df


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)
