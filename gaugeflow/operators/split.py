"""Train/validation/test split by hash, and the checks around it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow import fixed_values as fv
from gaugeflow.functions.scalars import numeric_columns, percent, quoted, relative_gap
from gaugeflow.operators.outliers import target_range_filter
from gaugeflow.operators.profile import report_rows


def hash_share(row_id: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the seed and the row id only, never on the partitioning."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), row_id.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)


def split_train_val_test(
    df: DataFrame,
    target: str,
    row_id: str,
    drop: Sequence[str] = (),
    val_size: float = 0.1,
    test_size: float = 0.2,
    seed: int = 42,
    mode: str = "exact",
) -> DataFrame:
    """Drop leakage columns and far-out targets, then label each row train, val or test. No shuffle."""
    if target not in df.columns:
        raise ValueError(f"Target column '{target}' not found")
    kept = target_range_filter(df.drop(*[c for c in drop if c != row_id]), target, mode=mode)
    share = hash_share(quoted(row_id), seed)
    train_size = 1.0 - val_size - test_size
    part = (
        F.when(share < train_size, F.lit("train")).when(share < train_size + val_size, F.lit("val"))
        .otherwise(F.lit("test"))
    )
    return kept.withColumn("split", part)


def contiguous_folds(df: DataFrame, row_id: str, folds: int = fv.FOLDS, seed: int = 42, output: str = "fold") -> DataFrame:
    """Fold number 0..folds-1 as equal ranges of the row hash."""
    share = hash_share(quoted(row_id), seed)
    return df.withColumn(output, F.floor(share * folds).cast("int"))


def split_means(df: DataFrame, target: str, split: str = "split") -> DataFrame:
    return df.groupBy(quoted(split).alias("split")).agg(F.avg(quoted(target)).alias("mean"), F.count("*").alias("n_rows"))


def _side(name: str, split: str) -> Column:
    return F.max(F.when(F.col("split") == split, F.col(name)))


def split_balance(df: DataFrame, target: str, split: str = "split") -> DataFrame:
    """Difference of the train and test target means in percent, and the train share."""
    means = split_means(df, target, split).agg(
        _side("mean", "train").alias("train_mean"), _side("mean", "test").alias("test_mean"),
        _side("n_rows", "train").alias("n_train"), _side("n_rows", "test").alias("n_test"),
    )
    gap = 100 * relative_gap(F.col("train_mean"), F.col("test_mean"), F.col("train_mean"))
    share = F.try_divide(F.col("n_train").cast("double"), F.col("n_train") + F.col("n_test"))
    return means.select("*", gap.alias("diff_pct"), share.alias("train_share"), (gap > 10).alias("mean_warning"),
                        (~share.between(0.6, 0.9)).alias("share_warning"))


def split_mean_spread(df: DataFrame, target: str, split: str = "split") -> DataFrame:
    """Largest relative difference between the three split means, in percent."""
    means = split_means(df, target, split).agg(*[
        _side("mean", s).alias(f"{s}_mean") for s in ("train", "val", "test")
    ])
    train, val, test = F.col("train_mean"), F.col("val_mean"), F.col("test_mean")
    spread = 100 * F.greatest(
        relative_gap(train, val, train), relative_gap(train, test, train), relative_gap(val, test, val)
    )
    return means.select("*", spread.alias("max_diff_pct"), (spread > 20).alias("warning"))


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation over complete pairs; null instead of an error for constant columns."""
    a, b = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_samp(a, b), F.stddev_samp(a) * F.stddev_samp(b))


def correlation_leakage(df: DataFrame, target: str, columns: Sequence[str] | None = None,
                        limit: float = fv.LEAKAGE_CORRELATION) -> DataFrame:
    """Correlation of each feature with the target and whether it is suspiciously high."""
    cols = [c for c in (columns or numeric_columns(df)) if c != target]
    y = quoted(target).cast("double")
    wide = df.agg(*[correlation(quoted(c).cast("double"), y).alias(f"r{i}") for i, c in enumerate(cols)])
    return report_rows(wide, [
        {
            "feature": F.lit(c), "correlation": F.col(f"r{i}"),
            "suspicious": F.coalesce(F.abs(F.col(f"r{i}")) > limit, F.lit(False)),
        }
        for i, c in enumerate(cols)
    ])


def leakage_report(df: DataFrame, target: str, start: str = fv.YEAR_START, end: str = fv.YEAR_END) -> DataFrame:
    """Warnings about the target among the features, high correlations, id-like names and future years."""
    years = start in df.columns and end in df.columns
    later = F.count_if(quoted(end) > quoted(start)) if years else F.lit(0).cast("bigint")
    named = [c for c in df.columns if any(w in c.lower() for w in fv.IDENTIFIER_WORDS)]
    facts = df.agg(F.count(quoted(target)).alias("n"), later.alias("later"))
    rows = [("target_in_features", target, F.lit(None).cast("double"))]
    rows += [("identifier_name", c, F.lit(None).cast("double")) for c in named]
    rows += [("end_after_start", end, F.col("later").cast("double"))]
    listed = report_rows(facts, [
        {"warning": F.lit(k), "column": F.lit(c), "value": v} for k, c, v in rows
    ]).where((F.col("warning") != "end_after_start") | (F.col("value") > 0))
    high = correlation_leakage(df, target).where("suspicious").select(
        F.lit("correlation").alias("warning"), F.col("feature").alias("column"), F.col("correlation").alias("value")
    )
    return listed.unionByName(high)


def with_row_hash(df: DataFrame, output: str = "row_id") -> DataFrame:
    """A row id made of all columns, for tables without a key. Equal rows get equal ids, so they never split.

    Each value comes with its length and nulls have a mark of their own, so different rows never join to one text.
    The marks are set in an array function: Spark makes no whole-stage method of it, which for a wide table would be too
    large to be compiled, but several small ones.
    """
    return df.withColumn(output, F.md5(F.array_join(F.transform(
        F.array(*[_marked(c, kind) for c, kind in df.dtypes]), lambda text: F.coalesce(text, F.lit("-"))
    ), "|")))


def _marked(name: str, kind: str) -> Column:
    """A value as text behind its length. Flags, which are most columns, are told apart before any text is made."""
    text = quoted(name).cast("string")
    marked = F.concat(F.length(text).cast("string"), F.lit(":"), text)
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        return marked
    return F.when(quoted(name) == 0, F.lit("1:0")).when(quoted(name) == 1, F.lit("1:1")).otherwise(marked)
