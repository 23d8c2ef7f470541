"""Tables kept between the steps of a job, in the folder the cluster shares."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Statistics up to this number of bytes, as written, are broadcast.
SMALL_TABLE_BYTES = 4 << 20
_OWN_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only for local sessions without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _OWN_FOLDERS:
        _OWN_FOLDERS[app] = tempfile.mkdtemp(prefix="gaugeflow-")
    return _OWN_FOLDERS[app]


def located(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below a folder of this application that is removed when its process ends."""
    base = f"{shared_folder(spark)}/gaugeflow-{spark.sparkContext.applicationId}"
    system, folder = located(spark, base)
    if not system.exists(folder):  # only an existing folder can be marked for removal
        system.mkdirs(folder)
        system.deleteOnExit(folder)
    return f"{base}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back: cuts the lineage, keeps column pruning, outlives executors."""
    path = new_path(df.sparkSession, label)
    df.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", "1").parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept.kept_at = path
    return kept


def materialise_observed(df: DataFrame, label: str, metrics: Mapping[str, Column]) -> tuple[DataFrame, dict]:
    """``materialise``, with aggregates of all rows taken while they are written, at no pass of their own."""
    if not metrics:
        return materialise(df, label), {}
    seen = Observation(f"{label}-{uuid.uuid4().hex}")
    kept = materialise(df.observe(seen, *[m.alias(name) for name, m in metrics.items()]), label)
    return kept, seen.get


def free(df: DataFrame) -> None:
    """Delete the table behind a result of ``materialise`` as soon as nothing reads it any more."""
    path = getattr(df, "kept_at", None)
    if path:
        system, hadoop_path = located(df.sparkSession, path)
        system.delete(hadoop_path, True)


def drop_unused_shuffles(spark: SparkSession) -> None:
    """Let Spark delete shuffle files of plans that are gone: it learns of them only when the driver's memory is collected."""
    gc.collect()
    spark._jvm.System.gc()


def spread(df: DataFrame, min_bytes: int = 4 << 20) -> DataFrame:
    """Spread a scan of a few files that cannot be split over all cores.

    Only scans with fewer partitions than cores are shuffled, so tables of many files are left alone.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    cores = df.sparkSession.sparkContext.defaultParallelism
    if not min_bytes <= size <= cores * (128 << 20) or df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def written_bytes(df: DataFrame) -> int:
    """Size of the table behind a result of ``materialise``."""
    system, folder = located(df.sparkSession, df.kept_at)
    return system.getContentSummary(folder).getLength()


def pin_small(df: DataFrame, label: str = "stats", max_bytes: int = SMALL_TABLE_BYTES) -> tuple[DataFrame, bool]:
    """Evaluate a statistics table once: it is written, and its written size tells whether it may be broadcast.

    The second value is True up to ``max_bytes``; a larger table has to be joined by shuffle.
    """
    kept = materialise(df, label)
    return kept, written_bytes(kept) <= max_bytes


def join_stats(df: DataFrame, stats: DataFrame, keys: list[str], small: bool, how: str = "left") -> DataFrame:
    """Join fitted statistics to the fact table: broadcast when checked small, else a shuffle join.

    Rows without a key match nothing, so for a left join they are set apart before the shuffle; hot keys are left to
    adaptive skew splitting.
    """
    if small:
        return df.join(F.broadcast(stats), keys, how)
    if how != "left":
        return df.join(stats, keys, how)
    whole = F.lit(True)
    for key in keys:
        whole = whole & F.col(f"`{key}`").isNotNull()
    joined = df.where(whole).join(stats, keys, how)
    added = [F.lit(None).cast(stats.schema[c].dataType).alias(c) for c in stats.columns if c not in keys]
    others = [F.col(f"`{c}`") for c in df.columns]
    return joined.unionByName(df.where(~whole).select(*others, *added))
