"""Saved models and their metadata, as published versions ``{name}_v{version}`` under one folder.

A version is written to a folder of its own publication. When model and metadata are complete, a marker named
after the publication is created, which is one atomic operation. Readers take the newest marked publication, so they see
the old version or the new one, never a mix, and a broken save leaves nothing to be seen.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow import fixed_values as fv
from gaugeflow.operators.learners import KINDS, Regressor
from gaugeflow.storage import located

METADATA = (
    "model_name string, version string, timestamp timestamp, model_type string, features array<string>,"
    " feature_count int, target string, performance map<string,double>, parameters map<string,string>"
)


def _folder(folder: str, name: str, version: str) -> str:
    return f"{folder}/{name}_v{version}"


def new_publication(folder: str, name: str, version: str) -> str:
    """Folder for one save of a version; not visible to readers until it is published."""
    return f"{_folder(folder, name, version)}/saves/{time.time_ns():020d}-{uuid.uuid4().hex}"


def publish(spark: SparkSession, publication: str) -> None:
    base, _, number = publication.rpartition("/saves/")
    system, marker = located(spark, f"{base}/published/{number}")
    out = system.create(marker, False)
    out.writeBytes(number)  # listings leave empty files out
    out.close()


def published(spark: SparkSession, folder: str, name: str, version: str) -> str:
    """Folder of the newest complete save of a version."""
    base = _folder(folder, name, version)
    system, markers = located(spark, f"{base}/published")
    numbers = [s.getPath().getName() for s in system.listStatus(markers)] if system.exists(markers) else []
    if not numbers:
        raise FileNotFoundError(f"no published version {version} of {name} in {folder}")
    return f"{base}/saves/{max(numbers)}"


def remove_unpublished(spark: SparkSession, folder: str, name: str, version: str) -> int:
    """Delete all saves of a version but the published one; returns their number. Not for use while a save is running."""
    current = published(spark, folder, name, version)
    base = _folder(folder, name, version)
    system, saves = located(spark, f"{base}/saves")
    gone = [s.getPath() for s in system.listStatus(saves) if s.getPath().getName() != current.rpartition("/")[2]]
    for path in gone:
        system.delete(located(spark, f"{base}/published/{path.getName()}")[1], False)
        system.delete(path, True)
    return len(gone)


def save_model_metadata(
    spark: SparkSession, publication: str, name: str, version: str, model_type: str, features: Sequence[str],
    target: str = "", performance: Mapping[str, float] | None = None, parameters: Mapping[str, object] | None = None,
) -> str:
    path = f"{publication}/metadata"
    row = (
        name, version, None, model_type, list(features), len(features), target,
        dict(performance or {}), {k: str(v) for k, v in (parameters or {}).items()},
    )
    spark.createDataFrame([row], METADATA).withColumn("timestamp", F.current_timestamp()).write.mode("overwrite").json(path)
    return path


def load_model_metadata(spark: SparkSession, folder: str, name: str, version: str) -> DataFrame:
    return spark.read.schema(METADATA).json(f"{published(spark, folder, name, version)}/metadata")


def save_regressor(
    learner: Regressor, spark: SparkSession, folder: str, name: str, version: str,
    performance: Mapping[str, float] | None = None,
) -> dict[str, str]:
    """Write model and metadata, then publish both at once. Returns their paths."""
    publication = new_publication(folder, name, version)
    learner.trained()
    learner.write_model(spark, f"{publication}/model")
    metadata = save_model_metadata(
        spark, publication, name, version, learner.type_name(), learner.features, learner.target, performance, learner.settings
    )
    publish(spark, publication)
    return {"model_path": f"{publication}/model", "metadata_path": metadata}


def load_regressor(spark: SparkSession, folder: str, name: str, version: str) -> Regressor:
    """The learner of the class that the metadata names. Its settings stay in the metadata, as text."""
    place = published(spark, folder, name, version)
    meta = spark.read.schema(METADATA).json(f"{place}/metadata").first()
    if meta["model_type"] not in KINDS:
        raise ValueError(f"no learner for models of type {meta['model_type']}; define a subclass of Regressor first")
    kind = KINDS[meta["model_type"]]
    return kind({}, list(meta["features"]), meta["target"], kind.read_model(spark, f"{place}/model"))


def list_models(spark: SparkSession, folder: str) -> DataFrame:
    """Name, version and size of every published model; the version is what follows the last ``_v``."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
        .select("path", "length")  # file contents are not read
    )
    place = r"/([^/]*_v[^/]*)/(saves|published)/([^/]+)"
    found = files.select(
        F.regexp_extract("path", place, 1).alias("entry"), F.regexp_extract("path", place, 2).alias("kind"),
        F.regexp_extract("path", place, 3).alias("number"), "length",
    ).where(F.col("entry") != "")
    current = F.max(F.when(F.col("kind") == "published", F.col("number")))
    sizes = found.groupBy("entry", "number").agg(F.sum("length").alias("bytes")).join(
        found.groupBy("entry").agg(current.alias("number")), ["entry", "number"]
    )
    return sizes.select(
        F.regexp_extract("entry", fv.MODEL_FILE_PATTERN, 1).alias("name"),
        F.regexp_extract("entry", fv.MODEL_FILE_PATTERN, 2).alias("version"), F.col("entry").alias("file"),
        (F.col("bytes") / F.lit(1024.0 * 1024.0)).alias("size_mb"),
    )
