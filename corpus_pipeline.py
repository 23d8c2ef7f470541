"""From raw documents to shuffled shards in five stages. Each stage gets what the one before it has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.llm.decontaminate import drop_contaminated
from gaugeflow.llm.mixing import fit_domains, keep_mixture
from gaugeflow.llm.near_dedup import drop_near_duplicates
from gaugeflow.llm.quality import fit_quality, score_quality
from gaugeflow.llm.sharding import shuffle_into_shards
from gaugeflow.llm.tables import table
from gaugeflow.storage import free, materialise

SHARDS = 40
#: Domains by the labels, and the share of its tokens that each keeps in the mixture.
DOMAIN = "CASE WHEN toxic = 1 THEN 'toxic' WHEN quality = 1 THEN 'clean' END"
KEPT = {"clean": 1.0, "toxic": 0.5}


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated probability of good quality is below one half go."""
    model = fit_quality(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return score_quality(docs, model, output="_score").where("_score >= 0.5").drop("_score")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of documents that share 80 % of their five-word shingles, the one with the smallest id stays."""
    return drop_near_duplicates(docs, shingle=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold half of the words of a benchmark item or more, in tiles of five words, go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Half of the expected tokens of the toxic domain go; clean documents keep their rate of one."""
    model = fit_domains(docs, table(spark, sf_dir, "labels"), F.expr(DOMAIN), list(KEPT))
    return keep_mixture(docs, model, KEPT)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows in random order, with ``shard`` and ``slot``."""
    return shuffle_into_shards(docs, SHARDS)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: The classifiers and the estimates of the stages have no SQL form; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage. Between stages the documents are a written table, freed once the next one stands."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        kept = materialise(stage(spark, docs, sf_dir), name)
        free(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
