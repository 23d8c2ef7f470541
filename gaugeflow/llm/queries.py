"""Registered queries of the operators, with production parameters, over whole tables, and SQL twins where SQL can."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.llm import (
    decontaminate, exact_dedup, language_id, mixing, near_dedup, packing, quality, search, secret_scan, sharding, spelling,
    substring_dedup, token_counts,
)
from gaugeflow.llm.tables import crc_part, table, whole_text

#: Folder of the public vocabulary files; never copied here.
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
#: Fixed value: the pattern that splits text before the merges of the byte-level vocabularies.
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    ranks = token_counts.load_ranks(f"{TOKENIZERS}/byte_bpe_50k.tiktoken")
    lengths = token_counts.token_lengths(table(spark, folder, "documents"), ranks, SPLIT_PATTERN)
    return token_counts.suffix_sums(token_counts.length_histogram(lengths))


@query
def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    marked = exact_dedup.mark_duplicates(table(spark, folder, "documents"))
    return marked.select("doc_id", "keep_id", "group_size", "kept", exact_dedup.hex_digest().alias("text_sha256"))


TWINS["op4_exact_dedup"] = """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))
    AS text_sha256 FROM documents
)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""


@query
def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    shards = sharding.shuffle_into_shards(table(spark, folder, "documents"), 40)
    text = whole_text()
    return shards.select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op7_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, folder, "documents"), shingle=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = substring_dedup.remove_repeated_windows(table(spark, folder, "documents"), window=35)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@query
def op3_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    ratios = secret_scan.log_ratios(secret_scan.transition_counts(secret_scan.labelled_samples(docs)))
    found = secret_scan.scan_secrets(docs, ratios)
    return found.select(
        "doc_id", *[secret_scan.count_kind(F.col("base"), k).alias(f"n_{k}") for k, *_ in secret_scan.RULES],
        F.size("added").cast("long").alias("n_markov"),
        F.sha2(secret_scan.spans_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secret_scan.spans_text(F.concat("base", "added")).alias("spans"),
    )


@query
def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = crc_part("doc_id", 4) == 2
    model = language_id.fit_centroids(docs, ~held_out)
    found = language_id.predict_language(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


@query
def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = crc_part("doc_id", 3) == 1
    model = quality.fit_quality(docs, table(spark, folder, "labels"), ~held_out)
    found = quality.score_quality(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query
def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "item_id", "coverage", F.size("tiles").alias("n_tiles"), F.lit(True).alias("contaminated")
    )


#: Domains by the labels, and their wanted shares of all tokens.
DOMAIN = "CASE WHEN toxic = 1 THEN 'toxic' WHEN quality = 0 THEN 'poor' WHEN quality = 1 THEN 'good' END"
WEIGHTS = {"good": 0.85, "poor": 0.10, "toxic": 0.05}


@query
def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = mixing.fit_domains(docs, table(spark, folder, "labels"), F.expr(DOMAIN), list(WEIGHTS))
    found = mixing.mixture_rates(docs, model, WEIGHTS)
    return found.select(
        "doc_id", "n_tokens", *[F.col("posteriors")[i].alias(f"p_{d}") for i, d in enumerate(model.domains)], "rate", "copies"
    )


@query
def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    found = spelling.group_spellings(table(spark, folder, "documents"), divisor=31)
    return found.select("word", "form", "root", "n", "n_near", "form_n")


@query
def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, folder, "documents"), f"{TOKENIZERS}/word_bpe_49k.json")
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op13_search(spark: SparkSession, folder: str) -> DataFrame:
    index = search.build_index(table(spark, folder, "documents"))
    return search.search(index, table(spark, folder, "benchmark"), k=20)


TWINS["op13_search"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS terms FROM documents
), q AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term FROM benchmark
), asked AS (SELECT item_id, term, count(*) AS times FROM q GROUP BY ALL),
size AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_words FROM d WHERE len(terms) > 0),
held AS (SELECT r, doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM d),
tf AS (SELECT r, doc_id, n, term, count(*) AS tf FROM held WHERE term IN (SELECT term FROM q) GROUP BY ALL),
weight AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf, size GROUP BY term),
impact AS (SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_words))) AS i
  FROM tf JOIN weight USING (term), size),
scored AS (SELECT item_id, r, doc_id, sum(times * i)::BIGINT AS score FROM impact JOIN asked USING (term) GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scored
  WHERE score > 0) WHERE rank <= 20
"""
