"""Exact token-length histogram and the answers that suffix sums over it give."""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence

import pandas as pd
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Lengths per block of the two-level suffix sums.
BLOCK = 1024


def load_ranks(path: str) -> dict[bytes, int]:
    """Merge ranks of a byte-level vocabulary file, read once on the driver (a file of about 1 MB)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def token_lengths(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text",
                  output: str = "n_tokens") -> DataFrame:
    """Add the number of tokens of each whole text. Null and empty texts have 0 tokens; other columns stay.

    The vocabulary is broadcast: its size is fixed by the file and does not grow with the corpus.
    """
    shared = docs.sparkSession.sparkContext.broadcast((pattern, ranks))

    @F.pandas_udf(T.LongType())
    def lengths(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pattern, ranks = shared.value
        encoder = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for texts in batches:
            yield pd.Series([len(encoder.encode_ordinary(t)) if t else 0 for t in texts], dtype="int64")

    return docs.withColumn(output, lengths(F.col(text).cast("string")))


def length_histogram(lengths: DataFrame, by: Sequence[str] = (), length: str = "n_tokens") -> DataFrame:
    """Documents per length: ``n_tokens, n_docs`` for each group of ``by``. Empty input gives no rows.

    Counts are summed before the shuffle, so a hot group or length sends one row per task.
    """
    return lengths.groupBy(*[F.col(c) for c in by], F.col(length).alias("n_tokens")).agg(F.count("*").alias("n_docs"))


def suffix_sums(histogram: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Add to each length L the documents and tokens of lengths >= L, and what follows for a context limit of L.

    Columns: ``docs_at_least, tokens_at_least`` (suffix sums), ``total_docs, total_tokens``, ``truncated_tokens`` (tokens
    left when every document is cut to L) and ``share_within`` (documents of length <= L). Between two lengths the
    answers are linear in the limit, so these rows answer every limit. Sums are taken within blocks of 1,024 lengths and
    over the few block totals, so no task orders all lengths.
    """
    by = list(by)
    parts = histogram.withColumn("block", F.floor(F.col("n_tokens") / BLOCK)).withColumn(
        "tokens_here", F.col("n_tokens") * F.col("n_docs")
    )
    blocks = parts.groupBy(*by, "block").agg(
        F.sum("n_docs").alias("block_docs"), F.sum("tokens_here").alias("block_tokens")
    )
    later = Window.partitionBy(*by).orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    zero = F.lit(0).cast("long")
    blocks = blocks.select(
        *by, "block",
        F.coalesce(F.sum("block_docs").over(later), zero).alias("later_docs"),
        F.coalesce(F.sum("block_tokens").over(later), zero).alias("later_tokens"),
        F.sum("block_docs").over(whole).alias("total_docs"),
        F.sum("block_tokens").over(whole).alias("total_tokens"),
    )
    inside = Window.partitionBy(*by, "block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.withColumn("docs_inside", F.sum("n_docs").over(inside)).withColumn(
        "tokens_inside", F.sum("tokens_here").over(inside)
    )
    same = [parts[c].eqNullSafe(blocks[c]) for c in by] + [parts["block"] == blocks["block"]]
    joined = parts.join(blocks, same).select(
        *[parts[c] for c in by], "n_tokens", "n_docs",
        (F.col("docs_inside") + F.col("later_docs")).alias("docs_at_least"),
        (F.col("tokens_inside") + F.col("later_tokens")).alias("tokens_at_least"), "total_docs", "total_tokens",
    )
    return joined.withColumn(
        "truncated_tokens",
        F.col("total_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least"),
    ).withColumn(
        "share_within", 1.0 - (F.col("docs_at_least") - F.col("n_docs")) / F.col("total_docs")
    )


def limit_answers(sums: DataFrame, limits: Sequence[int], by: Sequence[str] = ()) -> DataFrame:
    """For each context limit: documents longer than it, tokens kept when cut to it, tokens lost.

    Reads only suffix sums: the smallest length above the limit says all.
    """
    above = sums.groupBy(*by).agg(
        F.max("total_docs").alias("total_docs"), F.max("total_tokens").alias("total_tokens"),
        F.array(*[
            F.struct(
                F.lit(int(limit)).cast("long").alias("token_limit"),
                F.min_by(
                    F.struct("docs_at_least", "tokens_at_least"),
                    F.when(F.col("n_tokens") > limit, F.col("n_tokens")),
                ).alias("above"),
            ) for limit in limits
        ]).alias("answers"),
    ).select(*by, "total_docs", "total_tokens", F.inline("answers"))
    docs, tokens = (F.coalesce(F.col(f"above.{c}_at_least"), F.lit(0).cast("long")) for c in ("docs", "tokens"))
    return above.select(
        *by, "token_limit", "total_docs", "total_tokens", docs.alias("docs_over"),
        (F.col("total_tokens") - tokens + F.col("token_limit") * docs).alias("kept_tokens"),
        (tokens - F.col("token_limit") * docs).alias("lost_tokens"),
    )


def length_quantiles(sums: DataFrame, probabilities: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Smallest length with at least the wanted share of documents at or below it."""
    return sums.groupBy(*by).agg(F.array(*[
        F.struct(
            F.lit(float(p)).alias("probability"),
            F.min(F.when(
                F.col("total_docs") - F.col("docs_at_least") + F.col("n_docs") >= F.col("total_docs") * p,
                F.col("n_tokens"),
            )).alias("n_tokens"),
        ) for p in probabilities
    ]).alias("answers")).select(*by, F.inline("answers"))
