"""Exact deduplication with frequent texts split off before the shuffle."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.llm.kernels import column_bytes
from gaugeflow.storage import free, materialise

#: Counters of one Misra-Gries summary; also bounds the number of broadcast winners.
COUNTERS = 1000


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = column_bytes(batch.column(1))
        raw = data.tobytes()
        found = [hashlib.sha256(raw[a:b].lower()).digest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["row", "digest"])


def text_digests(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``row`` (the id) and SHA-256 ``digest`` of each text with A-Z lower-cased (bytes.lower() touches only these)."""
    rows = docs.select(F.col(doc_id).alias("row"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("digest", T.BinaryType())])
    return rows.mapInArrow(_digests, schema)


def frequent_digests(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Misra-Gries: at most ``counters`` digests, among them each that makes up 2 / counters of all rows or more.

    Each task keeps one summary. A summary undercounts by at most its rows / (counters + 1), and summed counts never
    exceed the true ones, so at most ``counters`` sums can reach the threshold.
    """
    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[bytes, int] = {}
        rows = 0
        for batch in batches:
            for digest in batch.column(0).to_pylist():
                rows += 1
                if digest in kept:
                    kept[digest] += 1
                elif len(kept) < counters:
                    kept[digest] = 1
                else:
                    kept = {d: n - 1 for d, n in kept.items() if n > 1}
        # a counter of 1 cannot reach the threshold of a large task, and rows tell the threshold
        yield pa.RecordBatch.from_pydict({
            "digest": pa.array([None, *kept], pa.binary()), "n": pa.array([rows, *kept.values()], pa.int64()),
        })

    found = digests.select("digest").mapInArrow(summaries, "digest binary, n long").groupBy("digest").agg(
        F.sum("n").alias("n")
    )
    found = materialise(found, "frequent")
    rows = found.where("digest is null").select("n").first()
    threshold = max(2.0, (rows[0] if rows else 0) / (counters + 1))
    return found.where(F.col("digest").isNotNull() & (F.col("n") >= threshold)).select("digest")


def mark_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", counters: int = COUNTERS) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, digest``.

    Equal texts are identical after lower-casing A-Z; a null text equals an empty one. The row with the largest id stays;
    a null id is the smallest, and of rows that repeat an id with an equal text exactly one stays. Extra columns are not
    read, an empty table gives no rows.

    Frequent digests are found by Misra-Gries, counted exactly and, at most ``counters`` of them, broadcast: their rows
    are resolved where they are. All other digests are ordinary groups of at most 2 / counters of the rows.
    """
    rows = materialise(text_digests(docs, doc_id, text).withColumn("copy", F.monotonically_increasing_id()), "digests")
    hot = materialise(frequent_digests(rows, counters), "hot")
    winners = rows.join(F.broadcast(hot), "digest", "left_semi").groupBy("digest").agg(
        F.count("*").alias("group_size"), F.max(F.struct("row", "copy")).alias("winner")
    )
    winners = materialise(winners, "winners")  # at most `counters` rows
    on_side = rows.join(F.broadcast(winners), "digest")
    group = Window.partitionBy("digest")
    ordinary = rows.join(F.broadcast(hot), "digest", "left_anti").select(
        "digest", "row", "copy", F.count("*").over(group).alias("group_size"),
        F.max(F.struct("row", "copy")).over(group).alias("winner"),
    )
    both = on_side.select(ordinary.columns).unionByName(ordinary)
    return both.select(
        F.col("row").alias(doc_id), F.col("winner.row").alias("keep_id"), "group_size",
        (F.col("copy") == F.col("winner.copy")).alias("kept"), "digest",
    )


def drop_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", counters: int = COUNTERS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Ids have to be unique."""
    kept = mark_duplicates(docs, doc_id, text, counters).where("kept").select(F.col(doc_id).alias("_kept_id"))
    return docs.join(kept, F.col(doc_id).eqNullSafe(F.col("_kept_id")), "left_semi")


def hex_digest(digest: str = "digest") -> Column:
    return F.lower(F.hex(digest))
