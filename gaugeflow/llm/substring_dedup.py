"""Removal of word sequences that occur more than once, by counting Rabin-Karp hashes of all windows."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.llm.kernels import (
    BYTE_BASE, WORD_BASE, Powers, Words, column_bytes, from_planes, pieces, planes, space_class,
)
from gaugeflow.llm.tables import text_bytes, whole_text

#: Windows that a map task hashes before it sends them; repeats within them are settled on the spot.
CHUNK_WINDOWS = 1 << 20
#: Documents after which it sends them too, however short they are.
CHUNK_DOCS = 1 << 16
#: Text bytes whose windows meet in one bucket (about 10 bytes per word there); raise it with the executors' memory.
BUCKET_BYTES = 16 << 20
CHECK_BASE, CHECK_SALT = 0xA0761D6478BD642F, 0xE7037ED1A0B428DB

MESSAGE = "bucket long, chunk long, is_table boolean, data binary, extra binary, places binary"


def _hashed_windows(size: int, buckets: int):
    """Map side: messages with the distinct window hashes of a chunk by bucket, and one with the chunk's documents."""

    def send(parts: list, number: int) -> Iterator[pa.RecordBatch]:
        keys = b"".join(p[0] for p in parts)
        counts, values, bucket = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
        salt = f"{TaskContext.get().partitionId()}:{number}".encode()
        chunk = int.from_bytes(hashlib.blake2b(salt + keys, digest_size=8).digest(), "little", signed=True)
        order = np.argsort(values, kind="stable")
        same = (values[order[1:]] == values[order[:-1]]) & (bucket[order[1:]] == bucket[order[:-1]])
        first, repeated = np.ones(len(order), bool), np.zeros(len(order), bool)
        first[1:] = ~same
        repeated[1:] |= same
        repeated[:-1] |= same
        known = np.sort(order[repeated])
        sent = np.sort(order[first])
        sent = sent[np.argsort(bucket[sent], kind="stable")]
        bucket = bucket[sent]
        borders = np.flatnonzero(np.diff(bucket, prepend=-1, append=buckets))
        rows = [(abs(chunk) % buckets, chunk, True, keys, counts.astype("<i4").tobytes(), planes(known))]
        rows += [
            (int(bucket[a]), chunk, False, values[sent[a:b]].tobytes(), b"", planes(sent[a:b]))
            for a, b in zip(borders[:-1].tolist(), borders[1:].tolist())
        ]
        columns = list(zip(*rows))
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            ["bucket", "chunk", "is_table", "data", "extra", "places"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_word = space_class()
        byte_powers, word_powers, check_powers = Powers(BYTE_BASE), Powers(WORD_BASE), Powers(CHECK_BASE)
        parts, windows, held, number = [], 0, 0, 0
        for batch in batches:
            for row, data, offsets in pieces(batch.column(1), max_rows=CHUNK_DOCS):
                words = Words(data, offsets, is_word, byte_powers)
                hashes, _ = words.grams(size, word_powers)
                checks = words.grams(size, check_powers, CHECK_SALT)[0] >> np.uint64(48)
                values = (hashes << np.uint64(16)) | checks  # the highest bits of the hash are told by the bucket
                bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
                counts = np.maximum(np.diff(words.first) - size + 1, 0)
                keys = b"".join(batch.column(0).slice(row, len(counts)).to_pylist())
                parts.append((keys, counts, values, bucket))
                windows, held = windows + len(hashes), held + len(counts)
                if windows >= CHUNK_WINDOWS or held >= CHUNK_DOCS:
                    yield from send(parts, number)
                    parts, windows, held, number = [], 0, 0, number + 1
        if parts:
            yield from send(parts, number)

    return run


def _repeated(messages: pa.Table) -> pa.Table:
    """Count the hashes of a bucket over all chunks; tell each chunk which of its windows occur elsewhere too."""
    tables = messages.filter(messages["is_table"]).select(["chunk", "is_table", "data", "extra", "places"])
    sent = messages.filter(pa.compute.invert(messages["is_table"]))
    if not sent.num_rows:
        return tables
    hashes = [np.frombuffer(x, np.uint64) for x in sent["data"].to_pylist()]
    borders = np.concatenate([[0], np.cumsum([len(x) for x in hashes])])
    hashes = np.concatenate(hashes)
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    flagged = np.zeros(len(hashes), bool)
    flagged[order[1:][same]] = True
    flagged[order[:-1][same]] = True
    chunks, places = [], []
    for i, (chunk, coded) in enumerate(zip(sent["chunk"].to_pylist(), sent["places"].to_pylist())):
        here = flagged[borders[i]:borders[i + 1]]
        if here.any():
            chunks.append(chunk)
            places.append(planes(from_planes(coded)[here]))
    none = [b""] * len(chunks)
    answers = pa.table({
        "chunk": pa.array(chunks, pa.int64()), "is_table": pa.array([False] * len(chunks), pa.bool_()),
        "data": pa.array(none, pa.binary()), "extra": pa.array(none, pa.binary()), "places": pa.array(places, pa.binary()),
    })
    return pa.concat_tables([tables.cast(answers.schema), answers])


def _merged(size: int):
    """Join the answers to one chunk and merge its repeated windows into maximal intervals of words per document."""

    def run(messages: pa.Table) -> pa.Table:
        table = messages.filter(messages["is_table"])
        keys = table["data"][0].as_py()
        counts = np.frombuffer(table["extra"][0].as_py(), "<i4").astype(np.int64)
        windows = np.unique(np.concatenate([from_planes(x) for x in messages["places"].to_pylist()]))
        if not len(windows):  # a chunk in which nothing is repeated
            return pa.table({"key": pa.array([], pa.binary()), "spans": pa.array([], pa.list_(pa.int64()))})
        ends = np.cumsum(counts)
        owner = np.searchsorted(ends, windows, "right")
        position = windows - (ends - counts)[owner]
        opens = np.ones(len(windows), bool)  # an interval goes on while the next window starts inside or right after it
        opens[1:] = (owner[1:] != owner[:-1]) | (position[1:] > position[:-1] + size)
        start = np.flatnonzero(opens)
        stop = np.append(start[1:], len(windows)) - 1
        begin, end, doc = position[start], position[stop] + size, owner[start]
        heads = np.flatnonzero(np.diff(doc, prepend=-1))
        done, out_keys, spans = set(), [], []
        for a, b in zip(heads.tolist(), np.append(heads[1:], len(doc)).tolist()):
            key = keys[16 * doc[a]:16 * doc[a] + 16]
            if key not in done:  # copies have the same intervals
                done.add(key)
                out_keys.append(key)
                spans.append(np.stack([begin[a:b], end[a:b]], 1).ravel())
        return pa.table({"key": pa.array(out_keys, pa.binary()), "spans": pa.array(spans, pa.list_(pa.int64()))})

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words, removed words and the words left, joined by one space."""
    for batch in batches:
        data, offsets = column_bytes(batch.column(1))
        raw = data.tobytes()
        n_words, n_removed, kept = [], [], []
        spans = batch.column(2).to_pylist()
        for a, b, cut in zip(offsets[:-1].tolist(), offsets[1:].tolist(), spans):
            words = raw[a:b].split()  # bytes are split at exactly the six blanks of ASCII
            count = len(words)
            if cut:
                left, at = [], 0
                for begin, end in zip(cut[::2], cut[1::2]):
                    left += words[at:begin]
                    at = end
                words = left + words[at:]
            n_words.append(count)
            n_removed.append(count - len(words))
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), batch.column(2),
             pa.array(kept, pa.binary()).cast(pa.string())],
            ["row", "n_words", "n_removed", "spans", "kept_text"],
        )


def remove_repeated_windows(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = 35,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_removed, spans, kept_text``.

    Words are cut at ASCII blanks and stay as they are. Each word covered by a window of ``window`` words whose sequence
    also starts anywhere else, in the same text included, is removed; ``spans`` holds begin and end (exclusive) of each
    maximal removed interval in turn, null where nothing goes. A null, empty or shorter text has no window. Rows may
    repeat; repeated rows repeat each other's windows. Extra columns are not read.

    1. Map tasks hash every window and settle repeats inside a chunk of about a million, so that a window sends one
       hash per chunk, however often it occurs. Hashes go to buckets as packed arrays of 8 bytes a window, plus about
       one for its place.
    2. Each bucket counts its hashes and tells the chunks which windows are repeated.
    3. Each chunk merges repeated windows into intervals; these are joined to the texts by content digest.

    The bucket, 48 bits of the hash and 16 bits of a second, independent hash stand for a word sequence. Buckets grow
    in number with the input and tell up to 16 bits more, so for 10**13 windows some 40 pairs in all can be expected to
    agree by chance, and for the 10**8 of a million documents less than one in a thousand runs has any.
    """
    rows = docs.select(F.col(doc_id).alias("row"), whole_text(text).alias("text")).withColumn(
        "key", F.unhex(F.md5(F.col("text").cast("binary")))
    )
    buckets = max(1, math.ceil(text_bytes(docs, text) / bucket_bytes))
    messages = rows.select("key", "text").mapInArrow(_hashed_windows(window, buckets), MESSAGE)
    answers = messages.groupBy("bucket").applyInArrow(
        _repeated, "chunk long, is_table boolean, data binary, extra binary, places binary"
    )
    spans = answers.groupBy("chunk").applyInArrow(_merged(window), "key binary, spans array<long>")
    spans = spans.groupBy(F.col("key").alias("span_key")).agg(F.first("spans").alias("spans"))
    found = rows.join(spans, F.col("key") == F.col("span_key"), "left").select("row", "text", "spans")
    cut = found.mapInArrow(_cut, T.StructType([
        T.StructField("row", rows.schema["row"].dataType), T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()), T.StructField("spans", T.ArrayType(T.LongType())),
        T.StructField("kept_text", T.StringType()),
    ]))
    return cut.select(F.col("row").alias(doc_id), "n_words", "n_removed", "spans", "kept_text")
