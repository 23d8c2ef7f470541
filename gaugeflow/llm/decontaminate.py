"""Benchmark passages in documents by greedy string tiling."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.llm.kernels import (
    BYTE_BASE, WORD_BASE, Powers, Words, letter_digit_class, pieces, window_hashes,
)
from gaugeflow.storage import materialise

#: Words of a seed, also the shortest tile.
SEED_WORDS = 5
#: Share of a test item's words that tiles have to cover.
COVERAGE = 0.5
#: Cells of the filter that spares most seeds the join: 2**26 bits, 8 MB whatever the size of the benchmark.
FILTER_BITS = 26


def _words(column: pa.Array, powers: Powers) -> Iterator[tuple[int, Words]]:
    """Words are runs of letters and digits of a lower-cased text, so case, punctuation and line breaks do not matter."""
    is_word = letter_digit_class()
    for row, data, offsets in pieces(column):
        yield row, Words(data, offsets, is_word, powers)


def _item_seeds(size: int):
    """``item, words, seed`` of each position of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        byte_powers, word_powers = Powers(BYTE_BASE), Powers(WORD_BASE)
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for row, words in _words(batch.column(1), byte_powers):
                seeds, at = words.grams(size, word_powers)
                owner = np.searchsorted(words.first, at, "right") - 1
                yield pa.RecordBatch.from_pydict({
                    "item": ids[row + owner], "words": np.diff(words.first)[owner], "seed": seeds.view(np.int64),
                })

    return run


def _suspects(size: int, shared):
    """Documents with seeds that pass the filter, with these seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = shared.value
        byte_powers, word_powers = Powers(BYTE_BASE), Powers(WORD_BASE)
        for batch in batches:
            rows, found = [], []
            for row, words in _words(batch.column(1), byte_powers):
                seeds, at = words.grams(size, word_powers)
                cell = (seeds >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
                hit = np.flatnonzero((filled[cell >> 6] >> (cell & 63).astype(np.uint64)) & np.uint64(1))
                owner = np.searchsorted(words.first, at[hit], "right") - 1
                heads = np.flatnonzero(np.diff(owner, prepend=-1))
                for a, b in zip(heads.tolist(), np.append(heads[1:], len(owner)).tolist()):
                    rows.append(row + int(owner[a]))
                    found.append(np.unique(seeds[hit[a:b]]).view(np.int64))
            kept = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [kept.column(0), kept.column(1), pa.array(found, pa.list_(pa.int64()))], ["row", "text", "seeds"]
            )

    return run


def tile(item: np.ndarray, doc: np.ndarray, shortest: int, powers: Powers) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two word sequences: ``(length, place in item, place in doc)`` of each tile.

    Search lengths fall from four times the shortest tile to it. For each one, windows of unmarked words with equal
    rolling hashes are extended as far as they go; the longest matches are marked first, until none is left.
    """
    marked_item, marked_doc, tiles = np.zeros(len(item), bool), np.zeros(len(doc), bool), []
    size = 4 * shortest
    while size >= shortest:
        places = defaultdict(list)
        of_item, of_doc = window_hashes(item, size, powers), window_hashes(doc, size, powers)
        for p, h in enumerate(of_item.tolist()):
            places[h].append(p)
        starts = np.flatnonzero(np.isin(of_doc, of_item)).tolist()
        hashes = of_doc.tolist() if starts else []
        found = True
        while found:
            matches = []
            for t in starts:
                for p in places[hashes[t]]:
                    if marked_item[p] or marked_doc[t]:
                        continue
                    if p and t and item[p - 1] == doc[t - 1] and not marked_item[p - 1] and not marked_doc[t - 1]:
                        continue  # part of a match that starts earlier
                    most = min(len(item) - p, len(doc) - t)
                    stop = (item[p:p + most] != doc[t:t + most]) | marked_item[p:p + most] | marked_doc[t:t + most]
                    length = int(stop.argmax()) if stop.any() else most
                    if length >= size:
                        matches.append((-length, p, t))
            found = False
            for length, p, t in sorted(matches):
                if not marked_item[p:p - length].any() and not marked_doc[t:t - length].any():
                    marked_item[p:p - length] = marked_doc[t:t - length] = found = True
                    tiles.append((-length, p, t))
        size = size // 2 if size > 2 * shortest else shortest if size > shortest else 0
    return tiles


def find_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    seed_words: int = SEED_WORDS,
    coverage: float = COVERAGE,
) -> DataFrame:
    """One row per document and test item that it contains: ``doc_id, item_id, coverage, tiles``.

    Tiles are common word runs of ``seed_words`` or more that do not overlap, so passages in another order count. Their
    words have to make up ``coverage`` of the item's words. ``tiles`` lists length, place in the item and place in the
    document of each. Null and empty texts, and items of fewer words than a seed, match nothing. Rows may repeat; extra
    columns are not read; an empty table on either side gives no rows.

    1. Seeds of all items fill a bit table of fixed size. Document seeds that miss it go before any shuffle.
    2. The others are joined to the items' seeds; a pair needs enough shared seeds for the wanted coverage, since a tile
       of n words has a seed for each five words at least. Only its count is summed before texts are read.
    3. The remaining pairs are tiled.
    """
    items = materialise(
        benchmark.select(F.col(item_id).alias("item_id"), F.lower(F.col(item_text).cast("string")).alias("item_text"))
        .withColumn("item", F.monotonically_increasing_id()), "items",
    )
    seeds = materialise(
        items.select("item", "item_text").mapInArrow(_item_seeds(seed_words), "item long, words long, seed long")
        .groupBy("item", "words", "seed").agg(F.count("*").alias("times")), "seeds",
    )
    cell = F.shiftrightunsigned("seed", 64 - FILTER_BITS)
    bits = seeds.groupBy(F.shiftright(cell, 6).alias("place")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(seed, {64 - FILTER_BITS}) & 63 as int))")).alias("bits")
    ).toPandas()
    filled = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    filled[bits["place"].to_numpy().astype(np.int64)] = bits["bits"].to_numpy().astype(np.int64).view(np.uint64)
    shared = docs.sparkSession.sparkContext.broadcast(filled)

    rows = docs.select(F.col(doc_id).alias("row"), F.lower(F.col(text).cast("string")).alias("text"))
    row_type = rows.schema["row"].dataType
    suspects = materialise(rows.mapInArrow(_suspects(seed_words, shared), T.StructType([
        T.StructField("row", row_type), T.StructField("text", T.StringType()),
        T.StructField("seeds", T.ArrayType(T.LongType())),
    ])).withColumn("suspect", F.monotonically_increasing_id()), "suspects")
    pairs = suspects.select("suspect", F.explode("seeds").alias("seed")).join(seeds, "seed").groupBy(
        "suspect", "item"
    ).agg(F.sum("times").alias("shared"), F.first("words").alias("words")).where(
        F.col("shared") * seed_words >= F.col("words") * F.lit(coverage) - 1e-9
    ).select("suspect", "item")

    tile_type = "array<struct<length:int,item_at:int,doc_at:int>>"

    @F.pandas_udf(f"words int, tiles {tile_type}")
    def tiled(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        byte_powers, word_powers = Powers(BYTE_BASE), Powers(WORD_BASE)

        def hashes(one: str) -> np.ndarray:
            return np.concatenate([w.hash for _, w in _words(pa.array([one], pa.string()), byte_powers)])

        for item_texts, texts in batches:
            out = []
            for item, doc in zip(item_texts, texts):
                item = hashes(item)
                found = tile(item, hashes(doc), seed_words, word_powers)
                out.append((len(item), [{"length": n, "item_at": p, "doc_at": t} for n, p, t in found]))
            yield pd.DataFrame(out, columns=["words", "tiles"])

    judged = pairs.join(items, "item").join(suspects.select("suspect", "row", "text"), "suspect").select(
        F.col("row").alias(doc_id), "item_id", tiled("item_text", "text").alias("found")
    )
    covered = F.aggregate("found.tiles", F.lit(0), lambda total, t: total + t["length"]) / F.col("found.words")
    return judged.select(doc_id, "item_id", covered.alias("coverage"), F.col("found.tiles").alias("tiles")).where(
        F.col("coverage") >= coverage
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that contain no test item, with all their columns. Ids have to be unique."""
    found = find_contaminated(docs, benchmark, doc_id, **options).select(F.col(doc_id).alias("_found_id")).distinct()
    return docs.join(found, F.col(doc_id).eqNullSafe(F.col("_found_id")), "left_anti")
