"""Language of a text by the nearest of several TF-IDF centroids per language."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.llm.kernels import letter_digit_class, lower_table, pieces
from gaugeflow.llm.tables import hash_share
from gaugeflow.storage import join_stats, materialise, pin_small

#: Hashed dimensions of the n-grams of one to three bytes.
DIMENSIONS = 4096
#: Texts per language that the classifier is fitted on (expected number; drawn by a hash of id and text).
ROWS_PER_LANGUAGE = 1000
CENTROIDS = 4
#: Centroids that a text is compared with at a time.
CENTROID_BLOCK = 4096
UNKNOWN = "und"
SEED = 7


@dataclass
class Centroids:
    languages: list[str]
    owner: np.ndarray  # language index of each centroid
    vectors: np.ndarray  # unit rows
    radius: np.ndarray  # cosine distance beyond which a text is rejected
    idf: np.ndarray


def gram_counts(column: pa.Array) -> Iterator[np.ndarray]:
    """Counts of hashed n-grams for up to 256 texts at a time. Letters are lower-cased, all else is a blank."""
    letters = letter_digit_class()
    letters[48:58] = False
    fold = np.where(letters, lower_table(), 32).astype(np.uint64)
    for _, data, offsets in pieces(column, max_rows=256):
        rows, codes = len(offsets) - 1, fold[data]
        owner = np.repeat(np.arange(rows), np.diff(offsets))
        counts = np.zeros(rows * DIMENSIONS)
        gram = codes
        for size in (1, 2, 3):
            if size > 1:
                gram = (gram[:-1] << np.uint64(8)) | codes[size - 1:]
            if not len(gram):
                break
            blank = int.from_bytes(b" " * size, "big")
            used = (gram != blank) & (owner[:len(gram)] == owner[size - 1:])
            place = ((gram[used] + np.uint64(size << 32)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(52)
            counts += np.bincount(owner[:len(gram)][used] * DIMENSIONS + place.astype(np.int64), minlength=len(counts))
        yield counts.reshape(rows, DIMENSIONS)


def unit_rows(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weights = (np.log1p(counts) * idf).astype(np.float32)
    return weights / np.maximum(np.linalg.norm(weights, axis=1, keepdims=True), 1e-12)


def _document_frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, found = 0, np.zeros(DIMENSIONS, np.int64)
    for batch in batches:
        for counts in gram_counts(batch.column(0)):
            rows += len(counts)
            found += (counts > 0).sum(0)
    yield pa.RecordBatch.from_pydict({"place": np.arange(-1, DIMENSIONS), "n": np.concatenate([[rows], found])})


def _clustered(idf: np.ndarray, k: int, seed: int):
    """Spherical k-means over the sample of one language; the sample is bounded."""

    def run(sample: pd.DataFrame) -> pd.DataFrame:
        sample = sample.sort_values("text")
        x = np.concatenate([unit_rows(c, idf) for c in gram_counts(pa.array(sample["text"], pa.string()))])
        rng = np.random.default_rng(seed)
        centers = x[[rng.integers(len(x))]]
        while len(centers) < min(k, len(x)):
            gap = np.maximum(1 - (x @ centers.T).max(1), 0) + 1e-9
            centers = np.vstack([centers, x[rng.choice(len(x), p=gap / gap.sum())]])
        for _ in range(15):
            nearest = (x @ centers.T).argmax(1)
            sums = np.stack([x[nearest == j].sum(0) if (nearest == j).any() else centers[j] for j in range(len(centers))])
            centers = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
        close = x @ centers.T
        nearest, distance = close.argmax(1), 1 - close.max(1)
        radius = [float(np.quantile(distance[nearest == j], 0.99)) if (nearest == j).any() else 0.0
                  for j in range(len(centers))]
        packed = [c.astype(np.float32).tobytes() for c in centers]
        return pd.DataFrame({"lang": sample["lang"].iloc[0], "radius": radius, "vector": packed})

    return run


def fit_centroids(
    docs: DataFrame,
    usable: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    rows_per_language: int = ROWS_PER_LANGUAGE,
    centroids: int = CENTROIDS,
    seed: int = SEED,
) -> Centroids:
    """Learn from rows where ``usable`` holds and text and language are not null.

    Every language is learned. The fit reads about ``rows_per_language`` texts for each; the draw is a filter by hash whose
    rate comes from exact counts, so no row order or partitioning matters. A rare draw of none takes the least hash. The
    model has 64 KB a language and is broadcast.
    """
    rows = docs.where(usable & F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")
    )
    draw = hash_share("id", "text", seed=seed)
    counts, small = pin_small(rows.groupBy("lang").agg(
        F.least(F.lit(1.0), rows_per_language / F.count("*")).alias("rate"), F.min(draw).alias("least")
    ))
    if counts.isEmpty():
        return Centroids([], np.zeros(0, int), np.zeros((0, DIMENSIONS)), np.zeros(0), np.ones(DIMENSIONS))
    rated = join_stats(rows.withColumn("draw", draw), counts, ["lang"], small)
    sample = materialise(
        rated.where((F.col("draw") < F.col("rate")) | (F.col("draw") == F.col("least"))).select("lang", "text"), "languages"
    )
    found = sample.select("text").mapInArrow(_document_frequency, "place long, n long").groupBy("place").agg(
        F.sum("n").alias("n")
    ).collect()
    seen = np.zeros(DIMENSIONS + 1)
    for place, n in found:
        seen[place + 1] = n
    idf = np.log((1 + seen[0]) / (1 + seen[1:])) + 1
    models = sample.groupBy("lang").applyInPandas(
        _clustered(idf, centroids, seed), "lang string, radius double, vector binary"
    )
    models = sorted(materialise(models, "centroids").toLocalIterator(), key=lambda m: (m["lang"], m["radius"]))
    languages = sorted({m["lang"] for m in models})
    place = {name: i for i, name in enumerate(languages)}
    return Centroids(
        languages, np.array([place[m["lang"]] for m in models], int),
        np.frombuffer(b"".join(m["vector"] for m in models), np.float32).reshape(-1, DIMENSIONS),
        np.array([m["radius"] for m in models]), idf,
    )


def predict_language(docs: DataFrame, model: Centroids, text: str = "text") -> DataFrame:
    """Add ``lang_pred, score, rejected``; other columns stay, of equal names they are replaced.

    ``lang_pred`` is the language of the nearest centroid, ``und`` for a text that is null or has no letter or for an
    empty model. ``score`` is the cosine to that centroid. ``rejected`` marks texts farther from it than 99 % of its
    training texts by half as much again, and all ``und``. Ties go to the first language in order.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # plain values: workers need no import
    block = CENTROID_BLOCK
    kind = T.StructType([
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("rejected", T.BooleanType()),
    ])

    @F.pandas_udf(kind)
    def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        languages, owner, vectors, radius, idf = (
            shared.value[c] for c in ("languages", "owner", "vectors", "radius", "idf")
        )
        for texts in batches:
            known = np.array([bool(languages) and t is not None and any(map(str.isalpha, t)) for t in texts], bool)
            best, score = np.zeros(len(texts), int), np.zeros(len(texts))
            if languages:
                at = 0
                for counts in gram_counts(pa.array(texts, pa.string(), from_pandas=True)):
                    x, here = unit_rows(counts, idf), slice(at, at + len(counts))
                    top = np.full(len(x), -np.inf)
                    for first in range(0, len(vectors), block):
                        close = x @ vectors[first:first + block].T
                        nearer = close.max(1) > top
                        best[here] = np.where(nearer, first + close.argmax(1), best[here])
                        top = np.maximum(top, close.max(1))
                    score[here] = np.clip(top, 0, 1)
                    at += len(counts)
            names = [languages[owner[b]] if k else UNKNOWN for b, k in zip(best, known)]
            far = ~known if not languages else ~known | (1 - score > 1.5 * radius[best])
            yield pd.DataFrame({"lang_pred": names, "score": np.where(known, score, 0.0), "rejected": far})

    found = docs.withColumn("_found", nearest(F.col(text).cast("string")))
    return found.withColumns({c: F.col("_found").getField(c) for c in kind.names}).drop("_found")
