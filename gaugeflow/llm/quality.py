"""Quality of a text: random-indexing word vectors pooled per document, a two-layer network, calibrated probabilities."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.llm.kernels import BYTE_BASE, Powers, Words, mix, pieces, token_classes
from gaugeflow.llm.tables import hash_share
from gaugeflow.storage import materialise

#: Labelled rows that the classifier is fitted on (expected number; drawn by a hash of the id).
LABELLED_ROWS = 8000
#: Words with a vector of their own, the most frequent ones of the labelled sample; all others share one per form.
VOCABULARY = 8192
VECTOR, NONZERO, REACH = 64, 8, 2
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 60, 128, 3e-3, 1e-4
FORMS, REPEATED = 64, 56
SEED = 11


@dataclass
class QualityModel:
    words: np.ndarray  # sorted hashes of the vocabulary
    vectors: np.ndarray  # one per form, then one per word
    mean: np.ndarray
    spread: np.ndarray
    layers: list[np.ndarray]
    temperature: float


def _forms(words: Words, data: np.ndarray) -> np.ndarray:
    """0 to 63: class of characters, upper or lower case, and length of each word; 56 and above if it comes again.

    A word comes again when one of the four before it in the same text is equal.
    """
    def inside(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[words.end] - sums[words.start]

    upper, digit = inside((data >= 65) & (data <= 90)), inside((data >= 48) & (data <= 57))
    length = words.end - words.start
    plain = token_classes()[data[words.start]] == 1
    case = np.select(
        [~plain, digit == length, digit > 0, upper == length, upper == 0, upper == 1], [0, 1, 2, 3, 4, 5], 6
    )
    owner = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    for back in range(1, 5):
        again = (words.hash[back:] == words.hash[:-back]) & (owner[back:] == owner[:-back]) & plain[back:]
        case[back:][again] = REPEATED // 8
    return case * 8 + np.minimum(np.log2(np.maximum(length, 1)).astype(int), 7)


def _token_pieces(column: pa.Array, chunk_bytes: int) -> Iterator[tuple[Words, np.ndarray]]:
    classes, powers = token_classes(), Powers(BYTE_BASE)
    for _, data, offsets in pieces(column, chunk_bytes):
        words = Words(data, offsets, classes, powers)
        yield words, _forms(words, data)


def _ids(words: Words, forms: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Row of each word's vector: forms first, then the vocabulary. A word that comes again counts by its form."""
    if not len(vocabulary):
        return forms
    place = np.minimum(np.searchsorted(vocabulary, words.hash), len(vocabulary) - 1)
    return np.where((vocabulary[place] == words.hash) & (forms < REPEATED), FORMS + place, forms)


def index_vectors(hashes: np.ndarray) -> np.ndarray:
    """Sparse random vectors of +1 and -1, a function of the hash alone."""
    out = np.zeros((len(hashes), VECTOR), np.float32)
    for i in range(NONZERO):
        drawn = mix(hashes + np.uint64(0x9E3779B97F4A7C15 * (i + 1) % (1 << 64)))
        out[np.arange(len(hashes)), (drawn % np.uint64(VECTOR)).astype(int)] += np.where(drawn >> np.uint64(63), 1, -1)
    return out


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [words.hash for words, _ in _token_pieces(batch.column(0), 1 << 20)]
        word, n = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
        yield pa.RecordBatch.from_pydict({"word": word.view(np.int64), "n": n})


def _contexts(vocabulary: np.ndarray):
    """Sums of the index vectors around each word of the vocabulary, one partial table per task."""
    own = index_vectors(np.concatenate([np.arange(FORMS, dtype=np.uint64), vocabulary]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros_like(own)
        for batch in batches:
            for words, forms in _token_pieces(batch.column(0), 1 << 18):
                ids = _ids(words, forms, vocabulary)
                owner = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
                for step in range(1, REACH + 1):
                    near = owner[step:] == owner[:-step]
                    left, right = ids[:-step][near], ids[step:][near]
                    np.add.at(sums, left, own[right])
                    np.add.at(sums, right, own[left])
        yield pa.RecordBatch.from_pydict({"word": np.arange(len(sums)), "vector": list(sums.astype(np.float64))})

    return run


def _pooled(column: pa.Array, vocabulary: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean word vector of each text and the logarithm of its number of words. Texts without words are all zero."""
    out = []
    for words, forms in _token_pieces(column, 1 << 18):
        rows = vectors[_ids(words, forms, vocabulary)]
        counts = np.diff(words.first)
        sums = np.zeros((len(counts), VECTOR))
        filled = counts > 0
        if filled.any():
            sums[filled] = np.add.reduceat(rows, words.first[:-1][filled], axis=0)
        out.append(np.column_stack([sums / np.maximum(counts, 1)[:, None], np.log1p(counts)]))
    return np.concatenate(out) if out else np.zeros((0, VECTOR + 1))


def _logits(x: np.ndarray, layers: list[np.ndarray]) -> np.ndarray:
    w1, b1, w2, b2 = layers
    return np.tanh(x @ w1 + b1) @ w2 + b2


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train_network(x: np.ndarray, y: np.ndarray, seed: int = SEED) -> list[np.ndarray]:
    """Two layers, logistic loss, Adam; a few MB of floats."""
    rng = np.random.default_rng(seed)
    layers = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
              rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
    first, second, step = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(x), BATCH):
            rows = order[at:at + BATCH]
            hidden = np.tanh(x[rows] @ layers[0] + layers[1])
            error = (_sigmoid(hidden @ layers[2] + layers[3]) - y[rows]) / len(rows)
            back = np.outer(error, layers[2]) * (1 - hidden ** 2)
            slopes = [x[rows].T @ back + DECAY * layers[0], back.sum(0), hidden.T @ error + DECAY * layers[2],
                      np.array([error.sum()])]
            step += 1
            for p, g, m, v in zip(layers, slopes, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return layers


def calibrated_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least logistic loss on rows that the network has not seen."""
    if not len(y):
        return 1.0
    grid = np.geomspace(0.25, 8, 61)
    losses = [np.mean(np.logaddexp(0, logits / t) - y * logits / t) for t in grid]
    return float(grid[int(np.argmin(losses))])


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    rows: int = LABELLED_ROWS,
    seed: int = SEED,
) -> QualityModel:
    """Fit on about ``rows`` labelled rows for which ``usable`` (a condition on the id) holds.

    The draw is a filter by hash whose rate comes from an exact count, so its size is bounded whatever the number of
    labels; it is broadcast to the texts. Labels other than 0 and 1 and null ids are left out. With one class or no
    rows at all, scores are that class or 0.5. Vocabulary, vectors and pooled features come from Spark jobs over the
    sample; the driver gets 8,192 words, their vectors and one pooled vector a row, and trains the network.
    """
    known = labels.where(usable & F.col(doc_id).isNotNull() & F.col(label).isin(0, 1)).select(
        F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y")
    )
    total = known.count()
    drawn = known.where(hash_share("id", seed=seed) < rows / max(total, 1))
    texts = docs.select(F.col(doc_id).alias("text_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    sample = materialise(
        texts.join(F.broadcast(drawn), F.col("text_id") == F.col("id")).select("id", "y", "text"), "labelled"
    )
    counted = sample.select("text").mapInArrow(_word_counts, "word long, n long").groupBy("word").agg(
        F.sum("n").alias("n")
    ).where("n >= 5").orderBy(F.desc("n"), "word").limit(VOCABULARY).collect()
    words = np.sort(np.array([r["word"] for r in counted], np.int64).view(np.uint64))
    sums = sample.select("text").mapInArrow(_contexts(words), "word long, vector array<double>").groupBy("word").agg(
        F.array(*[F.sum(F.col("vector")[i]) for i in range(VECTOR)]).alias("vector")
    ).collect()
    vectors = np.zeros((FORMS + len(words), VECTOR), np.float32)
    for word, vector in sums:
        vectors[word] = vector
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)

    def pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _pooled(batch.column(2), words, vectors)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(list(x), pa.list_(pa.float64()))], ["id", "y", "x"]
            )

    schema = T.StructType([sample.schema["id"], T.StructField("y", T.IntegerType()),
                           T.StructField("x", T.ArrayType(T.DoubleType()))])
    found = sample.mapInArrow(pooled, schema).withColumn("part", hash_share("id", seed=seed + 1)).orderBy(
        "part", "id", "y", F.hash("x")
    ).collect()
    x = np.array([r["x"] for r in found]).reshape(-1, VECTOR + 1)
    y, part = np.array([r["y"] for r in found], float), np.array([r["part"] for r in found])
    mean, spread = (x.mean(0), x.std(0) + 1e-6) if len(x) else (np.zeros(VECTOR + 1), np.ones(VECTOR + 1))
    scaled = (x - mean) / spread
    if len(set(y)) < 2:
        bias = 10.0 * (2 * y[0] - 1) if len(y) else 0.0
        layers = [np.zeros((VECTOR + 1, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), np.array([bias])]
        return QualityModel(words, vectors, mean, spread, layers, 1.0)
    fitted = part >= 0.2
    layers = train_network(scaled[fitted], y[fitted], seed)
    temperature = calibrated_temperature(_logits(scaled[~fitted], layers), y[~fitted])
    return QualityModel(words, vectors, mean, spread, layers, temperature)


def score_quality(docs: DataFrame, model: QualityModel, text: str = "text", output: str = "score") -> DataFrame:
    """Add the calibrated probability of label 1. Null and empty texts are scored as texts without words.

    Other columns stay; one named like ``output`` is replaced. The model's size is fixed, so it is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        for texts in batches:
            x = _pooled(pa.array(texts, pa.string(), from_pandas=True), m["words"], m["vectors"])
            yield pd.Series(_sigmoid(_logits((x - m["mean"]) / m["spread"], m["layers"]) / m["temperature"]))

    return docs.withColumn(output, score(F.col(text).cast("string")))
