"""Ranked lexical search: blocks of an inverted index, pair bounds over term pairs, and MaxScore with both."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.llm.kernels import BYTE_BASE, Powers, Words, letter_digit_class, lower_table, pieces
from gaugeflow.llm.tables import hash_share
from gaugeflow.storage import materialise

#: Documents and text bytes of a block of the index; a longer text is a block of its own.
BLOCK_DOCS, BLOCK_BYTES = 4096, 8 << 20
#: Queries that meet the index in one pass.
QUERIES_AT_ONCE = 4096
#: Share of the blocks that is searched first; its results give every query a threshold to start with.
FIRST_SHARE = 0.1
#: Fixed values of the formula: scale of weights and of impacts, and the mixture of document lengths in percent.
WEIGHT_SCALE, IMPACT_SCALE, TF_SCALE, LENGTH_SCALE, LENGTH_PERCENT = 1000, 1_000_000_000, 1000, 12, 25
#: Fixed value: a term.
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

POSTINGS = "block long, n_docs long, n_words long, words binary, terms binary, first binary, doc binary, tf binary"


def query_terms(text: str | None) -> Counter:
    """Terms of a text with their repeats; A-Z lower-cased."""
    return Counter(TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)})))


def term_hashes(terms: list[str]) -> np.ndarray:
    """The 64-bit hash that stands for each term in the index, made by the same code as there."""
    data = np.frombuffer("".join(terms).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t.encode()) for t in terms])
    return Words(data, offsets, letter_digit_class(), Powers(BYTE_BASE)).hash if terms else np.zeros(0, np.uint64)


def _blocks(block_docs: int):
    """One row per block: its document ids, their lengths, and for each term the documents that hold it and how often."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_term, lower, powers = letter_digit_class(), lower_table(), Powers(BYTE_BASE)
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for row, data, offsets in pieces(batch.column(1), BLOCK_BYTES, block_docs):
                words = Words(lower[data], offsets, is_term, powers)
                counts = np.diff(words.first)
                doc = np.repeat(np.arange(len(counts)), counts)
                order = np.lexsort((doc, words.hash))
                hashes, doc = words.hash[order], doc[order]
                new_term = np.append(True, hashes[1:] != hashes[:-1])[:len(hashes)]
                new = new_term | np.append(True, doc[1:] != doc[:-1])[:len(hashes)]
                at = np.flatnonzero(new)
                first = np.append(np.flatnonzero(new_term[at]), len(at)).astype("<i4")
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array([0, len(counts)], pa.int32()), batch.column(0).slice(row, len(counts)))]
                    + [pa.array([x]) for x in (number, int((counts > 0).sum()), int(counts.sum()))]
                    + [pa.array([x.tobytes()], pa.binary()) for x in (
                        counts.astype("<i8"), hashes[at][first[:-1]], first, doc[at].astype("<i4"),
                        np.diff(np.append(at, len(hashes))).astype("<i4"))],
                    ["ids", *POSTINGS.replace(" long", "").replace(" binary", "").split(", ")],
                )
                number += 1

    return run


@dataclass
class SearchIndex:
    blocks: DataFrame
    id_type: T.DataType
    n_docs: int  # documents that hold a term
    n_words: int  # terms of all documents


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block_docs: int = BLOCK_DOCS) -> SearchIndex:
    """A written inverted index of all documents and whole texts, in blocks of a bounded number of documents and bytes.

    Terms are maximal runs of letters and digits (all characters beyond ASCII count as letters), A-Z lower-cased. They are
    kept as 64-bit hashes: two of a million different terms agree by chance with a probability of 3 in 10**8. A null or
    empty text has no terms. Blocks are made where the texts are read; nothing is shuffled.
    """
    rows = docs.select(F.col(doc_id).alias("row"), F.col(text).cast("string").alias("text"))
    id_type = rows.schema["row"].dataType
    fields = [T.StructField("ids", T.ArrayType(id_type))]
    for field in POSTINGS.split(", "):
        name, kind = field.split()
        fields.append(T.StructField(name, T.LongType() if kind == "long" else T.BinaryType()))
    blocks = materialise(rows.mapInArrow(_blocks(block_docs), T.StructType(fields)), "index")
    sums = blocks.agg(F.sum("n_docs"), F.sum("n_words")).first()
    return SearchIndex(blocks, id_type, sums[0] or 0, sums[1] or 0)


def _lists_of(terms: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted term in the sorted terms of a block, -1 where the block does not hold it."""
    if not len(terms):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(terms, wanted), len(terms) - 1)
    return np.where(terms[at] == wanted, at, -1)


def document_frequencies(index: SearchIndex, wanted: np.ndarray) -> np.ndarray:
    """Documents that hold each of the sorted ``wanted`` terms; reads only the term lists of the index."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for terms, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at = _lists_of(np.frombuffer(terms, np.uint64), wanted)
                total += np.where(at >= 0, np.diff(np.frombuffer(first, "<i4"), append=0)[at], 0)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["place", "df"])

    found = np.zeros(len(wanted), np.int64)
    sums = index.blocks.select("terms", "first").mapInArrow(counted, "place long, df long").groupBy("place").agg(F.sum("df"))
    for place, df in sums.collect():  # one number per term of a bounded slice of queries
        found[place] = df
    return found


@dataclass
class Plan:
    """A slice of queries for the tasks: its terms, their weights, and each query as terms in order of weight."""

    terms: np.ndarray  # sorted hashes
    weights: np.ndarray
    pairs: np.ndarray  # places of the two terms of each pair
    queries: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # places of terms, repeats, pair of each two terms in turn


def plan_queries(index: SearchIndex, texts: list[str | None]) -> Plan:
    """Weights from document frequencies, and the pairs: neighbours in a query's order of weight times repeats."""
    counters = [query_terms(t) for t in texts]
    names = sorted(set().union(*counters)) if counters else []
    hashes = term_hashes(names)
    order = np.argsort(hashes)
    terms = hashes[order]
    place = {names[j]: i for i, j in enumerate(order.tolist())}
    df = document_frequencies(index, terms)
    weights = np.array([
        math.floor(WEIGHT_SCALE * math.log((2 * index.n_docs + 2) / (2 * int(d) + 1))) if d else 0 for d in df
    ], np.int64)
    numbers: dict[tuple[int, int], int] = {}
    queries = []
    for counter in counters:
        at = np.array([place[t] for t in counter], np.int64)
        repeats = np.array(list(counter.values()), np.int64)
        order = np.lexsort((at, weights[at] * repeats)) if len(at) else np.zeros(0, np.int64)
        at, repeats = at[order], repeats[order]
        keys = [(int(a), int(b), int(x), int(y)) for a, b, x, y in zip(at[::2], at[1::2], repeats[::2], repeats[1::2])]
        queries.append((at, repeats, np.array([numbers.setdefault(k, len(numbers)) for k in keys], np.int64)))
    return Plan(terms, weights, np.array(list(numbers), np.int64).reshape(-1, 4), queries)


class Lists:
    """The posting lists of a plan's terms in one block: documents and impacts, one term after the other."""

    def __init__(self, size: int, begin: np.ndarray, doc: np.ndarray, impact: np.ndarray):
        self.size, self.begin, self.doc, self.impact = size, begin.tolist(), doc, impact
        filled = np.flatnonzero(np.diff(begin))
        self.best = np.zeros(len(begin) - 1, np.int64)
        if len(filled):
            self.best[filled] = np.maximum.reduceat(impact, begin[filled])

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.begin[term], self.begin[term + 1])
        return self.doc[part], self.impact[part]


def impact_lists(row: dict, plan: Plan, n_docs: int, n_words: int) -> Lists:
    """Impacts of the plan's terms in a row of the index."""
    terms = np.frombuffer(row["terms"], np.uint64)
    first, doc, tf = (np.frombuffer(row[c], "<i4").astype(np.int64) for c in ("first", "doc", "tf"))
    words = np.frombuffer(row["words"], "<i8")
    norm = 100 - LENGTH_PERCENT + LENGTH_PERCENT * words * n_docs // max(n_words, 1)
    at = _lists_of(terms, plan.terms)
    counts = np.where(at >= 0, np.diff(first, append=0)[at], 0)
    begin = np.concatenate([[0], np.cumsum(counts)])
    use = np.repeat(np.where(at >= 0, first[at], 0) - begin[:-1], counts) + np.arange(begin[-1])
    doc, tf = doc[use], tf[use]
    impact = np.repeat(plan.weights, counts) * (IMPACT_SCALE * tf // (TF_SCALE * tf + LENGTH_SCALE * norm[doc]))
    return Lists(len(words), begin, doc, impact)


def pair_lists(lists: Lists, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each pair of terms: documents of the block that hold both, and the largest joint impact among them.

    Returns the documents one pair after the other, the borders between pairs and the joint maxima.
    """
    spot = np.full(lists.size, -1, np.int64)
    shared, counts, joint = [np.zeros(0, np.int64)], [0], np.zeros(len(pairs), np.int64)
    for p, (a, b, x, y) in enumerate(pairs.tolist()):
        doc_a, impact_a = lists.of(a)
        doc_b, impact_b = lists.of(b)
        spot[doc_a] = np.arange(len(doc_a))
        both = spot[doc_b] >= 0
        joint[p] = (x * impact_a[spot[doc_b[both]]] + y * impact_b[both]).max(initial=0)
        spot[doc_a] = -1
        shared.append(doc_b[both])
        counts.append(len(shared[-1]))
    return np.concatenate(shared), np.cumsum(counts, dtype=np.int64), joint


def _prepared(plan, n_docs: int, n_words: int):
    """The index as the plan's queries need it: impact lists of their terms and intersection lists of their pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = plan.value
        for batch in batches:
            for r, row in enumerate(batch.drop_columns(["ids"]).to_pylist()):
                lists = impact_lists(row, chosen, n_docs, n_words)
                shared, borders, joint = pair_lists(lists, chosen.pairs)
                packed = [np.array(lists.begin, "<i8"), lists.doc.astype("<i4"), lists.impact.astype("<i8"),
                          shared.astype("<i4"), borders.astype("<i8"), joint.astype("<i8")]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids").slice(r, 1), pa.array([row["block"]]), pa.array([lists.size])]
                    + [pa.array([x.tobytes()], pa.binary()) for x in packed],
                    ["ids", *PREPARED],
                )

    return run


PREPARED = ("block", "size", "begin", "doc", "impact", "shared", "borders", "joint")


def search_block(lists: Lists, query: tuple, pairs: tuple, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a block (places) and scores of one query: all that can be among its ``k`` best and reach ``least``.

    Terms come in pairs, in order of weight. What a pair can add to a document is at most the largest of both maxima and
    of the joint maximum of documents that hold both, which is less than the sum of the maxima. The longest run of light
    pairs whose bounds stay below ``least`` is not essential: a document that holds no other term cannot reach ``least``.
    Documents of the other lists are scored; those that cannot reach it with the bounds of the light pairs go. A document
    outside a pair's intersection list is bounded by the larger maximum alone. For the rest, light lists are added.
    """
    terms, repeats, numbers = query
    shared, borders, joint = pairs
    best = repeats * lists.best[terms]
    groups = [(2 * i, 2 * i + 2) for i in range(len(terms) // 2)] + [(len(terms) - 1, len(terms))] * (len(terms) % 2)
    single = np.array([best[a:b].max() for a, b in groups], np.int64)
    bound = single.copy()
    bound[:len(numbers)] = np.maximum(single[:len(numbers)], joint[numbers])
    light = int(np.searchsorted(np.cumsum(bound), least)) if least > 0 else 0
    score = np.zeros(lists.size, np.int64)
    for a, b in groups[light:]:
        for i in range(a, b):
            doc, impact = lists.of(terms[i])
            score[doc] += repeats[i] * impact
    found = np.flatnonzero(score)
    if light:
        found = found[score[found] + bound[:light].sum() >= least]
        inside = np.zeros(lists.size, bool)
        rest = np.zeros(len(found), np.int64)
        for g in range(light):
            if g < len(numbers) and bound[g] > single[g]:
                mine = shared[borders[numbers[g]]:borders[numbers[g] + 1]]
                inside[mine] = True
                rest += np.where(inside[found], bound[g], single[g])
                inside[mine] = False
            else:
                rest += single[g]
        found = found[score[found] + rest >= least]
        wanted = np.zeros(lists.size, bool)
        wanted[found] = True
        for i in range(groups[light - 1][1]):
            doc, impact = lists.of(terms[i])
            use = wanted[doc]
            score[doc[use]] += repeats[i] * impact[use]
    if len(found) > k:
        cut = -np.partition(-score[found], k - 1)[k - 1]
        least = max(least, int(cut))
    found = found[score[found] >= max(least, 1)]
    return found, score[found]


def _searched(plan, thresholds: np.ndarray, k: int):
    """The best documents of each query among the blocks of a task. Thresholds rise from block to block."""
    def best_of(names: list, scores: np.ndarray) -> tuple[list, np.ndarray]:
        order = sorted(range(len(names)), key=lambda i: (
            -scores[i], names[i] is None, 0 if names[i] is None else names[i]
        ))[:k]
        return [names[i] for i in order], scores[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, least = plan.value.queries, thresholds.copy()
        kept: dict[int, tuple[list, np.ndarray]] = {}
        kind = None
        for batch in batches:
            kind = batch.schema.field("ids").type.value_type
            for r, row in enumerate(batch.drop_columns(["ids"]).to_pylist()):
                begin, impact, borders, joint = (np.frombuffer(row[c], "<i8") for c in ("begin", "impact", "borders", "joint"))
                doc, shared = (np.frombuffer(row[c], "<i4") for c in ("doc", "shared"))
                lists, own = Lists(row["size"], begin, doc, impact), batch.column("ids")[r].values
                for q, query in enumerate(queries):
                    found, score = search_block(lists, query, (shared, borders, joint), k, int(least[q]))
                    if len(found):
                        names, scores = kept.get(q, ([], np.zeros(0, np.int64)))
                        names, scores = kept[q] = best_of(
                            names + own.take(pa.array(found)).to_pylist(), np.concatenate([scores, score])
                        )
                        if len(names) == k:
                            least[q] = max(least[q], scores[-1])
        if kept:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(list(kept), [len(names) for names, _ in kept.values()])),
                 pa.array([n for names, _ in kept.values() for n in names], kind),
                 pa.array(np.concatenate([scores for _, scores in kept.values()]))],
                ["query", "row", "score"],
            )

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("row"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_slice(index: SearchIndex, texts: list[str | None], k: int, first_share: float) -> DataFrame:
    spark = index.blocks.sparkSession
    plan = spark.sparkContext.broadcast(plan_queries(index, texts))
    schema = T.StructType([T.StructField("ids", T.ArrayType(index.id_type))] + [
        T.StructField(c, T.LongType() if c in ("block", "size") else T.BinaryType()) for c in PREPARED
    ])
    blocks = materialise(index.blocks.mapInArrow(_prepared(plan, index.n_docs, index.n_words), schema), "pair-index")
    result = T.StructType([
        T.StructField("query", T.LongType()), T.StructField("row", index.id_type), T.StructField("score", T.LongType())
    ])
    early = hash_share("block", seed=13) < first_share
    thresholds = np.zeros(len(texts), np.int64)
    first = materialise(_ranked(blocks.where(early).mapInArrow(_searched(plan, thresholds, k), result), k), "first-ranks")
    for query, score in first.where(F.col("rank") == k).select("query", "score").collect():  # one row a query of the slice
        thresholds[query] = score
    rest = blocks.where(~early).mapInArrow(_searched(plan, thresholds, k), result)
    return _ranked(first.drop("rank").unionByName(rest), k)


def search(
    index: SearchIndex,
    queries: DataFrame,
    k: int = 20,
    query_id: str = "item_id",
    text: str = "text",
    doc_id: str = "doc_id",
    at_once: int = QUERIES_AT_ONCE,
    first_share: float = FIRST_SHARE,
) -> DataFrame:
    """``query_id, rank, doc_id, score``: the ``k`` best documents with a score above 0 for each row of ``queries``.

    A term weighs floor(1000 ln((2 N + 2) / (2 df + 1))); its impact on a document is the weight times
    10**9 tf div (1000 tf + 12 m), with m = 75 + 25 n N div L, in integers; a score sums impacts, repeats in the query
    included. Equal scores are ranked by ascending id, null ids last. Repeated document rows are ranked each by itself,
    and so are repeated query rows. A query without terms, or without a document, has no rows.

    Queries meet the index in slices of ``at_once``. For a slice, the impact lists of its terms and the intersection lists
    of its term pairs with their joint maxima are computed once and written. A share of the blocks is searched first; the
    k-th best score so far is the threshold with which all other blocks start. It never exceeds the final one, so
    skipping is safe and the result exact.
    """
    spark = index.blocks.sparkSession
    named = queries.select(F.col(query_id).alias("id"), F.col(text).cast("string").alias("text"))
    id_field = named.schema["id"].dataType
    found = []
    asked = iter(named.toLocalIterator())
    while part := list(islice(asked, at_once)):
        ids = spark.createDataFrame(
            [(q, row["id"]) for q, row in enumerate(part)],
            T.StructType([T.StructField("query", T.LongType()), T.StructField(query_id, id_field)]),
        )
        best = _search_slice(index, [row["text"] for row in part], k, first_share)
        found.append(best.join(F.broadcast(ids), "query").select(
            query_id, "rank", F.col("row").alias(doc_id), "score"
        ))
    if not found:
        empty = T.StructType([
            T.StructField(query_id, id_field), T.StructField("rank", T.IntegerType()),
            T.StructField(doc_id, index.id_type), T.StructField("score", T.LongType()),
        ])
        return spark.createDataFrame([], empty)
    return reduce(DataFrame.unionByName, found)
