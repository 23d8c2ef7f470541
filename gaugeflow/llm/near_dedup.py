"""Near-duplicate classes by HyperMinHash: compressed registers, banding, estimate, exact confirmation, components."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.llm.components import connected_components
from gaugeflow.llm.kernels import BYTE_BASE, WORD_BASE, Powers, Words, lower_table, pieces, space_class
from gaugeflow.storage import free, materialise

#: 128 registers of 16 bits: 6 for the leading zeros plus one, 10 for the mantissa. Four make a band, so a pair at the
#: threshold of 0.8 shares no band with probability (1 - 0.8**4)**32, about 5 in 10**8.
REGISTERS, MANTISSA_BITS, BAND = 128, 10, 4
#: The estimate has a standard deviation of 0.035 at 0.8. Pairs within four of these below the threshold are confirmed.
MARGIN = 4.0
#: Members of a bucket that are compared in one task; larger buckets are split, see ``_across``.
BLOCK = 4096
#: Pairs whose indexes a task holds before it judges them.
PAIRS_AT_ONCE = 1 << 19
#: Shingles of a cell, in which full sets meet for the last comparisons: 16 MB.
CELL_SHINGLES = 1 << 21
#: Most rounds in which the members of large buckets outside their largest component are compared with new leaders, and
#: the leaders of a round.
STAR_ROUNDS, LEADERS = 4, 4


def _sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct hashes of the shingles of each text."""
    is_word, lower = space_class(), lower_table()
    byte_powers, word_powers = Powers(BYTE_BASE), Powers(WORD_BASE)
    for _, data, offsets in pieces(column):
        words = Words(lower[data], offsets, is_word, byte_powers)
        counts = np.diff(words.first)
        grams, _ = words.grams(size, word_powers)
        borders = np.concatenate([[0], np.cumsum(np.maximum(counts - size + 1, 0))])
        for i, count in enumerate(counts.tolist()):
            if count >= size:
                yield np.unique(grams[borders[i]:borders[i + 1]])
            elif count:
                whole = hashlib.blake2b(words.hash[words.first[i]:words.first[i + 1]].tobytes(), digest_size=8)
                yield np.frombuffer(whole.digest(), np.uint64)
            else:
                yield np.zeros(0, np.uint64)


def registers(minima: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """Leading zeros and mantissa of the smallest hash of each bucket; 0 is an empty bucket."""
    part = (minima << np.uint64(7)) >> np.uint64(11)  # 53 bits, exact as a float
    fraction, exponent = np.frexp(part.astype(np.float64))
    mantissa = np.clip((fraction * 2 - 1) * (1 << MANTISSA_BITS), 0, (1 << MANTISSA_BITS) - 1).astype(np.uint16)
    zeros = (53 - exponent).astype(np.uint16)
    return np.where(filled, ((zeros + 1) << MANTISSA_BITS) | mantissa, 0).astype(np.uint16)


def _profiles(size: int):
    edges = np.arange(REGISTERS, dtype=np.uint64) << np.uint64(57)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, minima, filled = [], [], [], []
            for found in _sets(batch.column(1), size):
                counts.append(len(found))
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                if len(found):
                    at = np.minimum(np.searchsorted(found, edges), len(found) - 1)
                    minima.append(found[at])
                    filled.append((found[at] >> np.uint64(57)) == np.arange(REGISTERS, dtype=np.uint64))
                else:
                    minima.append(np.zeros(REGISTERS, np.uint64))
                    filled.append(np.zeros(REGISTERS, bool))
            if not counts:
                continue
            bands = registers(np.stack(minima), np.stack(filled)).view("<i8").ravel()
            offsets = np.arange(len(counts) + 1, dtype=np.int32) * (REGISTERS // BAND)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands))],
                ["row", "n", "digest", "bands"],
            )

    return run


def shingle_profiles(docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """``row`` (the id), ``n`` shingles, ``digest`` of the set, ``bands``: four registers in each of 32 longs."""
    rows = docs.select(F.col(doc_id).alias("row"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_profiles(size), T.StructType([
        T.StructField("row", rows.schema["row"].dataType), T.StructField("n", T.LongType()),
        T.StructField("digest", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType())),
    ]))


def collision_table() -> np.ndarray:
    """Chance that two unrelated buckets hold the same register, by log2 of their loads in half steps from 2**-8."""
    loads = 2.0 ** np.arange(-8, 24, 0.5)
    zeros = np.arange(53)[:, None]
    start = (1 + np.arange(1 << MANTISSA_BITS) / (1 << MANTISSA_BITS)) / 2.0 ** (zeros + 1)
    width = np.broadcast_to(2.0 ** -(zeros + 1.0 + MANTISSA_BITS), start.shape)
    start, width = start.ravel(), width.ravel()
    cells = np.exp(-loads[:, None] * start) * -np.expm1(-loads[:, None] * width)
    return cells @ cells.T


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, chances: np.ndarray) -> np.ndarray:
    """Jaccard similarity from register rows, less the matches expected from collisions of unrelated buckets."""
    same = ((a == b) & (a != 0)).sum(-1)
    used = np.maximum(((a | b) != 0).sum(-1), 1)
    place = [np.clip(np.round(2 * np.log2(np.maximum(n, 1) / REGISTERS) + 16), 0, len(chances) - 1).astype(int)
             for n in (n_a, n_b)]
    chance = chances[place[0], place[1]]
    return (same - chance * (used - same)) / used


def _threshold(similarity: float) -> float:
    return similarity - MARGIN * (similarity * (1 - similarity) / REGISTERS) ** 0.5


def _wide(bands: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(x, "<i8") for x in bands]).view(np.uint16)


def promising(pairs: DataFrame, reps: DataFrame, similarity: float) -> DataFrame:
    """Pairs ``a, b`` whose estimated similarity may reach the threshold."""
    chances, least = collision_table(), _threshold(similarity)

    @F.pandas_udf(T.BooleanType())
    def close(a: pd.Series, b: pd.Series, n_a: pd.Series, n_b: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype=bool)
        return pd.Series(estimate(_wide(a), _wide(b), n_a.to_numpy(), n_b.to_numpy(), chances) >= least)

    side = {s: reps.select(F.col("rep").alias(s), F.col("bands").alias(f"bands_{s}"), F.col("n").alias(f"n_{s}"))
            for s in "ab"}
    sized = pairs.join(side["a"], "a").join(side["b"], "b").where(
        F.least("n_a", "n_b") >= F.lit(similarity) * F.greatest("n_a", "n_b") - 1e-9
    )
    return sized.where(close("bands_a", "bands_b", "n_a", "n_b")).select("a", "b")


def full_sets(needed: DataFrame, reps: DataFrame, docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """``rep, shingles``: the full sets of the representatives in ``needed(rep)``, made anew from their texts alone."""
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(_sets(batch.column(2), size))
            if not sets:
                continue
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            keep = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() == d
                    for s, d in zip(sets, batch.column(1).to_pylist())]
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets).view("<i8")))],
                ["rep", "shingles"],
            )
            yield out.filter(pa.array(keep, pa.bool_()))

    wanted = needed.select("rep").distinct().join(reps.select("rep", "digest", "row"), "rep")
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    return wanted.join(texts, F.col("row").eqNullSafe(F.col("id"))).select("rep", "digest", "text").mapInArrow(
        made, "rep long, shingles array<long>"
    )


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of ``pairs(a, b)`` those with 100 * intersection >= percent * union, as ``u, v``. A pair carries one set."""
    one = pairs.join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("of_b")), "b")
    both = one.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("of_a")), "a")
    common = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - common
    return both.where(100 * common >= percent * union).select(F.col("a").alias("u"), F.col("b").alias("v")).distinct()


def _judged_cell(percent: int):
    """Links between the members of a cell: each set is marked once and all its partners are counted against it."""

    def run(lists: pa.Table, sets: pa.Table) -> pa.Table:
        found_u, found_v = [], []
        if lists.num_rows and sets.num_rows:
            shingles = sets["shingles"].combine_chunks()
            values, place = np.unique(shingles.flatten().to_numpy(), return_inverse=True)
            sizes = shingles.value_lengths().to_numpy().astype(np.int64)
            stops = np.cumsum(sizes)
            where = {rep: i for i, rep in enumerate(sets["rep"].to_pylist())}
            mark = np.zeros(len(values), np.int64)
            for rep, partners in zip(lists["rep"].to_pylist(), lists["partners"].to_pylist()):
                i = where[rep]
                own = place[stops[i] - sizes[i]:stops[i]]
                mark[own] = 1
                others = np.array([where[p] for p in partners])
                common = np.array([mark[place[stops[j] - sizes[j]:stops[j]]].sum() for j in others])
                mark[own] = 0
                for j in np.flatnonzero(100 * common >= percent * (sizes[i] + sizes[others] - common)).tolist():
                    found_u.append(rep)
                    found_v.append(partners[j])
        return pa.table({"u": pa.array(found_u, pa.int64()), "v": pa.array(found_v, pa.int64())})

    return run


def confirmed_in_cells(lists: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The same for partner lists, which are never expanded: sets meet in cells of a bounded number of members."""
    sent = lists.select(
        F.col("low").alias("low_cell"), F.col("high").alias("high_cell"), F.col("rep").alias("member")
    ).distinct().join(sets, F.col("member") == F.col("rep")).select(
        "low_cell", "high_cell", F.col("member").alias("rep"), "shingles"
    ).groupBy("low_cell", "high_cell")
    return lists.where(F.size("partners") > 0).groupBy("low", "high").cogroup(sent).applyInArrow(
        _judged_cell(percent), "u long, v long"
    )


def _cross_pairs(similarity: float, best_only: bool):
    """Pairs of different components within each bucket block; rows come sorted by bucket, some buckets per batch.

    A pair is looked at in the first band that it shares only. With ``best_only`` each row names its best partner alone.
    """
    chances, least = collision_table(), _threshold(similarity)
    bucket, numbers = ("band", "value", "low", "high"), ("block", "rep", "label", "n", "cell")
    triangles: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def judged(rows: dict, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
        found, values = [np.zeros((0, 2), np.int64)], [np.zeros(0)]
        for at in range(0, len(i), 1 << 15):
            a, b = i[at:at + (1 << 15)], j[at:at + (1 << 15)]
            value = estimate(rows["regs"][a], rows["regs"][b], rows["n"][a], rows["n"][b], chances)
            near = value >= least
            a, b, value = a[near], b[near], value[near]
            bands_a, bands_b = (rows["regs"][x].view(np.int64) for x in (a, b))
            first = ((bands_a == bands_b) & (bands_a != 0)).argmax(1) == rows["band"][a]
            found.append(np.stack([a[first], b[first]], 1))
            values.append(value[first])
        pairs, values = np.concatenate(found), np.concatenate(values)
        if best_only:
            rows_of = np.concatenate([pairs[:, 0], pairs[:, 1]])
            order = np.lexsort((-np.concatenate([values, values]), rows_of))
            heads = np.flatnonzero(np.diff(rows_of[order], prepend=-1))
            pairs = pairs[np.unique(order[heads] % max(len(pairs), 1))]
        return packed(rows["rep"][pairs], rows["cell"][pairs])

    def packed(pairs: np.ndarray, cells: np.ndarray) -> pa.RecordBatch:
        """Each member with its partners in one cell, and each partner by itself without any."""
        swap = (cells[:, 0] > cells[:, 1]) | ((cells[:, 0] == cells[:, 1]) & (pairs[:, 0] > pairs[:, 1]))
        pairs[swap], cells[swap] = pairs[swap][:, ::-1], cells[swap][:, ::-1]
        order = np.lexsort((pairs[:, 1], pairs[:, 0], cells[:, 1], cells[:, 0]))
        pairs, cells = pairs[order], cells[order]
        heads = np.flatnonzero(np.append(
            np.full(min(len(pairs), 1), True),
            (pairs[1:, 0] != pairs[:-1, 0]) | (cells[1:] != cells[:-1]).any(1),
        ))
        alone = np.unique(np.column_stack([cells, pairs[:, 1]]), axis=0)
        offsets = np.concatenate([heads, np.full(len(alone) + 1, len(pairs))]).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([cells[heads, 0], alone[:, 0]])), pa.array(np.concatenate([cells[heads, 1], alone[:, 1]])),
             pa.array(np.concatenate([pairs[heads, 0], alone[:, 2]])),
             pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(pairs[:, 1])))],
            ["low", "high", "rep", "partners"],
        )

    def met(rows: dict, a: int, b: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of rows a to b that a block is there for, some members outside the largest component at a time."""
        if rows["low"][a] == rows["high"][a]:
            if b - a <= 64:
                if b - a not in triangles:
                    triangles[b - a] = np.triu_indices(b - a, 1)
                yield triangles[b - a]
                return
            _, label, count = np.unique(rows["label"][a:b], return_inverse=True, return_counts=True)
            most = label == count.argmax()
            left = np.flatnonzero(~most)
            right = np.concatenate([left, np.flatnonzero(most)])
            later = np.arange(1, len(left) + 1)  # pairs among the rest once only
        else:
            low = rows["block"][a:b] == rows["low"][a]
            left, right = np.flatnonzero(~low), np.flatnonzero(low)
            later = np.zeros(len(left), int)
        step = max(1, PAIRS_AT_ONCE // max(len(right), 1))
        for at in range(0, len(left), step):
            i, j = np.meshgrid(np.arange(at, min(at + step, len(left))), np.arange(len(right)), indexing="ij")
            use = j >= later[i]
            yield left[i[use]], right[j[use]]

    def compared(rows: dict, starts: np.ndarray, stops: np.ndarray) -> Iterator[pa.RecordBatch]:
        mixed = np.minimum.reduceat(rows["label"], starts) != np.maximum.reduceat(rows["label"], starts)
        left, right, waiting = [], [], 0
        for a, b in zip(starts[mixed].tolist(), stops[mixed].tolist()):
            for i, j in met(rows, a, b):
                i, j = i + a, j + a
                smaller, larger = np.minimum(rows["n"][i], rows["n"][j]), np.maximum(rows["n"][i], rows["n"][j])
                use = (rows["label"][i] != rows["label"][j]) & (smaller >= similarity * larger - 1e-9)
                left.append(i[use])
                right.append(j[use])
                waiting += len(left[-1])
                if waiting > PAIRS_AT_ONCE:
                    yield judged(rows, np.concatenate(left), np.concatenate(right))
                    left, right, waiting = [], [], 0
        if waiting:
            yield judged(rows, np.concatenate(left), np.concatenate(right))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {c: batch.column(c).to_numpy() for c in bucket + numbers}
            rows["regs"] = batch.column("bands").flatten().to_numpy().view(np.uint16).reshape(-1, REGISTERS)
            if held:
                rows = {c: np.concatenate([held[c], rows[c]]) for c in rows}
            keys = np.stack([rows[c] for c in bucket], 1)
            starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(1)))
            if len(starts) > 1:
                yield from compared(rows, starts[:-1], starts[1:])
            held = {c: v[starts[-1]:] for c, v in rows.items()}
        if held:
            yield from compared(held, np.zeros(1, int), np.array([len(held["rep"])]))

    return run


def _joined(labels: DataFrame, more: DataFrame) -> DataFrame:
    """Components after further links; those known so far are contracted to one edge a node."""
    known = labels.select(F.col("node").alias("u"), F.col("root").alias("v")).where("u != v")
    return materialise(connected_components(known.unionByName(more)), "labels")


def _mixed(crowded: DataFrame, labels: DataFrame) -> DataFrame:
    """Members ``band, value, rep, label, main, m, c`` of the buckets that still hold several components.

    ``main`` tells the ``c`` members of the bucket's largest component from the rest of its ``m`` members. Buckets of three
    members or less have been judged whole.
    """
    labelled = crowded.where("m > 3").join(labels, crowded["rep"] == labels["node"], "left").select(
        "band", "value", "rep", F.coalesce("root", "rep").alias("label")
    )
    parts = labelled.groupBy("band", "value", "label").agg(F.count("*").alias("c"))
    mixed = parts.groupBy("band", "value").agg(
        F.max(F.struct("c", "label")).alias("most"), F.sum("c").alias("m"), F.count("*").alias("parts")
    ).where("parts > 1").select("band", "value", "m", F.col("most.c").alias("c"), F.col("most.label").alias("most"))
    return labelled.join(materialise(mixed, "mixed"), ["band", "value"]).withColumn("main", F.col("label") == F.col("most"))


def _led(inside: DataFrame, turn: int) -> DataFrame:
    """Pairs ``a, b`` of each member outside the largest component with new leaders, half of them inside it."""
    leaders = [
        F.min_by(F.when(F.col("main") == half, F.col("rep")), F.when(F.col("main") == half, F.xxhash64("rep", F.lit(turn), F.lit(i))))
        for i in range(LEADERS // 2) for half in (True, False)
    ]
    chosen = inside.groupBy("band", "value").agg(F.array(*leaders).alias("leaders"))
    return inside.where("NOT main").join(chosen, ["band", "value"]).select(
        "rep", F.explode("leaders").alias("other")
    ).where("rep != other").select(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b")).distinct()


def dealt(inside: DataFrame, block: int) -> DataFrame:
    """``inside`` with the ``block`` of each member and one row per pair of blocks, ``low`` and ``high``, that it visits.

    A bucket of up to ``block`` members is compared in one place. In a larger one the members of the largest component,
    which need not be compared with each other, go to a block each, and only the rest visits all of these blocks.
    """
    blocks, rest_blocks = F.ceil(F.col("c") / block), F.ceil((F.col("m") - F.col("c")) / block)
    own = F.when(F.col("m") <= block, F.lit(0)).when(
        F.col("main"), -1 - F.pmod(F.xxhash64("rep"), blocks)
    ).otherwise(F.pmod(F.xxhash64("rep"), rest_blocks))
    place = F.struct(F.col("block").alias("low"), F.col("block").alias("high"))
    to_rest = F.transform(F.sequence(F.lit(0).cast("long"), rest_blocks - 1), lambda r: F.struct(
        F.least("block", r).alias("low"), F.greatest("block", r).alias("high")
    ))
    to_main = F.transform(F.sequence(F.lit(1).cast("long"), blocks), lambda x: F.struct(
        (-x).alias("low"), F.col("block").alias("high")
    ))
    return inside.withColumn("block", own.cast("long")).select("*", F.inline(
        F.when(F.col("m") <= block, F.array(place)).when(F.col("main"), to_rest).otherwise(F.concat(to_main, to_rest))
    ))


def _across(inside: DataFrame, reps: DataFrame, similarity: float, best_only: bool, block: int) -> DataFrame:
    """Promising partners in different components, from buckets where not all pairs have been judged yet.

    ``low, high, rep, partners``: members are dealt to cells by hash; low and high are the cells of both sides.
    """
    sizes = inside.select("rep").distinct().join(reps.select("rep", "n"), "rep").agg(F.sum("n")).first()[0]
    cells = math.ceil((sizes or 1) / CELL_SHINGLES)
    sent = dealt(inside, block).join(reps.select("rep", "n", "bands"), "rep").select(
        F.col("band").cast("long").alias("band"), "value", "low", "high", "block", "rep", "label", "n", "bands",
        F.pmod(F.xxhash64("rep"), F.lit(cells)).alias("cell"),
    )
    key = ["band", "value", "low", "high"]
    return sent.repartition(*key).sortWithinPartitions(*key).mapInArrow(
        _cross_pairs(similarity, best_only), "low long, high long, rep long, partners array<long>"
    )


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = 5,
    percent: int = 80,
    block: int = BLOCK,
) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``.

    A document is the set of its distinct shingles of ``shingle`` words (A-Z lower-cased, blanks separate words); a
    shorter one has its whole word sequence as single shingle; a null, empty or blank one has none and is its own class.
    Two documents are linked when 100 * intersection >= percent * union; ``component_id`` is the smallest id reachable.
    A null id is never the smallest unless a class has no other. Extra columns are not read.

    1. HyperMinHash registers of each set; equal sets become one representative, so copies cost nothing more.
    2. Bands of four registers name buckets. Each member is compared with three members of its bucket only; estimates
       first, then full sets; confirmed links give components.
    3. In buckets of more than ``block`` members, those outside the bucket's largest component are compared with new
       leaders, round by round, as long as this joins some and more than a few are left.
    4. Buckets that still hold several components are compared across components, in blocks; only members outside the
       largest component visit all blocks of it. First each member's best partner is confirmed, which
       joins most of what belongs together; then all pairs with a promising estimate that still lie across components.
       Partners travel as lists, one row a member, and are judged on full sets where these meet in cells of bounded size.
       So every pair that shares a bucket is either connected already or has been judged, and no group is expanded
       into all its pairs. What is sent grows with the members, plus the product of the rest and the blocks of a bucket.
    """
    similarity = percent / 100
    profiles = materialise(shingle_profiles(docs, doc_id, text, shingle), "profiles")
    reps = profiles.where("n > 0").groupBy("digest").agg(
        F.min("row").alias("row"), F.first("n").alias("n"), F.first("bands").alias("bands")
    )
    reps = materialise(reps.withColumn("rep", F.monotonically_increasing_id()), "representatives")
    members = reps.select("rep", F.posexplode("bands").alias("band", "value")).where("value != 0")
    shuffled_rep = F.xxhash64("rep")
    buckets = members.groupBy("band", "value").agg(
        F.count("*").alias("m"), F.min("rep").alias("l1"), F.max("rep").alias("l2"),
        F.min_by("rep", shuffled_rep).alias("l3"),
    ).where("m > 1")
    crowded = materialise(members.join(buckets, ["band", "value"]), "buckets")
    stars = crowded.select("rep", F.explode(F.array("l1", "l2", "l3")).alias("other")).where("rep != other").select(
        F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b")
    ).distinct()
    pairs = materialise(promising(stars, reps, similarity), "pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("rep"))
    sets = materialise(full_sets(ends, reps, docs, doc_id, text, shingle), "sets")
    links = materialise(confirmed(pairs, sets, percent), "links")
    labels = materialise(connected_components(links), "labels")
    free(sets)
    for turn in range(STAR_ROUNDS):
        large = materialise(_mixed(crowded.where(F.col("m") > block), labels), "large-buckets")
        visits = large.agg(F.count("*"), F.sum(F.when(~F.col("main"), F.ceil(F.col("m") / block)))).first()
        if (visits[1] or 0) <= visits[0] / 4:
            break
        pairs = materialise(promising(_led(large, turn), reps, similarity), "pairs")
        sets = full_sets(pairs.select(F.explode(F.array("a", "b")).alias("rep")), reps, docs, doc_id, text, shingle)
        more = materialise(confirmed(pairs, sets, percent), "links")
        found = more.join(labels.select(F.col("node").alias("u"), F.col("root").alias("root_u")), "u", "left").join(
            labels.select(F.col("node").alias("v"), F.col("root").alias("root_v")), "v", "left"
        ).where(F.coalesce("root_u", "u") != F.coalesce("root_v", "v")).limit(1).count()
        if not found:
            break
        labels = _joined(labels, more)
    for best_only in (True, False):
        inside = materialise(_mixed(crowded, labels), "inside")
        if not inside.limit(1).count():
            break
        lists = materialise(_across(inside, reps, similarity, best_only, block), "partners")
        sets = full_sets(lists, reps, docs, doc_id, text, shingle)
        more = materialise(confirmed_in_cells(lists, sets, percent), "links")
        labels = _joined(labels, more)
        free(lists)
        free(inside)
    free(crowded)

    known = reps.select("rep", "digest", "row").join(labels, reps["rep"] == labels["node"], "left").withColumn(
        "root", F.coalesce("root", "rep")
    )
    least = known.groupBy("root").agg(F.min("row").alias("component_id"))
    classes = known.join(least, "root").select(F.col("digest").alias("set_digest"), "component_id")
    filled = profiles.where("n > 0").join(classes, F.col("digest") == F.col("set_digest"))
    empty = profiles.where("n = 0").withColumn("component_id", F.col("row"))  # all of one digest, so they are kept apart
    columns = [F.col("row").alias(doc_id), F.col("n").alias("n_shingles"), "component_id", "digest"]
    return filled.select(*columns).unionByName(empty.select(*columns)).withColumn(
        "kept", F.col(doc_id).eqNullSafe(F.col("component_id"))
    )


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5,
                         percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay, one document of each class, with all their columns. Ids have to be unique."""
    kept = near_duplicates(docs, doc_id, text, shingle, percent).where("kept").select(F.col(doc_id).alias("_kept_id"))
    return docs.join(kept, F.col(doc_id).eqNullSafe(F.col("_kept_id")), "left_semi")
