"""Growing the trees of a regression forest over packed rows, by the rules of Spark ML's forests.

Spark ML updates the statistics of one node for every row, tree, level and feature in object code, and that is where a fit
over a large table spends its time. Here a row is packed first: a feature is the number of its bin, and the bins of all
features lie side by side in a few 64-bit words. The packed table is written once. Trees are drawn independently of each
other, so each task takes some of them and reads the whole packed table: it keeps rows that belong to one node side by side
and gets the statistics of whole nodes by array operations. Nothing is shuffled and the driver sees only the grown nodes.

As in Spark ML a tree sees every row as often as a Poisson number tells, a node chooses among a random subset of the
features, the best split has the largest gain of variance with enough rows on both sides, and thresholds come from a sample
of the rows, in as many bins. Each batch of trees has thresholds and words of its own. Rows beyond ``ROWS_IN_MEMORY`` lie in mapped files of the task's own temporary folder, which go with it.
"""

from __future__ import annotations

import json
import math
import tempfile
import time
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.storage import free, materialise, new_path

#: Settings that the growth here knows; a fit with any other one is left to Spark ML.
KNOWN = {"numTrees", "maxDepth", "minInstancesPerNode", "featureSubsetStrategy", "bootstrap", "seed", "cacheNodeIds"}
#: Bins of a feature, as Spark ML's ``maxBins``, and rows whose values give the thresholds of a batch of trees, as there.
BINS, SAMPLE_ROWS = 32, 10_000
#: Rows that a task holds in memory (some 30 bytes each); more lie in mapped files.
ROWS_IN_MEMORY = 8_000_000
#: Rows of a node from which on it is treated alone, rows and nodes treated together, and cells of a joint count.
LARGE_NODE, GROUP_ROWS, GROUP_NODES, CHUNK_ROWS, JOINT_CELLS = 1024, 32_768, 256, 65_536, 4096
#: Variance below which Spark ML splits a node no further.
LEAST_VARIANCE = 2.0**-52
NODES = (
    "treeID int, id int, n double, s double, q double, gain double, leftChild int, rightChild int, feature int, threshold double"
)


def knows(settings: Mapping[str, object], rows: DataFrame) -> bool:
    """Whether a fit with these settings on ``rows(features, label)`` can grow here: no feature is categorical."""
    kinds = rows.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    return set(settings) <= KNOWN and not set(kinds) - {"numeric"}


def subset_size(strategy: str, features: int, trees: int) -> int:
    """Features that a node chooses among, by the names of Spark ML."""
    if strategy == "auto":
        strategy = "all" if trees == 1 else "onethird"
    named = {"all": features, "sqrt": math.ceil(math.sqrt(features)), "onethird": math.ceil(features / 3),
             "log2": max(1, math.ceil(math.log2(features)))}
    if strategy in named:
        return named[strategy]
    number = float(strategy)
    return min(features, int(number)) if str(strategy).isdigit() else math.ceil(number * features)


def thresholds(values: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Ends of the bins of one feature, midway between neighbouring values; bins hold about as many rows each."""
    found, counts = np.unique(values, return_counts=True)
    middles = (found[:-1] + found[1:]) / 2
    if len(middles) < bins:
        return middles
    stride, seen = len(values) / bins, np.cumsum(counts)
    ends, wanted = [], stride
    for i in range(1, len(found)):
        if abs(seen[i - 1] - wanted) < abs(seen[i] - wanted):
            ends.append(middles[i - 1])
            wanted += stride
    return np.array(ends[: bins - 1])


@dataclass
class Layout:
    """Thresholds of each feature, and the word, the shift and the mask of its bin."""

    ends: list[np.ndarray]
    word: np.ndarray
    shift: np.ndarray
    mask: np.ndarray
    words: int

    @classmethod
    def of(cls, ends: Sequence[np.ndarray]) -> Layout:
        bits = np.array([len(e).bit_length() for e in ends], np.int64)
        word, shift, at, used = np.zeros(len(ends), np.int64), np.zeros(len(ends), np.int64), 0, 0
        for i, b in enumerate(bits):
            if used + b > 63:  # words stay positive
                at, used = at + 1, 0
            word[i], shift[i] = at, used
            used += b
        return cls(list(ends), word, shift, (1 << bits) - 1, at + 1)

    def packed(self, x: np.ndarray) -> list[np.ndarray]:
        out = [np.zeros(len(x), np.int64) for _ in range(self.words)]
        for i, e in enumerate(self.ends):
            if len(e):
                out[self.word[i]] |= np.searchsorted(e, x[:, i], "left") << self.shift[i]
        return out


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), width)


def packed_rows(rows: DataFrame, layouts: Sequence[Layout]) -> DataFrame:
    """``y`` and the words of every row, those of batch k as ``w{k}_0``, ``w{k}_1`` and so on, written as a table."""
    names = [f"w{k}_{i}" for k, layout in enumerate(layouts) for i in range(layout.words)]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = _matrix(batch.column(0), len(layouts[0].ends)), batch.column(1)
            if y.null_count or not np.isfinite(y.to_numpy(zero_copy_only=False)).all() or not np.isfinite(x).all():
                raise ValueError("features and labels must not be null, NaN or infinite")
            words = [pa.array(w) for layout in layouts for w in layout.packed(x)]
            yield pa.RecordBatch.from_arrays([y, *words], ["y", *names])

    plain = rows.select(vector_to_array("features").alias("x"), F.col("label").cast("double").alias("label"))
    return materialise(plain.mapInArrow(pack, ", ".join(["y double", *[f"{n} bigint" for n in names]])), "packed")


class Room:
    """Arrays in memory, or in mapped files of a folder where they are too large for that."""

    def __init__(self, folder: str | None):
        self.folder = folder

    def array(self, n: int, kind) -> np.ndarray:
        if self.folder is None or not n:
            return np.empty(n, kind)
        with tempfile.TemporaryFile(dir=self.folder) as file:
            return np.memmap(file, kind, "w+", shape=(n,))


@dataclass
class Rule:
    """What a tree grows by."""

    layout: Layout
    depth: int
    least: int
    subset: int
    bootstrap: bool
    seed: int


class _Rows:
    """Rows of the nodes of one level that can be split, node by node: words, weighted target and weight."""

    def __init__(self, room: Room, words: int, n: int):
        self.words = [room.array(n, np.int64) for _ in range(words)]
        self.wy, self.w = room.array(n, np.float64), room.array(n, np.uint8)

    def move(self, at: int, where: np.ndarray) -> None:
        """Some rows go to a place before or among them; what lay there is overwritten."""
        for own in (*self.words, self.wy, self.w):
            own[at : at + len(where)] = own[where]

    def shift(self, at: int, a: int, b: int) -> None:
        """Rows from ``a`` to ``b`` go down to ``at``."""
        for own in (*self.words, self.wy, self.w) if at < a else ():
            for c in range(a, b, CHUNK_ROWS):
                n = min(CHUNK_ROWS, b - c)
                own[at + c - a : at + c - a + n] = own[c : c + n].copy()

    def part(self, a: int, side: np.ndarray) -> int:
        """Rows from ``a`` on with side 0 go before those with side 1, by exchange of those that stand wrong; their number."""
        lefts = len(side) - int(np.count_nonzero(side))
        ones, zeros = np.flatnonzero(side[:lefts]) + a, np.flatnonzero(side[lefts:] == 0) + a + lefts
        for c in range(0, len(ones), CHUNK_ROWS):
            one, zero = ones[c : c + CHUNK_ROWS], zeros[c : c + CHUNK_ROWS]
            for own in (*self.words, self.wy, self.w):
                own[one], own[zero] = own[zero], own[one]
        return lefts


def _drawn(room: Room, words: list[np.ndarray], y: np.ndarray, rule: Rule, rng) -> tuple[_Rows, int]:
    """The rows of a tree with their Poisson weights; rows that are drawn no time go."""
    rows, at = _Rows(room, len(words), len(y)), 0
    for a in range(0, len(y), CHUNK_ROWS):
        part = slice(a, min(a + CHUNK_ROWS, len(y)))
        n = part.stop - a
        times = np.minimum(rng.poisson(1.0, n), 255).astype(np.uint8) if rule.bootstrap else np.ones(n, np.uint8)
        kept = np.flatnonzero(times)
        for mine, theirs in zip(rows.words, words):
            mine[at : at + len(kept)] = theirs[part][kept]
        rows.w[at : at + len(kept)] = times[kept]
        rows.wy[at : at + len(kept)] = times[kept] * y[part][kept]
        at += len(kept)
    return rows, at


def _joint(fields: Sequence[int], sizes: np.ndarray) -> list[list[int]]:
    """Features whose bins are counted together, so that a count has few cells."""
    found: list[list[int]] = []
    cells = JOINT_CELLS + 1
    for j in sorted(fields, key=lambda j: sizes[j]):
        if cells * sizes[j] > JOINT_CELLS:
            found.append([])
            cells = 1
        found[-1].append(j)
        cells *= int(sizes[j])
    return found


def _large_counts(rows: _Rows, a: int, b: int, features: np.ndarray, layout: Layout) -> tuple[np.ndarray, np.ndarray]:
    """Rows and target sums by feature and bin of one large node."""
    sizes = layout.mask[features] + 1
    n, s = np.zeros((1, len(features), BINS)), np.zeros((1, len(features), BINS))
    for group in _joint(range(len(features)), sizes):
        shape = [int(sizes[j]) for j in group]
        cells = math.prod(shape)
        counts, sums = np.zeros(cells), np.zeros(cells)
        for at in range(a, b, CHUNK_ROWS):
            part = slice(at, min(at + CHUNK_ROWS, b))
            code = None
            for j, size in zip(group, shape):
                f = features[j]
                field = (rows.words[layout.word[f]][part] >> layout.shift[f]) & layout.mask[f]
                code = field if code is None else code * size + field
            counts += np.bincount(code, rows.w[part], cells)
            sums += np.bincount(code, rows.wy[part], cells)
        for place, j in enumerate(group):
            others = tuple(k for k in range(len(group)) if k != place)
            n[0, j, : shape[place]] = counts.reshape(shape).sum(others)
            s[0, j, : shape[place]] = sums.reshape(shape).sum(others)
    return n, s


def _fields(rows: _Rows, part: slice, slot: np.ndarray, features: np.ndarray, layout: Layout) -> np.ndarray:
    """The bin of each row for the feature of its node."""
    word = layout.word[features]
    if (word == word[0]).all():
        value = rows.words[word[0]][part]
    else:
        value, place = rows.words[0][part], word[slot]
        for k in range(1, layout.words):
            value = np.where(place == k, rows.words[k][part], value)
    return (value >> layout.shift[features][slot]) & layout.mask[features][slot]


def _group_counts(rows: _Rows, part: slice, slot: np.ndarray, features: np.ndarray, layout: Layout):
    """Rows and target sums by node, feature and bin of several small nodes."""
    nodes, m = features.shape
    n, s = np.empty((nodes, m, BINS)), np.empty((nodes, m, BINS))
    w, wy, base = rows.w[part].astype(np.float64), rows.wy[part], slot * BINS
    for j in range(m):
        code = _fields(rows, part, slot, features[:, j], layout) + base
        n[:, j] = np.bincount(code, w, nodes * BINS).reshape(nodes, BINS)
        s[:, j] = np.bincount(code, wy, nodes * BINS).reshape(nodes, BINS)
    return n, s


def _best(n: np.ndarray, s: np.ndarray, least: int):
    """For each node the place of the best feature, its last bin on the left, the gain, and rows and sum on the left."""
    left_n, left_s = np.cumsum(n, 2), np.cumsum(s, 2)
    all_n, all_s = left_n[:, :1, -1:], left_s[:, :1, -1:]
    left_n, left_s = left_n[:, :, :-1], left_s[:, :, :-1]
    right_n, right_s = all_n - left_n, all_s - left_s
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (left_s * left_s / left_n + right_s * right_s / right_n - all_s * all_s / all_n) / all_n
    gain = np.where((left_n >= least) & (right_n >= least), gain, -1.0).reshape(len(n), -1)
    at, rows = gain.argmax(1), np.arange(len(n))
    return at // (BINS - 1), at % (BINS - 1), gain[rows, at], left_n.reshape(len(n), -1)[rows, at], left_s.reshape(len(n), -1)[rows, at]


def _variance(n, s, q):
    return q / n - (s / n) ** 2


def grow(room: Room, words: list[np.ndarray], y: np.ndarray, rule: Rule, tree: int) -> dict[str, np.ndarray]:
    """One tree on packed rows and targets around zero; its nodes in pre-order. Levels grow the same whatever the depth."""
    rng, layout = np.random.default_rng([rule.seed & (2**63 - 1), tree]), rule.layout
    rows, size = _drawn(room, words, y, rule, rng)
    splits = lambda n, s, q, level: (level < rule.depth) & (n >= 2 * rule.least) & (_variance(n, s, q) > LEAST_VARIANCE)
    squares = lambda part: rows.wy[part] * rows.wy[part] / rows.w[part]
    parts = [slice(a, min(a + CHUNK_ROWS, size)) for a in range(0, size, CHUNK_ROWS)]
    level = {
        "n": np.array([float(sum(int(rows.w[p].sum(dtype=np.int64)) for p in parts))]),
        "s": np.array([math.fsum(rows.wy[p].sum() for p in parts)]), "q": np.array([math.fsum(squares(p).sum() for p in parts)]),
    }
    levels, starts, depth = [], np.array([0, size]), 0
    while True:
        count = len(level["n"])
        level |= {"gain": np.full(count, -1.0), "feature": np.full(count, -1, np.int32), "bin": np.full(count, -1, np.int32),
                  "left": np.full(count, -1, np.int64)}
        levels.append(level)
        with np.errstate(divide="ignore", invalid="ignore"):
            open_ = np.flatnonzero(splits(level["n"], level["s"], level["q"], depth))
        if not len(open_):
            break
        chosen = rng.random((len(open_), len(layout.ends))).argpartition(rule.subset - 1, 1)[:, : rule.subset]
        below: list[np.ndarray] = []  # rows, sum and squares of the children
        kept_sizes: list[np.ndarray] = []
        at, made, i, sizes = 0, 0, 0, np.diff(starts)
        while i < len(open_):
            k = i + 1
            if sizes[i] < LARGE_NODE:
                most = np.searchsorted(starts, starts[i] + GROUP_ROWS, "right") - 1
                large = np.flatnonzero(sizes[i : i + GROUP_NODES] >= LARGE_NODE)
                k = max(k, min(most, i + GROUP_NODES, i + large[0] if len(large) else len(open_), len(open_)))
                part = slice(starts[i], starts[k])
                slot = np.repeat(np.arange(k - i), sizes[i:k])
                n, s = _group_counts(rows, part, slot, chosen[i:k], layout)
            else:
                n, s = _large_counts(rows, starts[i], starts[k], chosen[i], layout)
            place, last, gain, left_n, left_s = _best(n, s, rule.least)
            nodes = open_[i:k]
            good = gain > 0
            feature = chosen[i:k][np.arange(k - i), place]
            chunks = [slice(c, min(c + CHUNK_ROWS, starts[k])) for c in range(starts[i], starts[k], CHUNK_ROWS)]
            sides, left_q = [], np.zeros(2 * (k - i))
            for part in chunks:  # one, but for a large node
                if k - i > 1:
                    side = 2 * slot + (_fields(rows, part, slot, feature, layout) > last[slot])
                else:
                    f = feature[0]
                    side = (((rows.words[layout.word[f]][part] >> layout.shift[f]) & layout.mask[f]) > last[0]).astype(np.int64)
                left_q += np.bincount(side, squares(part), 2 * (k - i))
                sides.append(side.astype(np.uint16 if k - i > 1 else np.uint8))
            g = np.flatnonzero(good)
            child = np.empty((3, 2 * len(g)))
            child[0, ::2], child[1, ::2], child[2] = left_n[g], left_s[g], left_q.reshape(-1, 2)[g].ravel()
            child[0, 1::2], child[1, 1::2] = level["n"][nodes[g]] - left_n[g], level["s"][nodes[g]] - left_s[g]
            level["gain"][nodes[g]], level["feature"][nodes[g]], level["bin"][nodes[g]] = gain[g], feature[g], last[g]
            level["left"][nodes[g]] = made + 2 * np.arange(len(g))
            made += 2 * len(g)
            below.append(child)
            goes_on = np.zeros(2 * (k - i), bool)
            goes_on.reshape(-1, 2)[g] = splits(*child, depth + 1).reshape(-1, 2)
            if k - i > 1:
                held = np.bincount(sides[0], minlength=2 * (k - i))
                where = np.flatnonzero(goes_on[sides[0]])
                rows.move(at, where[np.argsort(sides[0][where], kind="stable")] + starts[i])
            else:
                lefts = rows.part(starts[i], np.concatenate(sides)) if goes_on.any() else 0
                held = np.array([lefts, starts[k] - starts[i] - lefts])
                rows.shift(at, starts[i] + (0 if goes_on[0] else lefts), starts[k] if goes_on[1] else starts[i] + lefts)
            kept_sizes.append(held[goes_on])
            at += int(held[goes_on].sum())
            i = k
        starts = np.concatenate([[0], np.cumsum(np.concatenate(kept_sizes))]).astype(np.int64)
        depth += 1
        if not made:
            break
        whole = np.concatenate(below, 1)
        level = {"n": whole[0], "s": whole[1], "q": whole[2]}
    return _listed(levels, layout)


def _listed(levels: list[dict[str, np.ndarray]], layout: Layout) -> dict[str, np.ndarray]:
    """Nodes of all levels as one table in pre-order: a left child follows its parent, a right one the left subtree."""
    heavy = [np.ones(len(x["n"]), np.int64) for x in levels]
    for d in range(len(levels) - 2, -1, -1):
        inner = np.flatnonzero(levels[d]["left"] >= 0)
        left = levels[d]["left"][inner]
        heavy[d][inner] += heavy[d + 1][left] + heavy[d + 1][left + 1]
    ids = [np.zeros(1, np.int64)]
    lefts, rights = [], []
    for d, x in enumerate(levels):
        left, right = np.full(len(x["n"]), -1, np.int64), np.full(len(x["n"]), -1, np.int64)
        inner = np.flatnonzero(x["left"] >= 0)
        if len(inner):
            at = x["left"][inner]
            left[inner] = ids[d][inner] + 1
            right[inner] = left[inner] + heavy[d + 1][at]
            below = np.zeros(len(levels[d + 1]["n"]), np.int64)
            below[at], below[at + 1] = left[inner], right[inner]
            ids.append(below)
        lefts.append(left)
        rights.append(right)
    flat = {k: np.concatenate([x[k] for x in levels]) for k in ("n", "s", "q", "gain", "feature", "bin")}
    end = np.array([layout.ends[f][b] if f >= 0 else np.nan for f, b in zip(flat["feature"], flat.pop("bin"))])
    flat |= {"id": np.concatenate(ids), "leftChild": np.concatenate(lefts), "rightChild": np.concatenate(rights), "threshold": end}
    order = np.argsort(flat["id"])
    return {k: v[order] for k, v in flat.items()}


def _grower(rule: Rule, first: int, last: int, n_rows: int, mean: float):
    """Arrow function from the whole packed table to the nodes of the trees ``first`` to ``last - 1``."""
    kinds = pa.schema([("treeID", pa.int32()), ("id", pa.int32()), ("n", pa.float64()), ("s", pa.float64()), ("q", pa.float64()),
                       ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()), ("feature", pa.int32()),
                       ("threshold", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryDirectory() as folder:
            room = Room(folder if n_rows > ROWS_IN_MEMORY else None)
            y, words, at = room.array(n_rows, np.float64), [room.array(n_rows, np.int64) for _ in range(rule.layout.words)], 0
            for batch in batches:
                to = at + batch.num_rows
                y[at:to] = batch.column(0).to_numpy(zero_copy_only=False) - mean
                for i, word in enumerate(words):
                    word[at:to] = batch.column(i + 1).to_numpy(zero_copy_only=False)
                at = to
            if at != n_rows:
                raise ValueError(f"{at} packed rows instead of {n_rows}")
            for tree in range(first, last):
                nodes = grow(room, words, y, rule, tree)
                n, s = nodes["n"], nodes["s"]
                nodes["q"], nodes["s"] = nodes["q"] + 2 * mean * s + n * mean * mean, s + n * mean
                nodes["treeID"] = np.full(len(n), tree)
                yield pa.RecordBatch.from_arrays([pa.array(nodes[f.name]).cast(f.type) for f in kinds], schema=kinds)

    return run


def fitted_layouts(rows: DataFrame, total: int, features: int, seeds: Sequence[int]) -> list[Layout]:
    """Thresholds of each batch, from rows of its own out of one sample."""
    share = min(1.0, SAMPLE_ROWS * len(seeds) / total)
    seen = (rows.sample(False, share, seeds[0]) if share < 1 else rows).select(vector_to_array("features").alias("x")).toArrow()
    values = _matrix(seen.column("x").combine_chunks(), features)
    found = []
    for seed in seeds:
        own = values
        if len(values) > SAMPLE_ROWS:
            own = values[np.random.default_rng(seed & (2**63 - 1)).choice(len(values), SAMPLE_ROWS, replace=False)]
        found.append(Layout.of([thresholds(own[:, i]) for i in range(features)]))
    return found


def write_forest(
    rows: DataFrame, settings: Mapping[str, object], batches: Sequence[Mapping[str, int]], features: int, estimator, path: str,
) -> None:
    """Grow a forest on ``rows(features, label)`` and write it in the form that Spark ML reads a forest from.

    A batch tells its number of trees and its seed.
    """
    spark, trees = rows.sparkSession, sum(b["numTrees"] for b in batches)
    layouts = fitted_layouts(rows, rows.count(), features, [b["seed"] for b in batches])
    table = packed_rows(rows, layouts)
    n_rows, mean = table.agg(F.count("*"), F.avg("y")).first()
    subset = subset_size(str(settings.get("featureSubsetStrategy", "auto")), features, trees)
    cores = spark.sparkContext.defaultParallelism
    each, jobs, places, first = max(1, math.ceil(trees / (2 * cores))), [], [], 0
    for k, batch in enumerate(batches):
        rule = Rule(layouts[k], int(settings.get("maxDepth", 5)), int(settings.get("minInstancesPerNode", 1)), subset,
                    bool(settings.get("bootstrap", True)), batch["seed"])
        last = first + batch["numTrees"]
        jobs += [(k, rule, at, min(at + each, last)) for at in range(first, last, each)]
        first = last

    def grown(job: tuple[int, Rule, int, int]) -> None:
        k, rule, at, to = job
        place = new_path(spark, "nodes")
        places.append(place)
        words = table.select("y", *[f"w{k}_{i}" for i in range(rule.layout.words)]).coalesce(1)
        words.mapInArrow(_grower(rule, at, to, n_rows, mean), NODES).write.parquet(place)

    with ThreadPool(cores) as pool:
        pool.map(inheritable_thread_target(spark)(grown), jobs, chunksize=1)
    free(table)
    nodes = spark.read.schema(NODES).parquet(*places)
    inner = F.col("feature") >= 0
    nodes.select("treeID", F.struct(
        "id", (F.col("s") / F.col("n")).alias("prediction"),
        F.greatest(F.lit(0.0), F.col("q") / F.col("n") - (F.col("s") / F.col("n")) * (F.col("s") / F.col("n"))).alias("impurity"),
        F.array("n", "s", "q").alias("impurityStats"), F.col("n").cast("long").alias("rawCount"), "gain", "leftChild", "rightChild",
        F.struct(
            F.col("feature").alias("featureIndex"),
            F.when(inner, F.array("threshold")).otherwise(F.array().cast("array<double>")).alias("leftCategoriesOrThreshold"),
            F.lit(-1).alias("numCategories"),
        ).alias("split"),
    ).alias("nodeData")).write.parquet(f"{path}/data")
    _write_metadata(rows, estimator, trees, features, path)


def _write_metadata(rows: DataFrame, estimator, trees: int, features: int, path: str) -> None:
    spark, kinds = rows.sparkSession, "org.apache.spark.ml.regression."
    given = {p.name: v for p, v in estimator._paramMap.items()}
    default = {p.name: v for p, v in estimator._defaultParamMap.items()}
    common = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version}
    whole = common | {"class": f"{kinds}RandomForestRegressionModel", "uid": estimator.uid, "paramMap": given,
                      "defaultParamMap": default, "numFeatures": features, "numTrees": trees}
    of_forests = {"numTrees", "featureSubsetStrategy", "bootstrap", "subsamplingRate"}
    tree = common | {"class": f"{kinds}DecisionTreeRegressionModel"} | {
        k: {n: v for n, v in m.items() if n not in of_forests} for k, m in (("paramMap", given), ("defaultParamMap", default))
    }
    spark.createDataFrame([(json.dumps(whole),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame(
        [(i, json.dumps(tree | {"uid": f"{estimator.uid}_{i}"}), 1.0) for i in range(trees)], "_1 int, _2 string, _3 double"
    ).coalesce(1).write.parquet(f"{path}/treesMetadata")
