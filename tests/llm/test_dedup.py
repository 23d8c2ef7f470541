"""Exact, near and substring deduplication against plain Python."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeflow.llm import exact_dedup, near_dedup, substring_dedup
from gaugeflow.llm.components import connected_components


def small(i):
    return (i is not None, i or 0)


def exact_rows(df):
    rows = df.select("doc_id", "keep_id", "group_size", exact_dedup.hex_digest().alias("sha"), "kept").collect()
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.sha) for r in rows), key=lambda r: small(r[0])), rows


def test_exact_edges(edge_docs, edge_rows):
    got, rows = exact_rows(exact_dedup.mark_duplicates(edge_docs))
    assert got == brute.duplicates([(i, t) for i, t, _ in edge_rows])
    assert sum(r.kept for r in rows) == len({r.sha for r in rows})


def test_exact_hot_text_and_repeated_rows(spark):
    rows = [(i, "HOT" if i % 3 else "hot") for i in range(900)] + [(i, f"cold {i}") for i in range(900, 1500)]
    rows += [(5000, "twice"), (5000, "twice")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    hot = exact_dedup.frequent_digests(exact_dedup.text_digests(docs, "doc_id", "text"), counters=20)
    assert hot.count() <= 21
    got, found = exact_rows(exact_dedup.mark_duplicates(docs, counters=20))
    assert got == brute.duplicates(rows)
    assert sum(r.kept for r in found if r.doc_id == 5000) == 1


def test_exact_empty_table(no_docs):
    assert exact_dedup.mark_duplicates(no_docs).count() == 0


def test_drop_duplicates_keeps_columns(edge_docs):
    kept = exact_dedup.drop_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    assert {r.doc_id for r in kept.collect()} == {2, 3, 5, 6, 8, 9, 10, 11, 12, 13, 14, None}


@pytest.mark.parametrize("size", [3, 5])
def test_windows_edges(edge_docs, edge_rows, size):
    expected = {i: r for (i, _, _), r in zip(edge_rows, brute.windows_removed([r[:2] for r in edge_rows], size))}
    got = substring_dedup.remove_repeated_windows(edge_docs, window=size).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in got} == expected


def test_windows_spans_are_maximal_and_disjoint(documents, texts):
    got = substring_dedup.remove_repeated_windows(documents, window=35, bucket_bytes=20_000).collect()
    rows = list(texts.items())
    expected = {i: r for (i, _), r in zip(rows, brute.windows_removed(rows, 35))}
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in got} == expected
    for r in got:
        spans = r.spans or []
        assert sum(spans[1::2]) - sum(spans[::2]) == r.n_removed
        assert all(a < b for a, b in zip(spans, spans[1:]))


def test_windows_repeated_in_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "CHUNK_WINDOWS", 10)
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(60)))) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    expected = {i: r for (i, _), r in zip(rows, brute.windows_removed(rows, 6))}
    got = substring_dedup.remove_repeated_windows(docs, window=6, bucket_bytes=100).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in got} == expected


@pytest.mark.parametrize("kind", ["clean", "short", "mixed"])
def test_windows_of_chunks_without_any_repeat(spark, kind):
    """No window of a chunk repeats: all of them, or next to chunks that do, one task each."""
    clean = [(i, " ".join(f"w{i}x{j}" for j in range(50))) for i in range(10)]
    short = [(100, None), (101, ""), (102, "a b c"), (103, "a b c")]
    copies = [(200, "tick tock " * 30), (201, "tick tock " * 30)]
    rows = {"clean": clean, "short": short, "mixed": clean + short + copies}[kind]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartitionByRange(len(rows), "doc_id")
    expected = {i: r for (i, _), r in zip(rows, brute.windows_removed(rows, 6))}
    got = substring_dedup.remove_repeated_windows(docs, window=6).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in got} == expected


def test_windows_flush_by_documents(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "CHUNK_DOCS", 3)
    rows = [(i, "one two three four five" if i % 4 == 1 else "short") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    expected = {i: r for (i, _), r in zip(rows, brute.windows_removed(rows, 4))}
    got = substring_dedup.remove_repeated_windows(docs, window=4).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in got} == expected


def test_windows_of_very_long_copies(spark):
    """Texts above the size of a piece, next to tasks with short texts only."""
    long = " ".join(f"w{i % 70001}" for i in range(400_000))
    docs = spark.createDataFrame([(1, long), (2, long), (3, "a b"), (4, None)], "doc_id long, text string").repartition(4, "doc_id")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in substring_dedup.remove_repeated_windows(docs).collect()}
    assert got == {1: (400_000, 400_000, ""), 2: (400_000, 400_000, ""), 3: (2, 0, "a b"), 4: (0, 0, "")}


def test_windows_empty_table(no_docs):
    assert substring_dedup.remove_repeated_windows(no_docs).count() == 0


def test_components(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1040)]
    parent = {x: x for p in pairs for x in p}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: root(x) for x in linked}


def test_register_estimate_is_near_the_truth():
    rng = np.random.default_rng(1)
    chances = near_dedup.collision_table()
    edges = np.arange(near_dedup.REGISTERS, dtype=np.uint64) << np.uint64(57)

    def profile(values):
        values = np.unique(values)
        at = np.minimum(np.searchsorted(values, edges), len(values) - 1)
        filled = (values[at] >> np.uint64(57)) == np.arange(near_dedup.REGISTERS, dtype=np.uint64)
        return near_dedup.registers(values[at], filled)

    for share in (0.0, 0.5, 0.8, 1.0):
        errors = []
        for _ in range(30):
            pool = rng.integers(0, 2**64, 2000, dtype=np.uint64)
            common = int(1000 * 2 * share / (1 + share))
            a, b = pool[:1000], np.concatenate([pool[:common], pool[1000:2000 - common]])
            n = np.array([1000])
            errors.append(near_dedup.estimate(profile(a)[None], profile(b)[None], n, n, chances)[0] - share)
        assert abs(np.mean(errors)) < 0.03


def near_rows(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_near_edges_and_clusters(spark, edge_rows):
    rng = random.Random(8)
    base = [rng.choice("abcdefghij") + str(rng.randrange(500)) for _ in range(120)]
    rows = [(i, t) for i, t, _ in edge_rows if i is not None]
    for i in range(100, 190):  # near copies of near copies: a chain without a common centre
        base[rng.randrange(120)] = f"new{i}"
        copy = list(base)
        copy[rng.randrange(120)] = f"own{i}"
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("digest", F.lit("x")).repartition(4)
    found = near_dedup.near_duplicates(docs, shingle=4, percent=80)
    assert near_rows(found) == brute.near_classes(dict(rows), 4, 80)


def cluster_rows(copies, strangers, seed=4):
    """Near copies of one text with a few changed words each, and texts that share three quarters of it only."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(160)]
    rows = []
    for i in range(copies):
        words = list(base)
        for at in rng.sample(range(160), 3):
            words[at] = f"n{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    for i in range(strangers):
        words = list(base)
        cut = rng.randrange(120)
        words[cut:cut + 40] = [f"s{i}x{j}" for j in range(40)]
        rows.append((10_000 + i, " ".join(words)))
    return rows


@pytest.mark.parametrize("block", [8, 4096])
def test_near_in_large_buckets(spark, block):
    """Buckets far above the block: rounds of leaders, the largest component dealt once, the rest to all blocks."""
    rows = cluster_rows(60, 25)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_dedup.near_duplicates(docs, shingle=4, percent=80, block=block)
    assert near_rows(found) == brute.near_classes(dict(rows), 4, 80)


def test_rows_sent_grow_with_a_group_not_with_its_square(spark):
    """Twice and four times the members of one bucket: what visits blocks grows in proportion."""
    sent = []
    for members in (2000, 4000, 8000):
        rest = F.col("id") % 40 == 0
        inside = spark.range(members).select(
            F.lit(1).alias("band"), F.lit(7).cast("long").alias("value"), F.col("id").alias("rep"),
            F.when(rest, F.col("id")).otherwise(1).alias("label"), (~rest).alias("main"),
            F.lit(members).cast("long").alias("m"), F.lit(members - members // 40).cast("long").alias("c"),
        )
        sent.append(near_dedup.dealt(inside, 256).count())
        blocks = near_dedup.dealt(inside, 256).groupBy("low", "high").count()
        assert blocks.agg(F.max("count")).first()[0] < 256 * 2
        pairs = near_dedup.dealt(inside, 256).alias("x").join(near_dedup.dealt(inside, 256).alias("y"), ["low", "high"]).where(
            "x.rep < y.rep AND x.label <> y.label AND (low = high OR (x.block = low) <> (y.block = low))")
        n, rest = members - members // 40, members // 40
        assert pairs.select("x.rep", "y.rep").distinct().count() == n * rest + rest * (rest - 1) // 2 == pairs.count()
    assert sent[1] <= 2.6 * sent[0] and sent[2] <= 2.6 * sent[1]


def test_near_on_documents(documents, texts):
    assert near_rows(near_dedup.near_duplicates(documents, shingle=5, percent=80)) == brute.near_classes(texts, 5, 80)


def test_near_empty_table(no_docs):
    assert near_dedup.near_duplicates(no_docs).count() == 0
