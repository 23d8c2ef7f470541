"""Spelling groups, packing and ranked search against plain Python."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeflow.llm import packing, search, spelling
from gaugeflow.llm.queries import QUERIES, TOKENIZERS

VOCABULARY = f"{TOKENIZERS}/word_bpe_49k.json"


def spelled(df):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


@pytest.fixture(scope="module")
def misspelt():
    """Frequent words, their variants in chains, and a crowd of words that share their first half."""
    rng = random.Random(5)
    rows = [(i, "received " * 9 + "Committee COMMITTEE committee " * 40) for i in range(30)]
    rows += [(100, "recieved receved recived " * 2 + "commitee commitee committe committe comittee"), (None, "commitee receved")]
    rows += [(101, "abcdefgh " * 300 + "abcdefgx " * 30 + "abcdefyx " * 3 + "abcdezyx"), (102, "naïveté naiveté Naïveté NAïVETé ÀÉÎÕÜßÿ àéîõüßÿ")]
    crowd = ["inter" + "".join(rng.choice("abcd") for _ in range(rng.randint(3, 6))) for _ in range(600)]
    rows += [(200 + i, " ".join(rng.choices(crowd, k=60))) for i in range(40)]
    return rows + [(101, "abcdefgh abcdefgh"), (900, None), (901, ""), (902, "short six66 ..."), (903, "zz" * 4000)]


@pytest.mark.parametrize(("divisor", "fan_out"), [(0, 64), (3, 0)])
def test_spelling_groups(spark, misspelt, divisor, fan_out, monkeypatch):
    monkeypatch.setattr(spelling.near_words, "__defaults__", (7, fan_out))
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in misspelt], "doc_id long, text string, word string, n int")
    got = spelled(spelling.group_spellings(docs.repartition(5), divisor=divisor))
    assert got == brute.spellings(misspelt, divisor)
    if not divisor:
        assert got["abcdefyx"][2:] == ("abcdefgx", 30, "abcdefgh")


def test_spelling_candidates_grow_with_the_rows(spark):
    """Words that share a half meet on finer keys, where only pairs one edit apart remain."""
    words = spark.range(3000).select(F.format_string("prefix%06d", F.col("id") * 7919 % 1000003).alias("word"), F.lit(2).alias("n"))
    pairs = {(r.a, r.b) for r in spelling.near_words(words).collect()}
    held = sorted(r.word for r in words.collect())
    assert pairs == {(a, b) for i, a in enumerate(held) for b in held[i + 1:] if sum(x != y for x, y in zip(a, b)) == 1}


def test_spelling_edges(edge_docs, edge_rows, no_docs):
    assert spelled(spelling.group_spellings(edge_docs)) == brute.spellings([r[:2] for r in edge_rows])
    assert spelling.group_spellings(no_docs).count() == 0


def test_spelling_query(spark, folder, texts):
    got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in QUERIES["op11_spelling"](spark, folder).collect()}
    assert got == brute.spellings(texts.items(), 31)


@pytest.mark.parametrize("kind", range(5))
def test_windows_are_full_and_hold_each_token_once(kind):
    rng = np.random.default_rng(kind)
    for n in (0, 1, 2, 17, 150):
        lengths = [rng.integers(1, 6000, n), rng.integers(1, 300, n), rng.integers(1025, 2048, n), np.full(n, 2048),
                   np.full(n, 100_001)][kind]
        pieces, sizes = packing.pack_group(lengths)
        covered, filled = defaultdict(list), np.zeros(len(sizes), int)
        for doc, start, length, window, offset in sorted(pieces.tolist(), key=lambda p: (p[3], p[4])):
            assert length > 0 and filled[window] == offset
            filled[window] += length
            covered[doc].append((start, start + length))
        assert (filled == sizes).all() and all(s <= 2048 and s & (s - 1) == 0 for s in sizes.tolist())
        for doc, length in enumerate(lengths.tolist()):
            ends = sorted(covered[doc])
            assert ends[0][0] == 0 and ends[-1][1] == length and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
        loads = np.bincount(packing.step_groups(sizes, 1 << 14), weights=sizes)
        assert not n or loads.max() - loads.min() <= 2048


def test_short_tiers_fill_long_gaps():
    pieces, sizes = packing.pack_group(np.array([1500, 548, 700, 300, 24]))
    windows = defaultdict(list)
    for doc, _, length, window, _ in pieces.tolist():
        windows[int(sizes[window])].append((doc, length))
    assert sorted(windows[2048]) == [(0, 1500), (1, 548)] and sorted(windows[1024]) == [(2, 700), (3, 300), (4, 24)]


def test_encoder_equals_the_tokenizer(texts):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(VOCABULARY)
    odd = [
        "a\u0301 \u0301b  \t\r\nx y\xa0z\x1cq\x85w", "ΑΣ ΑΣΣ Σ", "İstanbul DON'T 'such we'll ''s !'s 1234 ..!?", "", " ", "\n\n",
        "<|endoftext|> a<|startoftext|>b", "x" * 5000, "日本語 テスト", "ẛ̣ ﬁ Å ªµº ²½ × ÷ ß_a_1", "👍🏽👨\u200d👩\u200d👧 ok", "'s't 're",
    ]
    encoder = packing.Encoder(VOCABULARY)
    for part in (odd, list(texts.values()), odd):
        part = [t or "" for t in part]
        assert [x.tolist() for x in encoder.encode(part)] == [e.ids for e in plain.encode_batch(part, add_special_tokens=False)]


def ids_of(texts):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(VOCABULARY)
    return [plain.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


@pytest.mark.parametrize("group_tokens", [3000, 1 << 22])
def test_packed_documents_round_trip(spark, edge_docs, edge_rows, documents, texts, group_tokens):
    long = documents.unionByName(spark.createDataFrame([(10**6, "many words here " * 400_000)], "doc_id long, text string"), True)
    for docs, rows in ((edge_docs, [r[:2] for r in edge_rows]), (long, [*texts.items(), (10**6, "many words here " * 400_000)])):
        got = packing.pack_documents(docs, VOCABULARY, group_tokens=group_tokens).collect()
        whole = defaultdict(list)
        for r in got:
            assert r.length * 4 == len(r.ids)
            whole[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist(), r.doc_tokens))
        for (i, _), ids in zip(rows, ids_of([t for _, t in rows])):
            parts = sorted(whole[i])
            assert sum((p[1] for p in parts), []) == ids and all(p[2] == len(ids) for p in parts)
        windows = defaultdict(list)
        for r in got:
            windows[r.sequence_id].append((r.offset, r.length, r.context, r.step))
        for parts in windows.values():
            parts.sort()
            assert [o for o, *_ in parts] == np.cumsum([0] + [n for _, n, *_ in parts])[:-1].tolist()
            assert sum(p[1] for p in parts) == parts[0][2] and len({p[2:] for p in parts}) == 1


def test_repeated_rows_and_no_rows_are_packed(spark, no_docs):
    docs = spark.createDataFrame([(1, "a b c")] * 5 + [(2, None)], "doc_id long, text string")
    pieces = packing.pack_documents(docs, VOCABULARY)
    assert pieces.agg(F.sum("length")).first()[0] == 5 * 4 + 1
    assert packing.sequences(pieces).agg(F.sum(F.length("ids"))).first()[0] == 4 * 21
    assert packing.pack_documents(no_docs, VOCABULARY).count() == 0


def test_packing_query_digests(spark, folder, texts):
    ids = dict(zip(texts, ids_of(texts.values())))
    for r in QUERIES["op12_packing"](spark, folder).collect():
        part = np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4")
        assert r.ids_crc32 == zlib.crc32(part.tobytes()) and r.doc_tokens == len(ids[r.doc_id])


def ranked(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


@pytest.mark.parametrize(("block_docs", "first_share"), [(7, 0.3), (64, 0.0)])
def test_ranking(spark, documents, texts, folder, block_docs, first_share):
    """Many blocks, so that thresholds, light terms and pair bounds all skip something."""
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    items += [(500, "the the the and"), (501, items[0][1] + " zzzunknown")]
    queries = spark.createDataFrame(items, "item_id long, text string")
    index = search.build_index(documents.repartition(3), block_docs=block_docs)
    got = search.search(index, queries, k=5, at_once=9, first_share=first_share)
    assert ranked(got) == sorted(brute.ranking(texts.items(), items, 5))


def test_ranking_of_ties_and_edges(spark, edge_docs, edge_rows, no_docs):
    rows = [r[:2] for r in edge_rows]
    items = [(1, "the fox"), (1, "the fox"), (2, None), (3, ""), (4, "one two WORD"), (5, "nothing there"), (None, "same words id")]
    queries = spark.createDataFrame([(i, t, 7) for i, t in items], "item_id long, text string, rank int")
    for k in (1, 2, 30):
        got = search.search(search.build_index(edge_docs, block_docs=2), queries, k=k)
        assert ranked(got) == sorted(brute.ranking(rows, items, k), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert search.search(search.build_index(no_docs), queries).count() == 0
    assert search.search(search.build_index(edge_docs), queries.limit(0)).count() == 0
    many = spark.createDataFrame([(i, "tie tie" if i % 2 else "tie") for i in range(300)] + [(8, "tie"), (1, "tie tie")], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "tie")], "item_id long, text string")
    got = search.search(search.build_index(many.repartition(4), block_docs=5), asked)
    assert ranked(got) == brute.ranking([tuple(r) for r in many.collect()], [(1, "tie")], 20)


def test_pair_bounds_are_tighter_than_maxima_and_safe(spark, documents, folder):
    index = search.build_index(documents, block_docs=32)
    texts = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    plan = search.plan_queries(index, texts)
    tighter = 0
    for row in index.blocks.collect():
        lists = search.impact_lists(row.asDict(), plan, index.n_docs, index.n_words)
        shared, borders, joint = search.pair_lists(lists, plan.pairs)
        for p, (a, b, x, y) in enumerate(plan.pairs.tolist()):
            score = np.zeros(lists.size, np.int64)
            for term, times in ((a, x), (b, y)):
                doc, impact = lists.of(term)
                score[doc] += times * impact
            both = set(lists.of(a)[0].tolist()) & set(lists.of(b)[0].tolist())
            assert sorted(both) == sorted(shared[borders[p]:borders[p + 1]].tolist())
            bound = max(joint[p], x * lists.best[a], y * lists.best[b])
            assert score.max(initial=0) == bound
            tighter += bound < x * lists.best[a] + y * lists.best[b]
    assert tighter > len(plan.pairs)


def test_search_by_text_ids(spark):
    docs = spark.createDataFrame([("b", "apple pie"), ("a", "apple pie"), (None, "apple pie")], "doc_id string, text string")
    got = search.search(search.build_index(docs), spark.createDataFrame([("q", "PIE pear")], "item_id string, text string"))
    assert [r.doc_id for r in got.orderBy("rank").collect()] == ["a", "b", None]
