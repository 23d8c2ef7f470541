"""Sharding, decontamination, the registered queries and the pipeline."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from compare import compare, oracle
from pyspark.sql import functions as F

from gaugeflow.llm import decontaminate, sharding
from gaugeflow.llm.kernels import WORD_BASE, Powers
from gaugeflow.llm.queries import QUERIES, TWINS


def test_shards_hold_each_row_once(edge_docs, documents):
    for docs, shards in ((edge_docs, 4), (documents, 40)):
        got = sharding.shuffle_into_shards(docs, shards, bucket_bytes=20_000).collect()
        ids = Counter(r.doc_id for r in docs.select("doc_id").collect())
        assert Counter(r.doc_id for r in got) == ids
        sizes = Counter(r.shard for r in got)
        assert max(sizes.values()) - min(sizes[s] for s in range(shards)) <= 1
        for s in range(shards):
            assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    assert {r.text for r in got} == {r.text for r in documents.collect()}


def test_shards_empty_table_and_mixing_of_order(no_docs, spark):
    assert sharding.shuffle_into_shards(no_docs, 3).count() == 0
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    got = sharding.shuffle_into_shards(docs, 1, bucket_bytes=3000).orderBy("slot").collect()
    order = np.array([r.doc_id for r in got])
    assert abs(np.corrcoef(order, np.arange(4000))[0, 1]) < 0.1


def test_buckets_follow_rows_and_all_columns(spark):
    """Empty texts, and small texts beside wide columns, make many buckets too."""
    empty = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    wide = spark.range(200).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.repeat(F.lit("x"), 9000).alias("more"),
                                   F.sequence(F.lit(0), F.lit(500)).alias("numbers"))
    for docs, least in ((empty, 20_000 * 60), (wide, 200 * 9500)):
        assert sharding.row_bytes(docs) > least
        got = sharding.shuffle_into_shards(docs, 3, bucket_bytes=50_000)
        sizes = [r["count"] for r in got.groupBy("shard").count().collect()]
        assert sum(sizes) == docs.count() and max(sizes) - min(sizes) <= 1


def test_shards_are_written_in_order(spark, tmp_path, documents):
    shards = sharding.shuffle_into_shards(documents.select("doc_id", "text"), 5)
    sharding.write_shards(shards, str(tmp_path / "shards"), rows_per_file=30)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == documents.count() and back.select("shard").distinct().count() == 5


def test_tiles_are_greedy_and_disjoint():
    def tiles(a, b):
        return decontaminate.tile(np.array(a, np.uint64), np.array(b, np.uint64), 3, Powers(WORD_BASE))

    item = list(range(1, 13))
    assert tiles(item, [9, 10, 11, 12, 13, 0, 5, 6, 7, 8, 9, 1, 2, 3, 4, 5, 6, 1]) == [(6, 0, 11), (4, 8, 0)]
    assert tiles(item, [7, 8, 9, 10, 11, 12, 0, 1, 2, 3, 4, 5, 6]) == [(6, 0, 7), (6, 6, 0)]
    assert tiles(item, [2, 1, 4, 3]) == [] and tiles([], item) == [] and tiles(item, []) == []
    assert sum(n for n, _, _ in tiles([7] * 10, [7] * 4)) == 4


def test_contaminated_documents(spark, edge_docs, no_docs):
    words = [f"w{i}" for i in range(40)]
    passage = " ".join(words)
    bench = spark.createDataFrame(
        [(1, passage), (1, passage), (2, "too short item"), (3, None), (4, "")], "item_id long, text string"
    )
    noise = " ".join(f"n{i}" for i in range(200))
    docs = spark.createDataFrame([
        (10, f"{noise} {passage} {noise}"), (11, f"{noise} {' '.join(words[20:])} {noise} {' '.join(words[:20])}"),
        (12, passage.upper().replace(" ", ",\n")), (13, " ".join(words[:12])), (14, noise), (15, None), (16, ""),
        (17, " ".join(reversed(words))), (18, "too short item"),
    ], "doc_id long, text string")
    found = decontaminate.find_contaminated(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(10, 1), (11, 1), (12, 1)}
    assert all(r.coverage == 1.0 for r in found)
    assert {r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect()} == {13, 14, 15, 16, 17, 18}
    assert decontaminate.find_contaminated(edge_docs, bench).count() == 0
    assert decontaminate.find_contaminated(no_docs, bench).count() == 0
    assert decontaminate.find_contaminated(docs, bench.limit(0)).count() == 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, folder, name):
    assert compare(spark, oracle(folder), name, folder, QUERIES, TWINS) == ""


def test_pipeline_stages_take_effect(spark, folder, documents, texts):
    docs, columns = documents, documents.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder)
        assert kept.columns == columns, name
        assert kept.count() <= docs.count(), name
        docs = spark.createDataFrame(kept.collect(), documents.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert sorted(r.doc_id for r in last.collect()) == sorted(r.doc_id for r in docs.collect())
    assert set(last.columns) == {*columns, "shard", "slot"}


def test_pipeline_run(spark, folder, documents):
    out = corpus_pipeline.run(spark, folder)
    assert 0 < out.count() < documents.count()
