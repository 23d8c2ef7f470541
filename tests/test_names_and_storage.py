"""Awkward column names, values without limits, and intermediate tables that go away."""

from __future__ import annotations

import os
import re
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gaugeflow import storage
from gaugeflow.operators import columns, encode, impute, profile, split
from gaugeflow.operators.alerts import drift_alerts
from gaugeflow.sources import logs
from gaugeflow.streaming import jobs

REPO = str(Path(__file__).resolve().parents[1])


def test_one_hot_names_are_distinct(spark):
    assert encode.column_names("D", ["A", "a", "a_2"]) == ["D_A", "D_a_3", "D_a_2"]
    df = spark.createDataFrame([("A",), ("a",), ("a_2",), (None,)], "d string")
    out = encode.one_hot(df, "d", "D")
    assert sorted(sum(r) for r in out.collect()) == [0, 1, 1, 1]


def test_dotted_groups(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 3.0), (None, 5.0)], "`a.b` string, `v.w` double")
    for mode in ("exact", "approx"):
        stats = {r["a.b"]: r["mean"] for r in profile.feature_stats(df, ["v.w"], by=["a.b"], mode=mode).collect()}
        assert stats == {"x": 2.0, None: 5.0}


def test_all_text_columns_and_strata_are_used(spark):
    df = spark.createDataFrame([tuple(str(i) for i in range(12))], ", ".join(f"c{i} string" for i in range(12)))
    assert columns.ensure_all_numeric(df).first() == tuple(float(i) for i in range(12))
    assert columns.ensure_all_numeric(df, max_coerced=10).columns == [f"c{i}" for i in range(10)]
    strata = df.select(*[F.col(f"c{i}").alias(f"Stratification{i}") for i in range(5)])
    assert len(profile.stratification_columns(strata)) == 5


def test_sparse_codes_have_no_limit(spark):
    df = spark.range(6000).select(F.format_string("k%05d", "id").alias("k")).unionByName(
        spark.createDataFrame([(None,)], "k string")
    )
    with pytest.raises(ValueError, match="more than"):
        encode.categories(df, "k")
    codes = encode.category_codes(df, "k").agg(F.min("k_code"), F.max("k_code"), F.count_distinct("k_code"), F.count("*")).first()
    assert tuple(codes) == (0, 5999, 6000, 6001)


def test_row_hash_tells_joined_texts_apart(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "~"), ("~", None), ("a|b", "c")], "x string, y string")
    assert split.with_row_hash(df).select("row_id").distinct().count() == 4


def test_many_groups_and_rows_without_one(spark):
    df = spark.range(60_000).select(
        F.when(F.col("id") % 2 == 0, F.format_string("g%d", F.col("id") % 30_000)).alias("g"),
        F.when(F.col("id") % 4 < 2, (F.col("id") % 7).cast("double")).alias("v"),
    )
    stats = df.where("g IS NOT NULL").groupBy("g").agg(F.max("v").alias("top"))
    broadcast = storage.join_stats(df, stats, ["g"], True)
    shuffled = storage.join_stats(df, stats, ["g"], False)
    assert shuffled.columns == broadcast.columns
    assert shuffled.exceptAll(broadcast).isEmpty() and broadcast.exceptAll(shuffled).isEmpty()
    _, small = storage.pin_small(stats, max_bytes=1000)
    assert not small and storage.pin_small(stats)[1]
    assert impute.group_median_impute(df, "v", "g").where("v IS NULL").isEmpty()


def test_new_checkpoint_keeps_old_alerts(spark, folder, tmp_path):
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    log = str(tmp_path / "alerts")

    def to_alerts(batch):
        return drift_alerts(batch.limit(1).select(
            F.lit("drift_detected").alias("status"), F.lit("value").alias("feature"), F.lit("moved").alias("message"),
            F.lit(0.0).alias("ref_mean"), F.lit(1.0).alias("current_mean"), F.lit(2.0).alias("deviation"),
        ))

    for name in ("first", "second", "second"):
        rows = jobs.read_stream(spark, folder, schema, pattern="events.parquet", files_per_trigger=1)
        jobs.alert_stream(rows, to_alerts, log, checkpoint=str(tmp_path / name), trigger={"availableNow": True}).awaitTermination()
    assert logs.read_alerts(spark, log).count() == 2


SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
from gaugeflow import storage
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false"){conf}.getOrCreate()
{unset}
first = storage.materialise(spark.range(10), "first")
second = storage.materialise(first, "second")
storage.free(first)
assert second.count() == 10
import os
folder = storage.shared_folder(spark)
left = [d for _, names, _ in os.walk(folder) for d in names]
assert any(d.startswith("second") for d in left) and not any(d.startswith("first") for d in left), left
print("FOLDER", folder)
spark.stop()
"""


@pytest.mark.parametrize("configured", [True, False])
def test_nothing_is_left_after_the_end(tmp_path, configured):
    shared = str(tmp_path / "shared")
    script = SCRIPT.format(
        repo=REPO, conf=f'.config("spark.checkpoint.dir", {shared!r})' if configured else "",
        unset="" if configured else 'spark.conf.get = (lambda get: lambda k, *a: a[0] if k == "spark.checkpoint.dir" else get(k, *a))(spark.conf.get)',
    )
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=200)
    assert done.returncode == 0, done.stderr[-2000:]
    folder = done.stdout.rpartition("FOLDER ")[2].strip()
    assert not [name for name in os.listdir(folder) if name.startswith("gaugeflow")]


def test_row_ids_of_wide_tables_are_compiled_and_keep_their_text(spark, capsys):
    wide = storage.materialise(spark.range(20).select(
        *[F.when(F.col("id") % 7 != i % 7, (F.col("id") + i) % 3 - F.lit(1 if i % 5 == 0 else 0)).cast(("int", "bigint")[i % 2])
          .alias(f"flag {i}") for i in range(60)],
        (F.col("id") / 4).alias("part"), (F.col("id") % 2 == 0).alias("even"),
        F.when(F.col("id") > 3, F.concat(F.lit("1:0|"), "id")).otherwise("").alias("text"),
    ), "wide")
    told = split.with_row_hash(wide)
    texts = [F.col(f"`{c}`").cast("string") for c in wide.columns]
    marks = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    assert told.where(F.col("row_id") == F.md5(F.concat_ws("|", *marks))).count() == 20
    told.explain(mode="codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert all(n < 8000 for n in sizes), sizes  # larger methods are never compiled
