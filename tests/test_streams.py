"""Repeated, late and interrupted input of the streams."""

from __future__ import annotations

from functools import partial

import pytest
from pyspark.sql import functions as F

from gaugeflow.operators import alerts
from gaugeflow.streaming import jobs

REPORT = (
    "feature string, window_start string, event_time timestamp, status string, message string, ref_mean double,"
    " current_mean double, deviation double"
)
SEEN = "severity string, title string, source string, feature string, window_start string"


@pytest.fixture(autouse=True)
def state_on_disk(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    jobs.keep_state_on_disk(spark)
    yield
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def put(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def drifting(day, feature="f1"):
    start = f"2024-01-{day:02d} 00:00:00"
    return feature, start, None, "drift_detected", "moved", 0.0, 1.0, 9.0


def with_time(spark, folder, rows):
    frame = spark.createDataFrame(rows, REPORT).withColumn("event_time", F.expr("timestamp(window_start) + INTERVAL 1 DAY"))
    frame.coalesce(1).write.mode("append").parquet(folder)


def test_repeated_and_replayed_windows_give_one_alert(spark, tmp_path):
    """Twice in a batch, again in a later batch, and again after the stream was stopped and started."""
    source, log = str(tmp_path / "reports"), str(tmp_path / "alerts")

    def run():
        rows = spark.readStream.schema(REPORT).option("maxFilesPerTrigger", 1).parquet(source)
        anomalous = rows.withColumn("max_value", F.lit(500.0))
        found = jobs.unique_alerts([
            (rows, alerts.drift_alerts),
            (anomalous, partial(alerts.anomaly_alerts, low=0.0, high=10.0, prediction="max_value")),
        ], repeats="7 days")
        jobs.alert_stream(found, lambda batch: batch, log, checkpoint=str(tmp_path / "c")).awaitTermination()
        kept = spark.read.schema(SEEN).option("recursiveFileLookup", True).json(log)
        return sorted((r.source, r.feature, r.window_start[8:10]) for r in kept.collect())

    with_time(spark, source, [drifting(1), drifting(1), drifting(1, "f2")])
    with_time(spark, source, [drifting(1), drifting(2)])
    one = [(s, f, d) for s in ("anomaly_detection", "drift_detector") for f, d in (("f1", "01"), ("f1", "02"), ("f2", "01"))]
    assert run() == one
    with_time(spark, source, [drifting(2), drifting(1, "f2"), drifting(3)])
    assert run() == sorted(one + [("anomaly_detection", "f1", "03"), ("drift_detector", "f1", "03")])
    assert len(run()) == 8


EVENTS = "ts timestamp, value double, kind string"


def events(day, hours, value=1.0):
    import datetime

    return [(datetime.datetime(2024, 1, day, h), value, "a") for h in hours]


def test_late_rows_are_counted_and_a_stopped_stream_goes_on(spark, tmp_path):
    source, out = str(tmp_path / "events"), str(tmp_path / "volume")

    def run():
        rows = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(source)
        stream = jobs.prediction_volume(rows, "1 day", "1 hour", by=["kind"])
        found = jobs.run_available(stream, out)
        return sorted((r.window_start[8:10], r.n_predictions) for r in found.collect())

    put(spark, source, events(1, range(5)), EVENTS)
    put(spark, source, events(2, range(3)), EVENTS)
    assert run() == [("01", 5)]
    late = spark.read.parquet(f"{out}-late")
    assert late.agg(F.sum("rows_dropped_late")).first()[0] == 0
    put(spark, source, events(1, [7, 8]) + events(2, [5]), EVENTS)  # two rows of a closed window, one of an open one
    put(spark, source, events(3, range(2)), EVENTS)
    put(spark, source, events(4, [12]), EVENTS)
    assert run() == [("01", 5), ("02", 4), ("03", 2)]
    late = spark.read.parquet(f"{out}-late").agg(F.sum("rows_dropped_late").alias("n"), F.countDistinct("batch").alias("b")).first()
    assert late["n"] == 1 and late["b"] >= 4  # the two rows were one partial count of one window when they were dropped
    assert run() == [("01", 5), ("02", 4), ("03", 2)]


def test_a_failing_batch_is_done_again(spark, tmp_path):
    source, log = str(tmp_path / "reports"), str(tmp_path / "alerts")
    with_time(spark, source, [drifting(1)])
    with_time(spark, source, [drifting(1), drifting(2)])
    broken = {"left": 1}

    def rule(batch):
        if broken["left"] and batch.where("window_start LIKE '2024-01-02%'").count():
            broken["left"] -= 1
            raise RuntimeError("lost")
        return batch

    def start():
        rows = spark.readStream.schema(REPORT).option("maxFilesPerTrigger", 1).parquet(source)
        found = jobs.unique_alerts([(rows, alerts.drift_alerts)], repeats="7 days")
        jobs.alert_stream(found, rule, log, checkpoint=str(tmp_path / "c")).awaitTermination()

    with pytest.raises(Exception, match="lost"):
        start()
    start()
    kept = spark.read.schema(SEEN).option("recursiveFileLookup", True).json(log)
    assert sorted(r.window_start[8:10] for r in kept.collect()) == ["01", "02"]
