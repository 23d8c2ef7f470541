"""Scoring and monitoring as Structured Streaming jobs over event time.

Periodic checks run per tumbling window instead of per request counter. Late rows are dropped past the
watermark; a window appears once the watermark has passed its end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeflow import fixed_values as fv
from gaugeflow.functions.scalars import quoted
from gaugeflow.operators.alerts import severity_filter
from gaugeflow.operators.drift import judged, reference_stats_join
from gaugeflow.sources.logs import TIME_FORMAT
from gaugeflow.storage import new_path


#: Time of a window that reports hand on, and what tells one alert from another.
EVENT_TIME, ALERT_KEY = "event_time", ("source", "feature", "window_start")
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keep_state_on_disk(spark: SparkSession) -> None:
    """State of windows and seen alerts in RocksDB, so that it may exceed the executors' memory. For new checkpoints."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)


def utc_time(c: Column) -> Column:
    """Time without zone, read as UTC, as an instant that watermarks accept."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), c).cast("timestamp")


def read_stream(
    spark: SparkSession, folder: str, schema, pattern: str = "*.parquet", time: str = "ts",
    files_per_trigger: int | None = None,
) -> DataFrame:
    source = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_trigger:
        source = source.option("maxFilesPerTrigger", files_per_trigger)
    rows = source.parquet(folder)
    kind = dict(rows.dtypes)[time]
    return rows.withColumn(time, utc_time(F.col(time))) if kind == "timestamp_ntz" else rows


def window_start(c: str = "window") -> Column:
    """Start of a window as UTC text, whatever the session time zone is."""
    start = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(f"{c}.start").cast("timestamp_ntz"))
    return F.date_format(start, "yyyy-MM-dd HH:mm:ss")


def drift_stream(
    rows: DataFrame, columns: Sequence[str], reference: DataFrame, window: str, late: str,
    time: str = "ts", threshold: float = fv.DRIFT_THRESHOLD, keep_time: bool = False,
) -> DataFrame:
    """Drift report per closed window. All columns share one windowed aggregate.

    ``keep_time`` adds ``event_time``, the time of the window, on which further stateful steps can rest.
    """
    held = [F.window_time("window").alias(EVENT_TIME)] if keep_time else []
    wide = rows.withWatermark(time, late).groupBy(F.window(time, window)).agg(*[
        agg.alias(f"{name}{i}") for i, c in enumerate(columns)
        for name, agg in (
            ("mean", F.avg(quoted(c))), ("std", F.stddev_samp(quoted(c))), ("n", F.count(quoted(c))),
        )
    ])
    long = wide.select(*held, window_start().alias("window_start"), F.inline(F.array(*[
        F.struct(
            F.lit(c).alias("feature"), F.col(f"mean{i}").alias("current_mean"), F.col(f"std{i}").alias("current_std"),
            F.col(f"n{i}").alias("n_samples"),
        )
        for i, c in enumerate(columns)
    ])))
    return judged(reference_stats_join(long, reference), threshold).select(
        "window_start", "feature", "status", "ref_mean", "current_mean", "ref_std", "current_std", "deviation",
        "n_samples", "message", *([EVENT_TIME] if keep_time else []),
    )


def outlier_stream(
    rows: DataFrame, bounds: Mapping[str, tuple[float, float]], window: str, late: str, time: str = "ts",
    keep_time: bool = False,
) -> DataFrame:
    """Values beyond the fitted fences per closed window and column. ``keep_time`` as in ``drift_stream``."""
    held = [F.window_time("window").alias(EVENT_TIME)] if keep_time else []
    cols = list(bounds)
    wide = rows.withWatermark(time, late).groupBy(F.window(time, window)).agg(*[
        agg.alias(f"{name}{i}") for i, c in enumerate(cols)
        for name, agg in (
            ("out", F.count_if((quoted(c) < bounds[c][0]) | (quoted(c) > bounds[c][1]))),
            ("n", F.count(quoted(c))), ("min", F.min(quoted(c))), ("max", F.max(quoted(c))),
        )
    ])
    return wide.select(*held, window_start().alias("window_start"), F.inline(F.array(*[
        F.struct(
            F.lit(c).alias("feature"), F.col(f"out{i}").alias("outlier_count"), F.col(f"n{i}").alias("n_values"),
            F.col(f"min{i}").alias("min_value"), F.col(f"max{i}").alias("max_value"),
        )
        for i, c in enumerate(cols)
    ]))).where(F.col("outlier_count") > 0)


def prediction_volume(
    scored: DataFrame, window: str, late: str, by: Sequence[str] = (), time: str = "ts",
    missing: str | None = None,
) -> DataFrame:
    """Scored rows and missing features per closed window."""
    counted = F.sum(quoted(missing).cast("bigint")) if missing else F.lit(0).cast("bigint")
    return (
        scored.withWatermark(time, late).groupBy(F.window(time, window), *[quoted(b) for b in by])
        .agg(F.count("*").alias("n_predictions"), counted.alias("missing_features"))
        .select(window_start().alias("window_start"), *[quoted(b) for b in by], "n_predictions", "missing_features")
    )


#: Default trigger: process what is there and stop. ``{"processingTime": "1 minute"}`` keeps a stream up.
AVAILABLE = {"availableNow": True}


def run_available(stream: DataFrame, path: str | None = None, label: str = "stream", form: str = "parquet") -> DataFrame:
    """Process what is there, append to files with a checkpoint, and read the result.

    Called again with the same path it goes on where it stopped. Rows that came too late are counted in the parquet table
    ``{path}-late``, one row per batch and stateful step.
    """
    spark = stream.sparkSession
    path = path or new_path(spark, label)
    query = (
        stream.writeStream.format(form).option("path", path).option("checkpointLocation", f"{path}-progress")
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    note_late_rows(query, spark, f"{path}-late")
    return spark.read.schema(stream.schema).format(form).load(path)


def unique_alerts(
    sources: Sequence[tuple[DataFrame, Callable[..., DataFrame]]], repeats: str | None = None,
) -> DataFrame:
    """Alerts of several report streams and their rules as one stream, each (source, feature, window) once.

    A report stream has ``feature``, ``window_start`` and ``event_time``. A report that comes again, in the same batch or a
    later one, by replay or by mistake, gives no second alert: the keys of alerts stand in the state store until the
    watermark has passed them. Windows of the library's own streams carry their watermark; for reports from elsewhere
    ``repeats`` tells how late a repeat may come. A rule is called with ``keep``, the columns it has to hand on.
    """
    keys = ["feature", "window_start", EVENT_TIME]
    found = []
    for reports, rule in sources:
        timed = reports.withWatermark(EVENT_TIME, repeats) if repeats else reports
        found.append(rule(timed, keep=keys, timestamp=F.current_timestamp()))
    return reduce(DataFrame.unionByName, found).dropDuplicatesWithinWatermark(list(ALERT_KEY))


def alert_stream(
    reports: DataFrame, to_alerts: Callable[[DataFrame], DataFrame], log_path: str, minimum: str = "warning",
    checkpoint: str | None = None, trigger: Mapping[str, object] = AVAILABLE,
) -> StreamingQuery:
    """Append the alerts of each micro-batch to the alert log. For a stream of ``unique_alerts`` the rule is the identity.

    A batch replayed after a failure goes to the same folder and replaces its earlier output, so no alert is
    logged twice. Folders carry the place of the checkpoint, so a stream with a new one leaves earlier alerts alone.
    """
    progress = checkpoint or f"{log_path}-progress"
    run = hashlib.md5(progress.encode()).hexdigest()[:12]

    def write(batch: DataFrame, number: int) -> None:
        alerts = severity_filter(to_alerts(batch), minimum)
        alerts.write.mode("overwrite").option("timestampFormat", TIME_FORMAT).json(
            f"{log_path}/run={run}/batch={number}"
        )

    return (
        reports.writeStream.foreachBatch(write).outputMode("append")
        .option("checkpointLocation", progress).trigger(**trigger).start()
    )


PROGRESS = "batch long, operator int, name string, rows_total long, rows_dropped_late long"


def late_rows(query: StreamingQuery) -> list[tuple]:
    """One row per batch and stateful step of a query, as far as Spark keeps its progress: rows in state, late rows."""
    return [
        (p["batchId"], i, step["operatorName"], step["numRowsTotal"], step["numRowsDroppedByWatermark"])
        for p in query.recentProgress for i, step in enumerate(p["stateOperators"])
    ]


def note_late_rows(query: StreamingQuery, spark: SparkSession, path: str) -> None:
    """Add what ``late_rows`` tells of a finished run to the table at ``path``."""
    spark.createDataFrame(late_rows(query), PROGRESS).coalesce(1).write.mode("append").parquet(path)


def score_stream(
    rows: DataFrame, score: Callable[[DataFrame], DataFrame], path: str, checkpoint: str | None = None,
    trigger: Mapping[str, object] = AVAILABLE,
) -> StreamingQuery:
    """Score arriving rows with a fitted model and append them as JSON lines."""
    return (
        score(rows).writeStream.format("json").option("timestampFormat", TIME_FORMAT).option("path", path).outputMode("append")
        .option("checkpointLocation", checkpoint or f"{path}-progress").trigger(**trigger).start()
    )
