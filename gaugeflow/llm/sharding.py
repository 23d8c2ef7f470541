"""Two-pass external shuffle into shards, in DataFrame operations only."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.functions.scalars import quoted
from gaugeflow.storage import materialise

#: Bytes of one bucket, which a task holds in memory; raise it with the memory of the executors.
BUCKET_BYTES = 16 << 20
#: Bucket offsets are broadcast up to this number of buckets (16 bytes each).
BROADCAST_BUCKETS = 1_000_000
SEED = 20240229


def _before(entry_a, entry_b):
    a, b = entry_a["place"], entry_b["place"]
    return F.when(a < b, -1).when(a > b, 1).otherwise(0)


def row_bytes(rows: DataFrame) -> int:
    """About the bytes that all rows take in memory: texts as they are, nested columns as JSON, 8 for any other column,
    and 48 for each row, so that many small or empty rows count too."""
    sizes = [F.lit(48)]
    for field in rows.schema.fields:
        column = quoted(field.name)
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            sizes.append(F.coalesce(F.octet_length(column), F.lit(0)) + 16)
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            sizes.append(F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)))
        else:
            sizes.append(F.lit(8))
    return rows.agg(F.sum(sum(sizes[1:], sizes[0]).cast("long"))).first()[0] or 0


def shuffle_into_shards(
    docs: DataFrame,
    n_shards: int,
    doc_id: str = "doc_id",
    text: str = "text",
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
    shard: str = "shard",
    slot: str = "slot",
) -> DataFrame:
    """All rows and columns of ``docs`` in random order, with ``shard`` (from 0) and ``slot`` (gapless from 0 in a shard).

    Pass one scatters rows by a seeded hash of id and text into buckets of about ``bucket_bytes``, all columns counted: rows of one source or
    one text are spread, only full repeats of an id with its text share a bucket. Pass two shuffles each bucket with
    Spark's seeded ``shuffle`` of an array, a Fisher-Yates shuffle, and writes it; the order is fixed from then on. The
    rank of a row is the number of rows in earlier buckets plus its place, rank modulo ``n_shards`` is its shard, so
    shard sizes differ by one row at most.

    Ids, texts and other columns may be null or repeated. An empty table gives no rows. Input columns named like
    ``shard`` or ``slot`` are replaced.
    """
    names = [c for c in docs.columns if c not in (shard, slot)]
    buckets = max(1, math.ceil(row_bytes(docs.select(*[quoted(c) for c in names])) / bucket_bytes))
    key = F.xxhash64(F.lit(seed), quoted(doc_id), quoted(text))
    place = F.xxhash64(F.lit(seed + 1), quoted(doc_id), quoted(text))
    scattered = docs.select(
        F.pmod(key, F.lit(buckets)).alias("bucket"),
        F.struct(place.alias("place"), F.struct(*[quoted(c) for c in names]).alias("row")).alias("entry"),
    ).repartition(buckets, "bucket")
    ordered = scattered.groupBy("bucket").agg(F.array_sort(F.collect_list("entry"), _before).alias("entries"))
    shuffled = materialise(
        ordered.select("bucket", F.posexplode(F.shuffle("entries", seed)).alias("place", "entry")).select(
            "bucket", "place", F.col("entry.row").alias("row")
        ), "buckets",
    )
    offsets = bucket_offsets(shuffled, buckets)
    rank = F.col("place") + F.col("offset")
    return shuffled.join(F.broadcast(offsets) if buckets <= BROADCAST_BUCKETS else offsets, "bucket").select(
        *[F.col("row").getField(c).alias(c) for c in names],
        F.pmod(rank, F.lit(n_shards)).cast("int").alias(shard), F.floor(rank / n_shards).cast("long").alias(slot),
    )


def bucket_offsets(rows: DataFrame, buckets: int) -> DataFrame:
    """Rows in all buckets before each one. Sums go over lines of about sqrt(buckets) buckets, then over the lines."""
    wide = math.isqrt(buckets) + 1
    counts = rows.groupBy("bucket").agg(F.count("*").alias("n")).withColumn("line", F.floor(F.col("bucket") / wide))
    earlier = Window.orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    lines = counts.groupBy("line").agg(F.sum("n").alias("n")).select(
        "line", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before_line")
    )
    inside = Window.partitionBy("line").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(lines, "line").select(
        "bucket", (F.col("before") + F.col("before_line")).alias("offset")
    )


def write_shards(shards: DataFrame, path: str, rows_per_file: int = 100_000, shard: str = "shard",
                 slot: str = "slot") -> None:
    """One folder per shard, its rows in slot order in files of at most ``rows_per_file`` rows."""
    part = F.floor(F.col(slot) / rows_per_file)
    shards.repartition(F.col(shard), part).sortWithinPartitions(shard, slot).write.option(
        "maxRecordsPerFile", rows_per_file
    ).partitionBy(shard).parquet(path)
