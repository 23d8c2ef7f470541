"""An indicator table derived from an order star schema, with gaps, text noise and copies put in by rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.storage import spread

LOCATIONS = [
    "CA", "NY", "TX", "FL", "IL", "PA", "OH", "GA", "NC", "MI", "NJ", "VA", "WA",
    "AZ", "MA", "TN", "IN", "MO", "MD", "WI", "CO", "MN", "PR", "US", "XX",
]
# Order priority -> (metric type, unit, divisor of the price in cents).
METRICS = [
    ("1-URGENT", "Crude Prevalence", "%", 1100),
    ("2-HIGH", "Age-adjusted Rate", "per 100,000", 25),
    ("3-MEDIUM", "Number", "number", 1),
    ("4-NOT SPECIFIED", "Mean", "number", 20),
    ("5-LOW", "US Dollars", "$", 1),
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{folder}/{name}.parquet"))


def _by_metric(column, place: int):
    expr = F.lit(None)
    for row in reversed(METRICS):
        expr = F.when(column == row[0], F.lit(row[place])).otherwise(expr)
    return expr


def indicator_view(spark: SparkSession, folder: str, copies: bool = True) -> DataFrame:
    """The raw indicator table. ``copies`` repeats about two percent of the rows."""
    # Lines are the large side: they are joined twice, to their part and to an order that knows its customer, so without
    # broadcasts they are shuffled twice and not once for every table. Years travel instead of times, nations are 25 rows.
    bought = table(spark, folder, "lineitem").withColumn("ship_year", F.year("l_shipdate")).drop("l_shipdate").join(
        table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    placed = table(spark, folder, "orders").withColumn("order_year", F.year("o_orderdate")).drop("o_orderdate").join(
        table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    joined = bought.join(placed, F.col("l_orderkey") == F.col("o_orderkey")).join(
        F.broadcast(table(spark, folder, "nation")), F.col("c_nationkey") == F.col("n_nationkey")
    )
    order_year, ship_year = F.col("order_year") + 15, F.col("ship_year") + 15
    noise = (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 10
    far = F.when((F.col("l_orderkey") * 13 + F.col("l_linenumber")) % 100 == 0, 40).otherwise(1)
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    value = F.floor(cents / _by_metric(F.col("o_orderpriority"), 3)) * far / 100.0
    no_limit = (F.col("l_orderkey") * 3 + F.col("l_linenumber")) % 9
    place = (F.col("l_partkey") + F.col("l_suppkey")) % 11
    lat = (F.col("l_partkey") % 250 + 250) / 10.0
    lon = (F.col("l_suppkey") % 600 - 1250) / 10.0
    group_noise = (F.col("l_orderkey") + F.col("l_linenumber")) % 23
    segment = F.col("c_mktsegment")
    view = joined.select(
        F.least(order_year, ship_year).alias("YearStart"),
        F.greatest(order_year, ship_year).alias("YearEnd"),
        F.element_at(F.array(*[F.lit(x) for x in LOCATIONS]), F.col("n_nationkey") + 1).alias("LocationAbbr"),
        F.col("n_name").alias("LocationDesc"),
        F.col("p_type").alias("Topic"),
        F.col("p_name").alias("Question"),
        F.when(noise == 0, F.lit("")).when(noise == 1, F.lit("Suppressed")).when(noise > 2, value.cast("string"))
        .alias("DataValue"),
        _by_metric(F.col("o_orderpriority"), 2).alias("DataValueUnit"),
        _by_metric(F.col("o_orderpriority"), 1).alias("DataValueType"),
        F.when(no_limit != 0, value * 0.96).alias("LowConfidenceLimit"),
        F.when(no_limit != 1, value * 1.04).alias("HighConfidenceLimit"),
        F.when(group_noise == 0, F.lit(None)).when(group_noise == 1, F.lit(" \t "))
        .when(group_noise == 2, F.concat(F.lit("\t"), segment, F.lit("\u00a0")))
        .when(group_noise == 3, F.concat(F.lit("  "), segment)).otherwise(segment).alias("Stratification1"),
        F.when(group_noise == 4, F.lit(None)).otherwise(F.lit("Segment")).alias("StratificationCategory1"),
        F.lit(None).cast("string").alias("Stratification2"),
        F.when(place == 1, F.concat(F.lit("POINT ("), lon.cast("string"), F.lit(" "), lat.cast("string"), F.lit(")")))
        .when(place > 1, F.concat(F.lit("("), lat.cast("string"), F.lit(", "), lon.cast("string"), F.lit(")")))
        .alias("GeoLocation"),
        F.concat_ws("-", F.lit("R"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    F.col("l_quantity").cast("int")).alias("ResponseID"),
        F.col("n_nationkey").alias("LocationID"),
        F.concat(F.lit("T"), F.col("p_size").cast("string")).alias("TopicID"),
        F.col("o_orderstatus").alias("DataSource"),
        F.when(F.col("l_orderkey") % 50 == 0, 2).otherwise(1).alias("__copies"),
    )
    if copies:
        view = view.withColumn("__copy", F.explode(F.sequence(F.lit(1), "__copies"))).drop("__copy")
    return view.drop("__copies")
