"""Queries for sources, column operators, lookups and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeflow import fixed_values as fv
from gaugeflow.catalog.data import row_form, stored_features, stored_view, table
from gaugeflow.catalog.registry import query, rounded
from gaugeflow.catalog.twins import (
    CENTROIDS, CLEANED, COLUMNS, FEATURE_DOUBLES, FEATURE_NUMBERS, INDICATORS, TEXTS, coordinate,
    features_from, normalised, num, number, region, rnd, select_rounded, share, text,
)
from gaugeflow.functions.scalars import type_bounds
from gaugeflow.operators import columns as ops
from gaugeflow.operators import lookups
from gaugeflow.operators.split import split_train_val_test
from gaugeflow.plans.clean import extreme_flag
from gaugeflow.sources.files import read_indicators, read_parquet, write_features_csv, write_parquet
from gaugeflow.storage import new_path

VIEW = f"WITH {INDICATORS}\n"


# --- sources ------------------------------------------------------------------------------------
@query("read_indicators", VIEW + "SELECT " + ", ".join(
    f'''CASE WHEN "{c}" NOT IN ({", ".join(text(m) for m in fv.MISSING_MARKERS)}) THEN "{c}" END AS "{c}"'''
    if c in TEXTS else f'"{c}"' for c in COLUMNS
) + " FROM ind")
def _read_indicators(spark, folder):
    view, path = stored_view(spark, folder), new_path(spark, "csv")
    write_features_csv(view, path)
    return read_indicators(spark, path, view.schema)


@query("write_features_csv", f"WITH {CLEANED},\n{features_from('cleaned')}\n" + select_rounded(
    FEATURE_NUMBERS + ["active_features"], FEATURE_DOUBLES, "features"))
def _write_features_csv(spark, folder):
    features, path = stored_features(spark, folder), new_path(spark, "features-csv")
    write_features_csv(features, path)
    back = read_indicators(spark, path, features.schema)
    return rounded(row_form(back))


@query("read_write_parquet", VIEW + f'''
SELECT "DataValueType", "YearStart", count(*) AS n_rows, count("DataValue") AS n_values FROM ind GROUP BY 1, 2''')
def _read_write_parquet(spark, folder):
    path = new_path(spark, "parquet")
    write_parquet(stored_view(spark, folder), path, partition_by=["DataValueType"])
    back = read_parquet(spark, path, ["DataValueType", "YearStart", "DataValue"])
    return back.groupBy("DataValueType", "YearStart").agg(
        F.count("*").alias("n_rows"), F.count("DataValue").alias("n_values")
    )


# --- column operators ---------------------------------------------------------------------------
@query("strip_column_names", 'SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer')
def _strip_column_names(spark, folder):
    padded = table(spark, folder, "customer").selectExpr(
        "c_custkey as ` c_custkey`", "c_name as `c_name  `", "c_acctbal as `\tc_acctbal`", "c_mktsegment"
    )
    return ops.strip_column_names(padded)


@query("normalise_strings", VIEW + "SELECT " + ", ".join(
    f'{normalised(c)} AS "{c}"' if c in TEXTS else f'"{c}"' for c in COLUMNS) + " FROM ind")
def _normalise_strings(spark, folder):
    return ops.normalise_strings(stored_view(spark, folder))


ODD_TEXTS = ["1_000", "1d", "NaN", "inf", "-Infinity", "1,000", "0x1F", "", "1e3", "+.5", "7."]


@query("coerce_numeric", f"""
WITH odd AS (
  SELECT event_id, CASE WHEN event_id % 20 < {len(ODD_TEXTS)}
    THEN [{", ".join(text(t) for t in ODD_TEXTS)}][event_id % 20 + 1]
    WHEN event_id % 20 = 11 THEN NULL WHEN event_id % 20 = 12 THEN '  ' || CAST(value AS VARCHAR) || ' '
    ELSE CAST(value AS VARCHAR) END AS raw
  FROM events)
SELECT event_id, {number("raw")} AS raw FROM odd""")
def _coerce_numeric(spark, folder):
    place = (F.col("event_id") % 20).cast("int")
    shown = F.col("value").cast("string")
    raw = (
        F.when(place < len(ODD_TEXTS), F.element_at(F.array(*[F.lit(t) for t in ODD_TEXTS]), place % len(ODD_TEXTS) + 1))
        .when(place == 11, F.lit(None)).when(place == 12, F.concat(F.lit("  "), shown, F.lit(" "))).otherwise(shown)
    )
    return ops.coerce_numeric(table(spark, folder, "events").select("event_id", raw.alias("raw")), ["raw"])


@query("drop_columns", VIEW + "SELECT " + ", ".join(
    f'"{c}"' for c in COLUMNS if c not in fv.IDENTIFIER_COLUMNS) + " FROM ind")
def _drop_columns(spark, folder):
    return ops.drop_columns(stored_view(spark, folder), fv.IDENTIFIER_COLUMNS)


@query("ci_width", VIEW + f'''
SELECT "ResponseID", {rnd('"HighConfidenceLimit" - "LowConfidenceLimit"')} AS "ConfidenceIntervalWidth" FROM ind''')
def _ci_width(spark, folder):
    return rounded(ops.ci_width(stored_view(spark, folder)).select("ResponseID", "ConfidenceIntervalWidth"))


@query("geo_extract", VIEW + f'''
SELECT "ResponseID", "GeoLocation", {coordinate(fv.LATITUDE_PATTERN)} AS "Latitude",
  {coordinate(fv.LONGITUDE_PATTERN)} AS "Longitude" FROM ind''')
def _geo_extract(spark, folder):
    return ops.geo_extract(stored_view(spark, folder)).select("ResponseID", "GeoLocation", "Latitude", "Longitude")


@query("years_since", VIEW + f'''
SELECT {", ".join(f'"{c}"' for c in COLUMNS if c != "YearEnd")}, "YearStart" - 2020 AS "YearsSince2020" FROM ind''')
def _years_since(spark, folder):
    return ops.years_since(stored_view(spark, folder))


@query("missing_flag", VIEW + f'''
SELECT "ResponseID", "DataValue", CAST({number('"DataValue"')} IS NULL AS INTEGER) AS "DataValue_Missing_Flag" FROM ind''')
def _missing_flag(spark, folder):
    view = stored_view(spark, folder).select("ResponseID", F.col("DataValue").alias("text"), "DataValue")
    flagged = ops.missing_flag(ops.coerce_numeric(view, ["DataValue"]))
    return flagged.select("ResponseID", F.col("text").alias("DataValue"), "DataValue_Missing_Flag")


@query("ci_missing_flag", VIEW + '''
SELECT "ResponseID", "LowConfidenceLimit", "HighConfidenceLimit",
  CAST("LowConfidenceLimit" IS NULL OR "HighConfidenceLimit" IS NULL AS INTEGER) AS "CI_Missing_Flag" FROM ind''')
def _ci_missing_flag(spark, folder):
    return ops.ci_missing_flag(stored_view(spark, folder)).select(
        "ResponseID", "LowConfidenceLimit", "HighConfidenceLimit", "CI_Missing_Flag"
    )


@query("extreme_flag", """
WITH single AS (SELECT DISTINCT l_orderkey, l_partkey, l_extendedprice FROM lineitem),
top AS (SELECT quantile_cont(l_extendedprice, 0.99) AS p99 FROM single)
SELECT single.*, CAST(l_extendedprice > p99 AS INTEGER) AS "l_extendedprice_Extreme_Flag" FROM single, top""")
def _extreme_flag(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    return extreme_flag(lookups.dedupe_full_row(lines), "l_extendedprice")


@query("clip_range", """
SELECT o_orderkey, CAST(least(greatest(year(o_orderdate), 1997), 2000) AS INTEGER) AS order_year,
  least(greatest(o_totalprice, 1997), 2000)::DOUBLE AS o_totalprice FROM orders""")
def _clip_range(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", F.year("o_orderdate").alias("order_year"), "o_totalprice")
    return ops.clip_range(orders, ["order_year", "o_totalprice", "absent"], (1997, 2000))


@query("ensure_all_numeric", VIEW + "SELECT " + ", ".join(
    f'{number(c)} AS "{c}"' if c in TEXTS else f'"{c}"' for c in COLUMNS) + " FROM ind")
def _ensure_all_numeric(spark, folder):
    return ops.ensure_all_numeric(stored_view(spark, folder))


@query("drop_non_numeric", VIEW + "SELECT " + ", ".join(f'"{c}"' for c in COLUMNS if c not in TEXTS) + " FROM ind")
def _drop_non_numeric(spark, folder):
    return ops.drop_non_numeric(stored_view(spark, folder))


def _ladder(lines, side: int) -> str:
    tests = " ".join(
        "WHEN " + " OR ".join(f"contains(lower(t), {text(w)})" for w in line[0]) + f" THEN {num(line[side])}"
        for line in lines
    )
    return f"CASE {tests} ELSE {num(fv.OTHER_BOUNDS[side - 1])} END"


@query("metric_type_bounds", VIEW + f'''
, types AS (SELECT "DataValueType" || CASE "LocationID" % 3 WHEN 0 THEN '' WHEN 1 THEN ' Yes/No' ELSE ' MEDIAN' END AS t FROM ind)
SELECT t AS type, {_ladder(fv.VALUE_BOUNDS, 1)} AS value_low, {_ladder(fv.VALUE_BOUNDS, 2)} AS value_high,
  {_ladder(fv.LIMIT_BOUNDS, 1)} AS limit_low, {_ladder(fv.LIMIT_BOUNDS, 2)} AS limit_high, count(*) AS n_rows
FROM types GROUP BY 1, 2, 3, 4, 5''')
def _metric_type_bounds(spark, folder):
    extra = F.when(F.col("LocationID") % 3 == 0, F.lit("")).when(F.col("LocationID") % 3 == 1, F.lit(" Yes/No")).otherwise(F.lit(" MEDIAN"))
    types = stored_view(spark, folder).select(F.concat("DataValueType", extra).alias("type"))
    value, limit = type_bounds(F.col("type"), "DataValue"), type_bounds(F.col("type"), "LowConfidenceLimit")
    return types.groupBy("type").agg(F.count("*").alias("n_rows")).select(
        "type", value[0].alias("value_low"), value[1].alias("value_high"),
        limit[0].alias("limit_low"), limit[1].alias("limit_high"), "n_rows",
    )


# --- lookups, overlaps, unions, duplicates ----------------------------------------------------------
@query("region_lookup", VIEW + f'''SELECT "ResponseID", "LocationAbbr", {region('"LocationAbbr"')} AS "US_Region" FROM ind''')
def _region_lookup(spark, folder):
    return lookups.region_lookup(stored_view(spark, folder).select("ResponseID", "LocationAbbr"))


@query("centroid_fill", VIEW + f''', {CENTROIDS},
located AS (SELECT "ResponseID", "LocationAbbr", {coordinate(fv.LATITUDE_PATTERN)} AS lat0,
  {coordinate(fv.LONGITUDE_PATTERN)} AS lon0 FROM ind)
SELECT "ResponseID", "LocationAbbr", coalesce(lat0, centre_lat, {num(fv.COUNTRY_CENTROID[0])}) AS "Latitude",
  coalesce(lon0, centre_lon, {num(fv.COUNTRY_CENTROID[1])}) AS "Longitude"
FROM located LEFT JOIN centres ON "LocationAbbr" = state''')
def _centroid_fill(spark, folder):
    located = ops.geo_extract(stored_view(spark, folder).select("ResponseID", "LocationAbbr", "GeoLocation"))
    return lookups.centroid_fill(located).drop("GeoLocation")


@query("split_overlap", """
SELECT l_orderkey AS order_id, count(*) AS n_rows FROM lineitem
WHERE l_returnflag = 'A' AND l_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag <> 'A') GROUP BY 1""")
def _split_overlap(spark, folder):
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("order_id"), "l_returnflag")
    return lookups.split_overlap(
        lines.where("l_returnflag <> 'A'"), lines.where("l_returnflag = 'A'"), "order_id"
    )


@query("unexpected_members", VIEW + f'''
SELECT "LocationAbbr" AS member, count(*) AS n_rows FROM ind
WHERE "LocationAbbr" NOT IN ({", ".join(text(s) for s in fv.STATES)}) GROUP BY 1''')
def _unexpected_members(spark, folder):
    return lookups.unexpected_members(stored_view(spark, folder))


WANTED = [*fv.REQUIRED_COLUMNS, "DataValueAlt"]


@query("schema_diff", VIEW + ", counted AS (SELECT " + ", ".join(
    f'count("{c}") AS "{c}"' for c in fv.REQUIRED_COLUMNS) + " FROM ind)\n" + " UNION ALL ".join(
    f'''SELECT {text(c)} AS "column", {"true" if c in COLUMNS else "false"} AS present,
    {f'"{c}"' if c in COLUMNS else "CAST(NULL AS BIGINT)"} AS n_values FROM counted''' for c in WANTED))
def _schema_diff(spark, folder):
    return lookups.schema_diff(stored_view(spark, folder), WANTED)


@query("union_train_val", f"""
WITH shared AS (SELECT event_id, value, {share(42, "event_id")} AS s FROM events)
SELECT event_id, value, CASE WHEN s < {num(1.0 - 0.1 - 0.2)} THEN 'train' ELSE 'val' END AS split
FROM shared WHERE s < {num(1.0 - 0.1 - 0.2 + 0.1)}""")
def _union_train_val(spark, folder):
    # The target range filter keeps every event here, so the union is the whole of both parts.
    parts = split_train_val_test(table(spark, folder, "events").select("event_id", "value"), "value", "event_id")
    return lookups.union_parts(parts.where("split = 'train'"), parts.where("split = 'val'"))


@query("dedupe_full_row", VIEW + "SELECT DISTINCT * FROM ind")
def _dedupe_full_row(spark, folder):
    return lookups.dedupe_full_row(stored_view(spark, folder))


@query("count_duplicates", VIEW + """
SELECT count(*) AS n_rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM ind)) AS n_duplicates FROM ind""")
def _count_duplicates(spark, folder):
    return lookups.count_duplicates(stored_view(spark, folder))


@query("distinct_values", 'SELECT DISTINCT p_name AS member FROM part WHERE p_name IS NOT NULL')
def _distinct_values(spark, folder):
    return lookups.distinct_values(table(spark, folder, "part"), "p_name")

