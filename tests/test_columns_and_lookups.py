from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gaugeflow.functions.scalars import to_number, type_bounds
from gaugeflow.operators import columns as ops
from gaugeflow.operators import checks, lookups
from gaugeflow.sources.files import read_indicators, write_features_csv


def one(df, column):
    return [r[column] for r in df.collect()]


def test_text_is_trimmed_and_missing_text_is_named(spark):
    df = spark.createDataFrame([(" CA ",), ("NY ",), (None,), (" \t",), (" TX",), ("",)], "s string")
    assert one(ops.normalise_strings(df), "s") == ["CA", "NY", "unknown", "Unknown", "TX", "Unknown"]


def test_trim_equals_python_strip(spark):
    texts = [f"{a}x y{b}" for a in "\t\n\x1c\x1f \x85  　" for b in " \xa0 \r"] + ["é ", " ü"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    assert one(ops.normalise_strings(df), "s") == [t.strip() for t in texts]


@pytest.mark.parametrize("text, number", [
    ("12.5", 12.5), (" 7 ", 7.0), ("1e3", 1000.0), (".5", 0.5), ("5.", 5.0), ("-3", -3.0), ("1d", None), ("NaN", None),
    ("1_000", None), ("1,000", None), ("0x1F", None), ("", None), ("Suppressed", None), ("inf", float("inf")),
])
def test_numbers_are_read_strictly(spark, text, number):
    assert spark.createDataFrame([(text,)], "s string").select(to_number(F.col("s"))).first()[0] == number


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "v double")
    assert one(ops.coerce_numeric(df, ["v", "absent"]), "v") == [None, 1.0]


def test_width_years_flags(spark):
    df = spark.createDataFrame([(10.0, 20.0, 2020, 2021), (20.0, None, 2022, 2022)],
                               "LowConfidenceLimit double, HighConfidenceLimit double, YearStart int, YearEnd int")
    assert one(ops.ci_width(df), "ConfidenceIntervalWidth") == [10.0, None]
    years = ops.years_since(df)
    assert one(years, "YearsSince2020") == [0, 2] and "YearEnd" not in years.columns
    assert one(ops.ci_missing_flag(df), "CI_Missing_Flag") == [0, 1]
    value = spark.createDataFrame([("10",), (None,), ("30",)], "DataValue string")
    assert sum(one(ops.missing_flag(ops.coerce_numeric(value, ["DataValue"])), "DataValue_Missing_Flag")) == 1


def test_clip_keeps_nulls(spark):
    df = spark.createDataFrame([(1800,), (None,), (2050,), (2000,)], "YearStart int")
    assert one(ops.clip_range(df), "YearStart") == [1900, None, 2030, 2000]


def test_absent_columns_are_skipped(spark):
    df = spark.createDataFrame([(1,)], "x int")
    for step in (ops.ci_width, ops.geo_extract, ops.years_since, ops.missing_flag, ops.ci_missing_flag,
                 ops.clip_range, lookups.centroid_fill):
        assert step(df).columns == ["x"]


def test_coordinates_and_centroids(spark):
    df = spark.createDataFrame(
        [("(36.0, -115.0)", "NV"), ("POINT (1 2)", "CA"), (None, "XX"), (None, None), ("(40.0, x)", "")],
        "GeoLocation string, LocationAbbr string")
    out = lookups.centroid_fill(ops.geo_extract(df)).collect()
    found = {(r["GeoLocation"], r["LocationAbbr"]): (r["Latitude"], r["Longitude"]) for r in out}
    assert found == {
        ("(36.0, -115.0)", "NV"): (36.0, -115.0), ("POINT (1 2)", "CA"): (36.1162, -119.6816),
        (None, "XX"): (39.8283, -98.5795), (None, None): (39.8283, -98.5795), ("(40.0, x)", ""): (40.0, -98.5795),
    }


def test_regions(spark):
    df = spark.createDataFrame([("CA",), ("PR",), (None,), ("DC",)], "LocationAbbr string")
    found = {r["LocationAbbr"]: r["US_Region"] for r in lookups.region_lookup(df).collect()}
    assert found == {"CA": "West", "PR": "Unknown", None: "Unknown", "DC": "South"}


@pytest.mark.parametrize("label, column, bounds", [
    ("Crude PREVALENCE", "DataValue", (0, 100)), ("Percent rate", "DataValue", (0, 100)), ("Rate", "DataValue", (0, 5000)),
    ("Number", "LowConfidenceLimit", (0, 10_000_000)), ("Yes/No", "DataValue", (0, 1)), ("Median", "DataValue", (0, 10_000)),
    ("Mean dollars", "DataValue", (0, 10_000)), ("Mean dollars", "HighConfidenceLimit", (0, 1_000_000)),
    ("Other", "DataValueAlt", (0, 10_000)),
])
def test_bounds_by_type(spark, label, column, bounds):
    low, high = type_bounds(F.lit(label), column)
    assert tuple(spark.range(1).select(low, high).first()) == bounds
    assert type_bounds(F.lit(label), "YearStart") is None


def test_dedupe_and_counts(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y"), (None, None), (None, None)], "a int, b string")
    assert lookups.dedupe_full_row(df).count() == 3
    assert lookups.count_duplicates(df).first().asDict() == {"n_rows": 5, "n_duplicates": 2}
    assert lookups.count_duplicates(df.limit(0)).first().asDict() == {"n_rows": 0, "n_duplicates": 0}


def test_schema_diff(spark):
    df = spark.createDataFrame([(2020,)], "YearStart int")
    with pytest.raises(ValueError, match="Missing required columns"):
        lookups.schema_diff(df, ["YearStart", "DataValue"], on_fail="raise")
    found = {r["column"]: (r["present"], r["n_values"]) for r in lookups.schema_diff(df, ["YearStart", "DataValue"]).collect()}
    assert found == {"YearStart": (True, 1), "DataValue": (False, None)}


def test_csv_round_trip_keeps_text_and_missing_markers(spark, tmp_path):
    df = spark.createDataFrame([(" a, \"b\" ", 1.5), ("N/A", None), (None, 2.0), ("x\ty", 3.0)], "s string, v double")
    path = str(tmp_path / "t")
    write_features_csv(df, path)
    back = read_indicators(spark, path, df.schema)
    assert {(r["s"], r["v"]) for r in back.collect()} == {(" a, \"b\" ", 1.5), (None, None), (None, 2.0), ("x\ty", 3.0)}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_indicators(spark, str(tmp_path / "absent"), df.schema)


def test_a_wanted_number_of_text_columns_is_read(spark):
    df = spark.createDataFrame([tuple(str(i) for i in range(12)) + (5,)], ", ".join(f"c{i} string" for i in range(12)) + ", n int")
    out = ops.ensure_all_numeric(df, max_coerced=10)
    assert out.columns == [f"c{i}" for i in range(10)] + ["n"]
    assert set(dict(out.dtypes).values()) == {"double", "int"}


def test_booleans_and_times_stay_in_the_feature_table(spark):
    df = spark.sql("SELECT true AS b, DATE'2024-01-02' AS d, TIMESTAMP_NTZ'2024-01-02 03:00:00' AS t, 'x' AS s, 1.5D AS v, array(1) AS a")
    kept = ops.drop_non_numeric(df)
    assert dict(kept.dtypes) == {"b": "int", "d": "date", "t": "timestamp_ntz", "v": "double"} and kept.first()["b"] == 1
    numbers = ops.ensure_all_numeric(kept).first()
    assert numbers["d"] == 1704153600.0 and numbers["t"] - numbers["d"] == 3 * 3600


def test_clashing_names_are_assembled(spark):
    from gaugeflow.operators.encode import assemble_features

    df = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0)], "`a.b` double, a_b double, label double, `x.y` double")
    row = assemble_features(df, "x.y", keep=["a.b"]).first()
    assert row["features"].toArray().tolist() == [1.0, 2.0, 3.0] and row["label"] == 4.0 and row["a.b"] == 1.0


def test_metrics_are_observed_while_a_table_is_written(spark):
    from gaugeflow.storage import materialise_observed

    df = spark.range(100, numPartitions=7).selectExpr("id", "IF(id % 4 = 0, NULL, id) AS v")
    kept, seen = materialise_observed(df, "seen", {"rows": F.count("*"), "gaps": F.count_if(F.col("v").isNull())})
    assert kept.count() == 100 and seen == {"rows": 100, "gaps": 25}
    assert materialise_observed(df.limit(0), "none", {"rows": F.count("*")})[1] == {"rows": 0}


def test_copies_are_counted_by_short_keys_that_tell_all_rows_apart(spark):
    nan = float("nan")
    rows = [("a", None, 1.0), (None, "a", 1.0), ("ab", "c", 1.0), ("a", "bc", 1.0), ("a", "bc", 1.0), ("", None, 0.0),
            (None, "", 0.0), ("x", "y", nan), ("x", "y", nan), ("x", "y", 0.0), ("x", "y", -0.0), (None, None, None)]
    df = spark.createDataFrame(rows, "s string, t string, v double")
    counted = lookups.count_duplicates(df)
    assert counted.first().asDict() == {"n_rows": 12, "n_duplicates": 12 - df.distinct().count()}
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [__d0" in plan and "Aggregate [s" not in plan


def test_cleaning_report_counts_by_short_keys(spark):
    before = spark.createDataFrame([("a", None), ("a", None), (None, "a"), ("b", "c")], "s string, t string")
    after = before.distinct().selectExpr("*", "int(s = 'b') as DataValue_Extreme_Flag")
    report = checks.cleaning_report(before, after)
    assert report.first().asDict() == {
        "rows_before": 4, "rows_after": 3, "rows_removed": 1, "columns_before": 2, "columns_after": 3, "nulls_before": 3,
        "nulls_after": 3, "duplicates_removed": 1, "outliers_handled": 1}
    assert "Aggregate [s" not in report._jdf.queryExecution().optimizedPlan().toString().split("Aggregate [__d0")[1]
