from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeflow.operators import checks, encode, impute, inject, outliers, profile, ranking


def values(df, column):
    return [r[column] for r in df.collect()]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "a int")
    assert profile.not_empty(empty).first()[0] is False
    with pytest.raises(ValueError, match="empty"):
        profile.not_empty(empty, on_fail="raise")


def test_reports_on_zero_rows_give_null(spark, small_table):
    empty = small_table.limit(0)
    assert profile.null_profile(empty).where("column = '*'").first()["null_pct"] is None
    assert profile.numeric_validity(empty).first()["valid_pct"] is None
    assert checks.raw_validation_suite(empty).where("check = 'not_empty'").first()["status"] == "error"


def test_plain_range_names_both_bounds(spark):
    df = spark.createDataFrame([(1800,), (2020,)], "YearStart int")
    with pytest.raises(ValueError, match="outside .*2000.*2030"):
        checks.range_check_global(df, {"YearStart": (2000, 2030)}, on_fail="raise")
    ok = spark.createDataFrame([(2020,), (2021,), (None,)], "YearStart int")
    assert checks.range_check_global(ok, {"YearStart": (2000, 2030)}, on_fail="raise").first()["status"] == "ok"


def test_range_by_type_fails_above_five_percent(spark):
    rows = [("Prevalence", "50", 1.0)] * 18 + [("Prevalence", "500", 1.0)] + [("Rate", "500", 1.0)] * 3 + [(None, "-1", 1.0)]
    df = spark.createDataFrame(rows, "DataValueType string, DataValue string, LowConfidenceLimit double")
    found = {(r["column"], r["type"]): r for r in checks.range_check_by_type(df).collect()}
    hit = found["DataValue", "Prevalence"]
    assert (hit["n_outside"], hit["passed"], hit["samples"]) == (1, False, [500.0])
    assert found["DataValue", "Rate"]["passed"] and len(found) == 4
    with pytest.raises(ValueError, match="Prevalence"):
        checks.range_check_by_type(df, on_fail="raise")


def test_valid_table_passes_the_suite(spark):
    rows = [(2013, "WA", "Washington", "Sleep", "Hours", "7.25", 6.5, 8.0, "Mean"),
            (2016, "KS", "Kansas", "Noise", "Level", "41", 38.0, 44.5, "Percent"),
            (2018, "ME", "Maine", "Water", "Use", None, None, None, "Mean")]
    df = spark.createDataFrame(rows, "YearStart int, LocationAbbr string, LocationDesc string, Topic string, Question string,"
                               " DataValue string, LowConfidenceLimit double, HighConfidenceLimit double, DataValueType string")
    report = checks.raw_validation_suite(df, on_fail="raise")
    assert report.where("status = 'error'").isEmpty()


def test_group_median_then_global(spark):
    df = spark.createDataFrame([("A", 10.0), ("A", None), ("A", 30.0), ("B", None), (None, 7.0), (None, None)], "DataValueType string, DataValue double")
    out = sorted((r["DataValueType"] or "", r["DataValue"]) for r in impute.group_median_impute(df).collect())
    # After the group fill: 10, 20, 30, 7 have values; their median is 15.
    assert out == [("", 7.0), ("", 15.0), ("A", 10.0), ("A", 20.0), ("A", 30.0), ("B", 15.0)]


def test_median_of_all_null_column_stays_null(spark):
    df = spark.createDataFrame([(None, "x", 1), (None, None, None)], "a double, s string, b int")
    out = impute.median_impute_all(df, skip=())
    assert values(out, "a") == [None, None] and values(out, "s") == ["x", "unknown"] and values(out, "b") == [1.0, 1.0]


def test_extreme_value_is_capped(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 1000, 4, 5]], "DataValue double")
    out = values(outliers.iqr_cap(df), "DataValue")
    assert max(out) < 1000 and len(out) == 6
    assert max(out) == pytest.approx(np.quantile([1, 2, 3, 1000, 4, 5], 0.995))


def test_constant_and_quiet_columns_are_not_capped(spark):
    df = spark.createDataFrame([(1.0, float(i)) for i in range(50)] + [(900.0, 25.0)], "flat double, calm double")
    assert outliers.iqr_caps(df) == {}


def test_removal_by_group_matches_pandas_rules(spark):
    rng = np.random.default_rng(5)
    rows = [("big", float(v)) for v in rng.normal(0, 1, 40)] + [("big", 99.0), ("big", None)]
    rows += [("small", float(v)) for v in [1, 2, 500]] + [(None, 1e9)] + [("flat", 3.0)] * 12 + [("none", None)] * 12
    df = spark.createDataFrame(rows, "DataValueType string, v double")
    kept = outliers.outlier_remove_by_group(df, "v").groupBy("DataValueType").count().collect()
    assert {r[0]: r[1] for r in kept} == {"big": 40, "small": 3, None: 1, "flat": 12, "none": 12}
    scored = outliers.outlier_remove_by_group(df, "v", method="zscore").groupBy("DataValueType").count().collect()
    # Equal values have no score, so that group goes; a missing value stays.
    assert {r[0]: r[1] for r in scored} == {"big": 41, "small": 3, None: 1, "none": 12}


def test_one_hot_and_case_collisions(spark):
    df = spark.createDataFrame([("Overall",), ("Male",), ("Female",), (None,), ("male",), ("a.b",)], "s string")
    out = encode.one_hot(df, "s", "Demo")
    assert out.columns == ["Demo_Female", "Demo_Male", "Demo_Overall", "Demo_a_b", "Demo_male_2"]
    assert [sum(r) for r in out.collect()] == [1, 1, 1, 0, 1, 1]
    with pytest.raises(ValueError, match="categories"):
        encode.categories(df, "s", limit=2)


def test_frequent_values_are_kept(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2 + [("c",)] + [(None,)], "q string")
    assert sorted(values(encode.topk_bucket(df, "q", 2), "q")) == ["Other", "Other", "a", "a", "a", "b", "b"]
    assert values(encode.topk_bucket(df, "q", 3), "q")[-1] is None


def test_ml_ready_drops_constants_and_raises(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 3.0)], "flat int, v double")
    assert checks.ml_ready(df).columns == ["v"]
    assert checks.ml_ready(df.limit(1)).columns == ["flat", "v"]
    for bad, message in (("cast(null as double)", "Missing"), ("double('inf')", "Infinite"), ("'x'", "Non-numeric")):
        with pytest.raises(ValueError, match=message):
            checks.ml_ready(df.selectExpr("v", f"{bad} as b"))


def test_numbered_rows_over_many_partitions(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 5003).alias("k")).repartition(13)
    out = ranking.numbered_rows(df, ["k"]).orderBy("k").collect()
    assert [r["row_number"] for r in out] == list(range(1, 5001))
    assert ranking.every_n(df, ["k"], 100).count() == 50


def test_injected_noise_has_its_share_and_repeats_exactly(spark):
    df = spark.range(5000).selectExpr("id", "cast(id as string) as DataValue", "'x' as DataValueType")
    gaps = inject.inject_missing(df, "id", 0.2)
    assert 850 < gaps.where("DataValue is null").count() < 1150
    assert gaps.exceptAll(inject.inject_missing(df.repartition(7), "id", 0.2)).isEmpty()
    assert 5400 < inject.inject_duplicates(df, "id", 0.1).count() < 5600
    far = inject.inject_outliers(df, "id", 0.05).where("DataValueType = 'Number'")
    assert 190 < far.count() < 310 and far.where("double(DataValue) not between 500 and 3000").isEmpty()
