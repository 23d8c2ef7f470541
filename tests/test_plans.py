from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gaugeflow.functions.scalars import quoted
from gaugeflow.plans.clean import clean_data
from gaugeflow.plans.engineer import engineer_features, fit_categories, add_features
from gaugeflow.plans.full_run import prepare
from gaugeflow.plans.indicator_view import indicator_view


def test_cleaning_leaves_no_gap_and_no_copy(spark, small_table):
    out = clean_data(small_table.unionByName(small_table.limit(15)))
    assert out.count() == 100
    gaps = out.agg(*[F.count_if(quoted(c).isNull()).alias(c) for c in out.columns]).first()
    assert set(gaps) == {0}
    assert out.groupBy(*out.columns).count().where("count > 1").isEmpty()
    assert out.agg(F.sum("CI_Missing_Flag")).first()[0] == 0


def test_median_without_type_column_comes_last(spark):
    df = spark.createDataFrame([("10",), (None,), ("30",), ("40",)], "DataValue string")
    assert sorted(r[0] for r in clean_data(df).select("DataValue").collect()) == [10.0, 30.0, 30.0, 40.0]


def test_features_are_numeric_and_each_group_sums_to_one(spark, small_table):
    out = engineer_features(clean_data(small_table))
    assert all(kind in ("int", "double", "bigint") for _, kind in out.dtypes)
    for prefix in ("Region_", "Demo_", "Topic_", "Question_"):
        names = [c for c in out.columns if c.startswith(prefix)]
        assert names
        sums = out.select(sum(quoted(c) for c in names).alias("s")).distinct().collect()
        assert [r["s"] for r in sums] == [1]
    assert {"Demo_Female", "Demo_Male", "Demo_Overall", "YearsSince2020", "Latitude"} <= set(out.columns)
    assert not {"YearEnd", "LocationAbbr", "ResponseID", "DataValueType"} & set(out.columns)


def test_no_region_without_coordinates(spark, small_table):
    out = engineer_features(clean_data(small_table.drop("GeoLocation")))
    assert not [c for c in out.columns if c.startswith("Region_") or c == "Latitude"]


def test_fitted_categories_encode_a_later_batch_alike(spark, small_table):
    cleaned = clean_data(small_table)
    lists = fit_categories(add_features(cleaned))
    later = cleaned.withColumn("Topic", F.lit("New topic"))
    first, second = engineer_features(cleaned, lists), engineer_features(later, lists)
    assert first.columns == second.columns
    topics = [c for c in second.columns if c.startswith("Topic_")]
    assert second.select(sum(quoted(c) for c in topics).alias("s")).distinct().first()["s"] == 0


def test_more_than_twenty_questions_are_bucketed(spark, small_table):
    many = small_table.withColumn("Question", F.concat(F.lit("Q"), (F.monotonically_increasing_id() % 30).cast("string")))
    out = engineer_features(clean_data(many))
    names = [c for c in out.columns if c.startswith("Question_")]
    assert len(names) == 21 and "Question_Other" in names


def test_prepare_raises_on_a_missing_column_and_writes_csv(spark, small_table, tmp_path):
    with pytest.raises(ValueError, match="Missing required columns"):
        prepare(small_table.drop("Topic"))
    out = prepare(small_table, csv_path=str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == out.count()


def test_lines_are_shuffled_twice_without_broadcasts(spark, folder):
    """Once to their part and once to their order; customers and nations are joined on the side of the orders."""
    limits = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    try:
        for limit in limits:
            spark.conf.set(limit, "-1")
        plan = indicator_view(spark, folder)._jdf.queryExecution().sparkPlan().toString()
    finally:
        for limit in limits:
            spark.conf.unset(limit)
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert len(joins) == 3 and sum("l_orderkey" in line or "l_partkey" in line for line in joins) == 2
    assert not any("n_nationkey" in line for line in joins)


def test_cleaning_keeps_no_table_but_the_last(spark, small_table):
    """The table before deduplication goes once the next one is written, and tables are small: zstd."""
    from gaugeflow.plans.clean import clean_data
    from gaugeflow.storage import located, new_path

    system, place = located(spark, new_path(spark, "x").rpartition("/")[0])
    names = lambda: {s.getPath().getName() for s in system.listStatus(place)}
    before = names()
    cleaned = clean_data(small_table)
    made = {n.partition("-")[0]: n for n in names() - before}
    assert "deduplicated" in made and "coerced" not in made
    files = [s.getPath().getName() for s in system.listStatus(located(spark, f"{place}/{made['deduplicated']}")[1])]
    assert any(f.endswith(".zstd.parquet") for f in files) and cleaned.count() == 100
