"""The searched quantiles against numpy, with tiny limits so that every step is taken."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from gaugeflow.operators.quantiles import _Search, quantile_values, quantiles

PROBS = [0.0, 0.005, 0.25, 1 / 3, 0.5, 0.66, 0.99, 1.0]


def brute(values, probs=PROBS):
    return [float(np.quantile(values, p)) for p in probs]


@pytest.mark.parametrize("limit", [30, 4096])
@pytest.mark.parametrize("shape", ["uniform", "heavy", "hot", "two", "negative"])
def test_search_equals_numpy(spark, shape, limit):
    rng = random.Random(7)
    make = {
        "uniform": lambda: rng.uniform(0, 1000),
        "heavy": lambda: 10 ** rng.uniform(-8, 8),
        "hot": lambda: 5.0 if rng.random() < 0.4 else rng.uniform(0, 10),
        "two": lambda: rng.choice([1.0, 2.0]),
        "negative": lambda: rng.gauss(0, 1e6),
    }[shape]
    values = [make() for _ in range(5000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = quantiles(df, ["v"], PROBS, inside_values=limit, sketch=200)[0].first()["v"]
    assert found == pytest.approx(brute(values), rel=1e-12)


def test_search_by_group_with_nulls_and_hot_group(spark):
    rng = random.Random(3)
    rows = []
    for i in range(4000):
        group = "hot" if i % 3 == 0 else (None if i % 7 == 0 else f"g{i % 5}")
        rows.append((group, None if i % 11 == 0 else rng.gauss(0, 10), float(i % 4)))
    rows += [("empty", None, None)] * 5
    df = spark.createDataFrame(rows, "g string, a double, b double")
    direct = {r["g"]: r for r in df.groupBy("g").agg(*[F.percentile(c, PROBS).alias(c) for c in ("a", "b")]).collect()}
    assert {r["g"]: r for r in quantiles(df, ["a", "b"], PROBS, by=["g"])[0].collect()}.keys() == direct.keys()
    searched = {
        r["g"]: r
        for r in quantiles(df, ["a", "b"], PROBS, by=["g"], inside_values=20, sketch=200)[0].collect()
    }
    assert direct.keys() == searched.keys()
    for g, row in direct.items():
        for c in ("a", "b"):
            if row[c] is None:
                assert searched[g][c] is None
            else:
                assert searched[g][c] == pytest.approx(row[c], rel=1e-12)
    assert searched["empty"]["a"] is None


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e9, 1e9, allow_nan=False, width=32), min_size=1, max_size=60))
def test_search_on_any_list(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    found = quantiles(df, ["v"], [0.1, 0.5, 0.9], inside_values=2, sketch=200)[0].first()["v"]
    assert found == pytest.approx(brute(values, [0.1, 0.5, 0.9]), rel=1e-9, abs=1e-9)


def test_all_null_column_has_no_quantile(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    assert quantile_values(df, ["v"], [0.5]) == {"v": None}


def test_approximate_mode_is_close(spark):
    df = spark.range(10001).selectExpr("cast(id as double) as v")
    assert quantile_values(df, ["v"], [0.5], mode="approx")["v"][0] == pytest.approx(5000, abs=5)


def test_infinities_and_nan(spark):
    values = [float("-inf"), 1.0, 2.0, float("inf"), float("inf")]
    df = spark.createDataFrame([(v,) for v in [*values, float("nan"), None]], "v double")
    assert quantile_values(df, ["v"], [0.0, 0.25, 0.75, 1.0])["v"] == [float("-inf"), 1.0, float("inf"), float("inf")]


def test_no_row_is_multiplied_and_three_scans_do(spark, monkeypatch, tmp_path):
    """A million rows of five columns: every aggregate is wide, and the table is read twice or three times."""
    from gaugeflow.operators import quantiles as module

    path = str(tmp_path / "t")
    spark.range(1_000_000).selectExpr(*[f"double((id * {7919 + 2 * i}) % 1000003) AS c{i}" for i in range(5)]).write.parquet(path)
    df = spark.read.parquet(path)
    plans = []
    keep = module.materialise
    monkeypatch.setattr(module, "materialise", lambda d, label: plans.append(d._jdf.queryExecution().optimizedPlan().toString()) or keep(d, label))
    found = quantile_values(df, list(df.columns), [0.01, 0.5, 0.99])
    scans = sum(p.count("Relation [c0") for p in plans)
    assert scans <= 3 and not any("Generate" in p for p in plans)
    for i, row in found.items():
        values = np.array([r[0] for r in df.select(i).collect()])
        assert row == pytest.approx(brute(values, [0.01, 0.5, 0.99]), rel=1e-12)


@pytest.mark.parametrize("keys", [[], ["k0"]])
@pytest.mark.parametrize("gather", [True, False])
def test_only_rows_inside_a_bracket_are_sketched_or_gathered(spark, keys, gather):
    """Counts of all rows are an aggregate of their own, which Spark compiles; sketches and lists see filtered rows."""
    values = spark.range(3000).selectExpr("string(id % 3) as k0", "double(id) as v0").select(*keys, "v0")
    search = _Search(values, keys, 1, [0.25, 0.5], 30, 200)
    brackets = search.started()
    plan = search.measured(brackets, gather)._jdf.queryExecution().optimizedPlan().toString()
    slow = [line for line in plan.splitlines() if "collect_list(" in line or "kll_sketch_agg_double(" in line]
    assert slow and not any("count(" in line for line in slow)


def test_group_without_a_value_inside_its_bracket(spark):
    """One group of equal values and one of a single row beside a wide one."""
    rows = [("same", 4.0)] * 400 + [("one", 7.0), ("none", None)] + [("wide", float(i)) for i in range(2000)]
    found = quantiles(spark.createDataFrame(rows, "g string, v double"), ["v"], [0.1, 0.5], ["g"], inside_values=20, sketch=100)[0]
    got = {r["g"]: r["v"] for r in found.collect()}
    assert got.pop("wide") == pytest.approx([199.9, 999.5])
    assert got == {"same": [4.0, 4.0], "one": [7.0, 7.0], "none": None}
