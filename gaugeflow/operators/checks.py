"""Checks that give a report and, on request, raise: ranges, quality suite, model readiness, scaling, predictions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow import fixed_values as fv
from gaugeflow.functions.scalars import (
    as_number, bounds_ladder, ladder_line, line_bounds, numeric_columns, percent, quoted,
)
from gaugeflow.operators.lookups import count_duplicates, row_digest, schema_diff, unexpected_members
from gaugeflow.operators.profile import (
    not_empty, null_profile, numeric_validity, report_rows, stratification_columns, stratification_profile,
    value_counts_topk, year_profile,
)
from gaugeflow.operators.ranking import first_k_samples

REPORT = "check string, subject string, metric string, value double, text string, status string"


def raise_on(report: DataFrame, failed: Column, message: str, label: str) -> DataFrame:
    """Raise with the number of failing subjects and a few of them named, else hand the report on."""
    bad = report.where(failed).select(F.col(label).cast("string"))
    named = [r[0] for r in bad.take(5)]
    if named:
        raise ValueError(f"{message}: {bad.count()} in all, among them {named}")
    return report


def range_check_by_type(
    df: DataFrame,
    columns: Sequence[str] = tuple(fv.METRIC_COLUMNS),
    type_col: str = fv.VALUE_TYPE,
    max_pct: float = fv.MAX_OUTSIDE_PERCENT,
    samples: int = 5,
    on_fail: str = "report",
) -> DataFrame:
    """Per column and metric type: values outside the type's bounds, their range and first samples."""
    cols = [c for c in columns if c in df.columns]
    # The label is matched once per row and ladder; the lines then give the bounds of every column.
    lined = df.where(quoted(type_col).isNotNull()).select(
        quoted(type_col).alias("type"), *[as_number(df, c).cast("double").alias(f"v{i}") for i, c in enumerate(cols)],
        ladder_line(quoted(type_col), fv.VALUE_BOUNDS).alias("value_line"),
        ladder_line(quoted(type_col), fv.LIMIT_BOUNDS).alias("limit_line"),
    )
    bounds = []
    for c in cols:
        ladder = bounds_ladder(c)
        bounds.append(line_bounds(F.col("value_line" if ladder is fv.VALUE_BOUNDS else "limit_line"), ladder))
    far = [F.when((F.col(f"v{i}") < low) | (F.col(f"v{i}") > high), F.col(f"v{i}")) for i, (low, high) in enumerate(bounds)]
    # One wide aggregate per type; only its few lines become rows of the report.
    wide = lined.groupBy("type", "value_line", "limit_line").agg(*[
        agg.alias(f"{name}{i}") for i in range(len(cols)) for name, agg in (
            ("n", F.count(f"v{i}")), ("out", F.count(far[i])), ("min", F.min(far[i])), ("max", F.max(far[i])),
        )
    ])
    counts = wide.select("type", F.inline(F.array(*[
        F.struct(
            F.lit(c).alias("column"), low.alias("low"), high.alias("high"), F.col(f"n{i}").alias("n_values"),
            F.col(f"out{i}").alias("n_outside"), F.col(f"min{i}").alias("outside_min"), F.col(f"max{i}").alias("outside_max"),
        ) for i, (c, (low, high)) in enumerate(zip(cols, bounds))
    ]))).where(F.col("n_values") > 0)
    # Samples come from the offending cells alone.
    offenders = lined.select("type", F.array(*[
        F.struct(F.lit(c).alias("column"), far[i].alias("v")) for i, c in enumerate(cols)
    ]).alias("cells")).where(F.exists("cells", lambda x: x["v"].isNotNull())).select(
        "type", F.inline(F.filter("cells", lambda x: x["v"].isNotNull()))
    )
    first = first_k_samples(offenders.select("column", "type", "v"), ["column", "type"], "v", samples)
    picked = first.groupBy("column", "type").agg(F.sort_array(F.collect_list("v")).alias("samples"))
    pct = percent(F.col("n_outside"), F.col("n_values"))
    report = counts.join(picked, ["column", "type"], "left").select(
        "column", "type", "low", "high", "n_values", "n_outside", pct.alias("outside_pct"),
        "outside_min", "outside_max", "samples", (pct <= max_pct).alias("passed"),
    )
    if on_fail == "raise":
        raise_on(report, ~F.col("passed"), "values outside expected ranges for", "type")
    return report


def range_check_global(
    df: DataFrame,
    bounds: Mapping[str, tuple[float, float]],
    max_pct: float = fv.MAX_OUTSIDE_PERCENT,
    samples: int = 5,
    on_fail: str = "report",
) -> DataFrame:
    """Per column: values outside one fixed range. Columns without a number are skipped."""
    cols = [c for c in bounds if c in df.columns]
    numbers = df.select(*[as_number(df, c).cast("double").alias(c) for c in cols])
    out = {c: (quoted(c) < F.lit(bounds[c][0])) | (quoted(c) > F.lit(bounds[c][1])) for c in cols}
    wide = numbers.agg(*[
        agg.alias(f"{name}{i}") for i, c in enumerate(cols)
        for name, agg in (("n", F.count(quoted(c))), ("out", F.count_if(out[c])))
    ])
    pct = {c: percent(F.col(f"out{i}"), F.col(f"n{i}")) for i, c in enumerate(cols)}
    rows = report_rows(wide, [
        {
            "column": F.lit(c), "low": F.lit(float(bounds[c][0])), "high": F.lit(float(bounds[c][1])),
            "n_values": F.col(f"n{i}"), "n_outside": F.col(f"out{i}"), "outside_pct": pct[c],
            "status": F.when(F.col(f"out{i}") == 0, F.lit("ok")).when(pct[c] > max_pct, F.lit("error"))
            .otherwise(F.lit("warning")),
        }
        for i, c in enumerate(cols)
    ]).where(F.col("n_values") > 0)
    long = numbers.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.when(out[c], quoted(c)).alias("v")) for c in cols
    ]))).where(F.col("v").isNotNull())
    picked = first_k_samples(long, ["column"], "v", samples).groupBy("column").agg(
        F.sort_array(F.collect_list("v")).alias("samples")
    )
    report = rows.join(F.broadcast(picked), "column", "left")  # one row per checked column
    if on_fail == "raise":
        for r in report.where(F.col("status") == "error").collect():
            raise ValueError(
                f"{r['column']}: {r['n_outside']} of its values lie outside [{r['low']:g}, {r['high']:g}], "
                f"which is {r['outside_pct']:.2f} percent; the first are {r['samples']}"
            )
    return report


def _line(check: str, subject, metric: str, value=None, text=None, status=None) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        (subject if isinstance(subject, Column) else F.lit(subject)).alias("subject"),
        F.lit(metric).alias("metric"),
        (value if value is not None else F.lit(None)).cast("double").alias("value"),
        (text if text is not None else F.lit(None)).cast("string").alias("text"),
        (status if status is not None else F.lit("info")).alias("status"),
    )


def _lines(df: DataFrame, *lines: Column) -> DataFrame:
    return df.select(F.inline(F.array(*lines)))


def _warn(condition: Column) -> Column:
    return F.when(condition, F.lit("warning")).otherwise(F.lit("ok"))


def basic_quality(df: DataFrame, type_col: str = fv.VALUE_TYPE) -> DataFrame:
    """Years, values, strata, locations, completeness and duplicates as report rows; warnings only."""
    parts = []
    if any(c in df.columns for c in ("Year", fv.YEAR_START, fv.YEAR_END)):
        years = year_profile(df)
        parts.append(_lines(years, *[
            _line("year", F.col("column"), m, F.col(m), status=_warn(F.col("warning"))) for m in ("min", "median", "max")
        ]))
    value = next((c for c in ("DataValue", "DataValueAlt") if c in df.columns), None)
    if value:
        valid = numeric_validity(df, value, type_col)
        bad = F.when(F.col("no_numbers_error"), F.lit("error")).otherwise(_warn(F.col("non_numeric_warning")))
        parts.append(_lines(
            valid,
            _line("value", value, "valid_pct", F.col("valid_pct"), status=bad),
            _line("value", value, "min", F.col("min"), status=_warn(F.col("negative_warning"))),
            _line("value", value, "median", F.col("median")),
            _line("value", value, "max", F.col("max"), status=_warn(F.col("above_100_warning"))),
        ))
    if stratification_columns(df):
        strata = stratification_profile(df)
        parts.append(strata.where(F.coalesce("rank", F.lit(1)) == 1).select(
            F.inline(F.array(_line("strata", F.col("column"), "n_distinct", F.col("n_distinct"),
                                   status=_warn(F.col("n_distinct") == 0))))
        ))
        parts.append(strata.where(F.col("value").isNotNull()).select(
            F.inline(F.array(_line("strata", F.col("column"), "top", F.col("n_rows"), F.col("value"))))
        ))
    if "LocationAbbr" in df.columns:
        other = unexpected_members(df)
        parts.append(_lines(other, _line("location", F.col("member"), "not_a_state", F.col("n_rows"))))
    nulls = null_profile(df).where(F.col("column") == "*")
    parts.append(_lines(nulls, _line("nulls", "*", "null_pct", F.col("null_pct"), status=_warn(F.col("warning")))))
    copies = count_duplicates(df)
    parts.append(_lines(copies, _line(
        "duplicates", "*", "n_duplicates", F.col("n_duplicates"), status=_warn(F.col("n_duplicates") > 0)
    )))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def raw_validation_suite(
    df: DataFrame,
    required: Sequence[str] = tuple(fv.REQUIRED_COLUMNS),
    bounds: Mapping[str, tuple[float, float]] = fv.GLOBAL_BOUNDS,
    type_col: str = fv.VALUE_TYPE,
    on_fail: str = "report",
) -> DataFrame:
    """Schema, emptiness, type distribution, range checks and basic quality in one report."""
    typed = [c for c in fv.METRIC_COLUMNS if c in bounds] if type_col in df.columns else []
    plain = {c: b for c, b in bounds.items() if c not in typed}
    schema = schema_diff(df, required, on_fail)
    rows = not_empty(df, on_fail)
    parts = [
        _lines(schema, _line("schema", F.col("column"), "n_values", F.col("n_values"), status=F.when(
            F.col("present"), F.lit("ok")).otherwise(F.lit("error")))),
        _lines(rows, _line("not_empty", "*", "has_rows", F.col("has_rows").cast("int"), status=F.when(
            F.col("has_rows"), F.lit("ok")).otherwise(F.lit("error")))),
    ]
    if type_col in df.columns:
        types = df.where(quoted(type_col).isNotNull()).groupBy(quoted(type_col).alias("t")).agg(F.count("*").alias("n"))
        parts.append(_lines(types, _line("types", F.col("t"), "n_rows", F.col("n"))))
        ranges = range_check_by_type(df, typed, type_col, on_fail=on_fail)
        subject = F.concat_ws(": ", "column", "type")
        status = F.when(F.col("n_outside") == 0, F.lit("ok")).when(F.col("passed"), F.lit("warning")).otherwise(F.lit("error"))
        parts.append(_lines(ranges, _line("range", subject, "outside_pct", F.col("outside_pct"), status=status)))
    if any(c in df.columns for c in plain):
        ranges = range_check_global(df, plain, on_fail=on_fail)
        parts.append(_lines(ranges, _line("range", F.col("column"), "outside_pct", F.col("outside_pct"),
                                          status=F.col("status"))))
    out = basic_quality(df, type_col)
    for part in parts:
        out = out.unionByName(part)
    return out


def post_clean_checks(df: DataFrame, critical: Sequence[str] = tuple(fv.CRITICAL_COLUMNS), value: str = fv.VALUE,
                      on_fail: str = "report") -> DataFrame:
    """After cleaning: nulls in critical columns, duplicates, unreadable values, emptiness."""
    cols = [c for c in critical if c in df.columns]
    not_number = F.count_if(as_number(df, value).isNull()) if value in df.columns else F.lit(0).cast("bigint")
    counts = df.agg(*[F.count_if(quoted(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)],
                    F.count("*").alias("rows"), not_number.alias("bad"))
    items = [("nulls", c, F.col(f"n{i}")) for i, c in enumerate(cols)] + [("not_numeric", value, F.col("bad"))]
    report = report_rows(counts, [
        {"check": F.lit(k), "column": F.lit(c), "n_rows": n, "status": _warn(n > 0)} for k, c, n in items
    ] + [{"check": F.lit("rows"), "column": F.lit("*"), "n_rows": F.col("rows"),
          "status": F.when(F.col("rows") == 0, F.lit("error")).otherwise(F.lit("ok"))}])
    copies = count_duplicates(df).select(
        F.lit("duplicates").alias("check"), F.lit("*").alias("column"), F.col("n_duplicates").alias("n_rows"),
        _warn(F.col("n_duplicates") > 0).alias("status"),
    )
    report = report.unionByName(copies)
    if on_fail == "raise":
        raise_on(report, F.col("status") == "error", "The table is empty after cleaning", "check")
    return report


def ml_ready_report(df: DataFrame, columns: Sequence[str] | None = None, on_fail: str = "report") -> DataFrame:
    """Per column: is it numeric, its nulls, infinities, and whether it is constant."""
    cols = list(columns or df.columns)
    numeric = set(numeric_columns(df))
    infinite = [float("inf"), float("-inf")]
    wide = df.agg(*[
        agg.alias(f"{name}{i}") for i, c in enumerate(cols)
        for name, agg in (
            ("null", F.count_if(quoted(c).isNull())),
            ("inf", F.count_if(quoted(c).cast("double").isin(*infinite)) if c in numeric else F.lit(0).cast("bigint")),
            ("n", F.count(quoted(c))),
            ("low", F.min(quoted(c).cast("double")) if c in numeric else F.lit(None).cast("double")),
            ("high", F.max(quoted(c).cast("double")) if c in numeric else F.lit(None).cast("double")),
        )
    ])
    # A sample deviation of zero means at least two values and all of them equal.
    report = report_rows(wide, [
        {
            "column": F.lit(c), "is_numeric": F.lit(c in numeric), "n_null": F.col(f"null{i}"),
            "n_infinite": F.col(f"inf{i}"),
            "is_constant": F.coalesce((F.col(f"n{i}") > 1) & (F.col(f"low{i}") == F.col(f"high{i}")), F.lit(False)),
        }
        for i, c in enumerate(cols)
    ]).withColumn("too_many_columns", F.lit(len(cols) > fv.MAX_FEATURES))
    if on_fail == "raise":
        raise_on(report, ~F.col("is_numeric"), "Non-numeric columns found", "column")
        raise_on(report, F.col("n_null") > 0, "Missing values found in", "column")
        raise_on(report, F.col("n_infinite") > 0, "Infinite values found in", "column")
    return report


def ml_ready(df: DataFrame, on_fail: str = "raise") -> DataFrame:
    """The table without its constant columns, after the checks passed."""
    report = ml_ready_report(df, on_fail="report").collect()  # one row per column
    if on_fail == "raise":
        for problem, test in (
            ("Non-numeric columns found", lambda r: not r["is_numeric"]),
            ("Missing values found in", lambda r: r["n_null"] > 0),
            ("Infinite values found in", lambda r: r["n_infinite"] > 0),
        ):
            bad = [r["column"] for r in report if test(r)]
            if bad:
                raise ValueError(f"{problem}: {bad}")
    return df.drop(*[r["column"] for r in report if r["is_constant"]])


def input_checks(df: DataFrame, target: str, on_fail: str = "raise") -> DataFrame:
    """Before a fit: numeric, complete and finite features, and a complete target."""
    report = ml_ready_report(df).select(
        "column", (F.col("column") == target).alias("is_target"), "is_numeric", "n_null", "n_infinite",
        (F.col("is_numeric") & (F.col("n_null") == 0)
         & ((F.col("n_infinite") == 0) | (F.col("column") == target))).alias("passed"),
    )
    if on_fail == "raise":
        raise_on(report, ~F.col("passed"), "Columns not fit for training", "column")
    return report


def scaling_check(
    train: DataFrame, test: DataFrame, columns: Sequence[str], scaler: str = "StandardScaler"
) -> DataFrame:
    """How many scaled columns miss their target moments or range, and extreme test values."""
    if scaler == "StandardScaler":
        first = {c: F.abs(F.avg(quoted(c))) > 0.01 for c in columns}
        second = {c: ~F.stddev_samp(quoted(c)).between(0.9, 1.1) for c in columns}
    elif scaler == "MinMaxScaler":
        first = {c: ~F.min(quoted(c)).between(-0.01, 0.01) for c in columns}
        second = {c: ~F.max(quoted(c)).between(0.99, 1.01) for c in columns}
    else:
        raise ValueError(f"unknown scaler: {scaler}")

    def total(tests: dict) -> Column:
        return sum((F.coalesce(t.cast("bigint"), F.lit(0)) for t in tests.values()), F.lit(0).cast("bigint"))

    left = train.agg(total(first).alias("n_first_off"), total(second).alias("n_second_off"))
    right = test.agg(
        F.least(*[F.min(quoted(c)) for c in columns], F.lit(None)).alias("test_min"),
        F.greatest(*[F.max(quoted(c)) for c in columns], F.lit(None)).alias("test_max"),
    )
    r = right.first()
    low, high = F.lit(r["test_min"]).cast("double"), F.lit(r["test_max"]).cast("double")
    return left.select(
        F.lit(scaler).alias("scaler"), "n_first_off", "n_second_off", low.alias("test_min"), high.alias("test_max"),
        F.coalesce((low < -5) | (high > 5), F.lit(False)).alias("extreme_warning"),
    )


def prediction_check(df: DataFrame, prediction: str, label: str, task: str = "regression", on_fail: str = "report") -> DataFrame:
    """NaN, infinite and far-out predictions (regression) or predictions outside 0..1 (classification)."""
    p, y = quoted(prediction).cast("double"), quoted(label).cast("double")
    wide = df.agg(
        F.count_if(p.isNull() | F.isnan(p)).alias("n_nan"),
        F.count_if(p.isin(float("inf"), float("-inf"))).alias("n_infinite"),
        F.min(p).alias("pred_min"), F.max(p).alias("pred_max"),
        F.min(y).alias("target_min"), F.max(y).alias("target_max"),
        F.count_if((p < 0) | (p > 1)).alias("n_outside_unit"),
    )
    spread = 2 * (F.col("target_max") - F.col("target_min"))
    if task == "regression":
        low = F.col("pred_min") < F.col("target_min") - spread
        high = F.col("pred_max") > F.col("target_max") + spread
    else:
        low, high = F.col("pred_min") < 0, F.col("pred_max") > 1
    report = wide.select(
        F.lit(task).alias("task"), "n_nan", "n_infinite", "pred_min", "pred_max", "target_min", "target_max",
        F.coalesce(low, F.lit(False)).alias("low_warning"), F.coalesce(high, F.lit(False)).alias("high_warning"),
    )
    if on_fail == "raise":
        raise_on(report, F.col("n_nan") > 0, "Predictions contain NaN values", "n_nan")
        raise_on(report, F.col("n_infinite") > 0, "Predictions contain infinite values", "n_infinite")
    return report


def cleaning_report(before: DataFrame, after: DataFrame, extreme_flag: str = "DataValue_Extreme_Flag") -> DataFrame:
    """Rows, columns, nulls and duplicates before and after cleaning, and the number of extreme flags."""
    def sizes(df: DataFrame, side: str) -> DataFrame:
        nulls = sum((quoted(c).isNull().cast("bigint") for c in df.columns), F.lit(0).cast("bigint"))
        flagged = quoted(extreme_flag).cast("bigint") if extreme_flag in df.columns else F.lit(0).cast("bigint")
        # Rows are grouped by a digest: whole rows as keys would be shuffled and, in a full group table, sorted on disk.
        copies = df.select(*row_digest(df), nulls.alias("__nulls"), flagged.alias("__flagged")).groupBy("__d0", "__d1").agg(
            F.count("*").alias("__copies"), F.sum("__nulls").alias("__nulls"), F.sum("__flagged").alias("__flagged"))
        return copies.agg(*[
            F.coalesce(F.sum(v), F.lit(0)).alias(name) for name, v in (
                ("rows", F.col("__copies")), ("nulls", F.col("__nulls")), ("duplicates", F.col("__copies") - 1),
                ("flagged", F.col("__flagged")))
        ]).select(F.lit(side).alias("side"), F.lit(len(df.columns)).alias("columns"), "*")

    both = sizes(before, "before").unionByName(sizes(after, "after"))

    def pick(name: str, side: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col(name)))

    return both.agg(
        pick("rows", "before").alias("rows_before"), pick("rows", "after").alias("rows_after"),
        (pick("rows", "before") - pick("rows", "after")).alias("rows_removed"),
        pick("columns", "before").alias("columns_before"), pick("columns", "after").alias("columns_after"),
        pick("nulls", "before").alias("nulls_before"), pick("nulls", "after").alias("nulls_after"),
        (pick("duplicates", "before") - pick("duplicates", "after")).alias("duplicates_removed"),
        pick("flagged", "after").alias("outliers_handled"),
    )
