"""Queries for profiles, validation, imputation, outliers, encoding, ordering and the two plans."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from gaugeflow import fixed_values as fv
from gaugeflow.catalog.data import row_form, stored_view, table
from gaugeflow.catalog.registry import query, rounded
from gaugeflow.catalog.twins import (
    CAPPED, CLEANED, COERCED, COLUMNS, FEATURE_DOUBLES, FEATURE_NUMBERS, FILLED, INDICATORS,
    features_from, num, number, rnd, select_rounded, text,
)
from gaugeflow.operators import checks, encode, impute, outliers, profile, ranking
from gaugeflow.operators.columns import coerce_numeric, normalise_strings
from gaugeflow.plans.clean import clean_data
from gaugeflow.plans.engineer import engineer_features
from gaugeflow.plans.full_run import prepare
from gaugeflow.storage import materialise

VIEW = f"WITH {INDICATORS}\n"
LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


# --- profiles -----------------------------------------------------------------------------------
@query("not_empty", VIEW + "SELECT count(*) > 0 AS has_rows FROM ind")
def _not_empty(spark, folder):
    return profile.not_empty(stored_view(spark, folder))


def _nulls(c: str) -> str:
    return f'count(*) FILTER ("{c}" IS NULL)'


def _null_line(name: str, nulls: str, cells: str) -> str:
    pct = f"100.0::DOUBLE * {nulls} / {cells}"
    return (
        f'SELECT {text(name)} AS "column", CAST({nulls} AS BIGINT) AS n_null, CAST({cells} AS BIGINT) AS n_cells,'
        f" {rnd(pct)} AS null_pct, {pct} > {fv.MAX_NULL_PERCENT} AS warning FROM ind"
    )


ALL_NULLS = "(" + " + ".join(_nulls(c) for c in COLUMNS) + ")"
ALL_CELLS = f"(count(*) * {len(COLUMNS)})"


@query("null_profile", VIEW + union(
    [_null_line(c, _nulls(c), "count(*)") for c in COLUMNS] + [_null_line("*", ALL_NULLS, ALL_CELLS)]))
def _null_profile(spark, folder):
    return rounded(profile.null_profile(stored_view(spark, folder)))


VALUE = number('"DataValue"')


@query("numeric_validity", VIEW + f''', numbers AS (SELECT {VALUE} AS v, "DataValueType" AS t FROM ind)
SELECT 'DataValue' AS "column", count(*) AS n_rows, count(v) AS n_valid, {rnd("100.0::DOUBLE * count(v) / count(*)")} AS valid_pct,
  {rnd("min(v)")} AS min, {rnd("quantile_cont(v, 0.5)")} AS median, {rnd("max(v)")} AS max,
  min(v) < 0 AS negative_warning,
  bool_or(contains(t, 'Prevalence') OR contains(t, 'Percent')) AND max(v) > 100 AS above_100_warning,
  100 - 100.0::DOUBLE * count(v) / count(*) > 20 AS non_numeric_warning, count(v) = 0 AS no_numbers_error
FROM numbers''')
def _numeric_validity(spark, folder):
    return rounded(profile.numeric_validity(stored_view(spark, folder)))


@query("non_numeric_values", VIEW + f'''
SELECT "DataValue" AS value, count(*) AS n_rows FROM ind
WHERE {VALUE} IS NULL AND "DataValue" IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10''')
def _non_numeric_values(spark, folder):
    return profile.non_numeric_values(stored_view(spark, folder))


@query("value_counts_topk", "SELECT p_name AS value, count(*) AS n_rows FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def _value_counts_topk(spark, folder):
    return profile.value_counts_topk(table(spark, folder, "part"), "p_name", 20)


def _year_line(c: str, low: int, high: int) -> str:
    return f'''SELECT {text(c)} AS "column", count("{c}") AS n_valid, min("{c}")::DOUBLE AS min,
  {rnd(f'quantile_cont("{c}", 0.5)')} AS median, max("{c}")::DOUBLE AS max,
  quantile_cont("{c}", 0.5) NOT BETWEEN {low} AND {high} AS warning FROM ind'''


@query("year_profile", VIEW + union([_year_line("YearStart", 1990, 2030), _year_line("YearEnd", 2000, 2030)]))
def _year_profile(spark, folder):
    return rounded(profile.year_profile(stored_view(spark, folder)))


@query("stratification_profile", VIEW + ", strata AS (" + union([
    f'''SELECT {text(c)} AS "column", "{c}" AS value FROM ind'''
    for c in ("Stratification1", "StratificationCategory1", "Stratification2")
]) + '''), counted AS (SELECT "column", value, count(*) AS n_rows FROM strata WHERE value IS NOT NULL GROUP BY 1, 2),
places AS (SELECT *, CAST(row_number() OVER (PARTITION BY "column" ORDER BY n_rows DESC, value) AS INTEGER) AS rank FROM counted),
totals AS (SELECT "column", count(DISTINCT value) AS n_distinct FROM strata GROUP BY 1)
SELECT "column", n_distinct, rank, value, n_rows
FROM totals LEFT JOIN (SELECT * FROM places WHERE rank <= 3) USING ("column")''')
def _stratification_profile(spark, folder):
    return profile.stratification_profile(stored_view(spark, folder))


def stats_sql(columns: list[str], table_name: str, digits: int = 4) -> str:
    return union([
        f"SELECT {text(c)} AS feature, {rnd(f'avg({c})', digits)} AS mean, {rnd(f'stddev_samp({c})', digits)} AS std,"
        f" {rnd(f'min({c})', digits)} AS min, {rnd(f'max({c})', digits)} AS max,"
        f" {rnd(f'quantile_cont({c}, 0.25)', digits)} AS q25, {rnd(f'quantile_cont({c}, 0.5)', digits)} AS q50,"
        f" {rnd(f'quantile_cont({c}, 0.75)', digits)} AS q75, count({c}) AS n FROM {table_name}" for c in columns
    ])


@query("feature_stats", stats_sql(LINE_NUMBERS, "lineitem"))
def _feature_stats(spark, folder):
    return rounded(profile.feature_stats(table(spark, folder, "lineitem"), LINE_NUMBERS), 4)


@query("feature_stats_by_group", f"""
SELECT l_returnflag, 'l_extendedprice' AS feature, {rnd("avg(l_extendedprice)", 4)} AS mean,
  {rnd("stddev_samp(l_extendedprice)", 4)} AS std, min(l_extendedprice) AS min, max(l_extendedprice) AS max,
  {rnd("quantile_cont(l_extendedprice, 0.25)", 4)} AS q25, {rnd("quantile_cont(l_extendedprice, 0.5)", 4)} AS q50,
  {rnd("quantile_cont(l_extendedprice, 0.75)", 4)} AS q75, count(l_extendedprice) AS n FROM lineitem GROUP BY 1""")
def _feature_stats_by_group(spark, folder):
    lines = table(spark, folder, "lineitem")
    return rounded(profile.feature_stats(lines, ["l_extendedprice"], by=["l_returnflag"]), 4)


# --- range checks and suites ------------------------------------------------------------------------
def _bound(lines, side: int) -> str:
    tests = " ".join(
        "WHEN " + " OR ".join(f"contains(lower(type), {text(w)})" for w in line[0]) + f" THEN {num(line[side])}"
        for line in lines
    )
    return f"CASE {tests} ELSE {num(fv.OTHER_BOUNDS[side - 1])} END"


METRICS = ["DataValue", "LowConfidenceLimit", "HighConfidenceLimit"]
TYPED = "typed AS (" + union([
    f'''SELECT {text(c)} AS "column", "DataValueType" AS type, {VALUE if c == "DataValue" else f'"{c}"'} AS v FROM ind
    WHERE "DataValueType" IS NOT NULL''' for c in METRICS
]) + f'''), bounded AS (
  SELECT *, CASE WHEN "column" = 'DataValue' THEN {_bound(fv.VALUE_BOUNDS, 1)} ELSE {_bound(fv.LIMIT_BOUNDS, 1)} END AS low,
    CASE WHEN "column" = 'DataValue' THEN {_bound(fv.VALUE_BOUNDS, 2)} ELSE {_bound(fv.LIMIT_BOUNDS, 2)} END AS high
  FROM typed WHERE v IS NOT NULL
), marked AS (SELECT *, v < low OR v > high AS outside FROM bounded),
typed_report AS (
  SELECT "column", type, low, high, count(*) AS n_values, count(*) FILTER (outside) AS n_outside,
    100.0::DOUBLE * count(*) FILTER (outside) / count(*) AS outside_pct,
    min(v) FILTER (outside) AS outside_min, max(v) FILTER (outside) AS outside_max,
    list_sort(min(v, 5) FILTER (outside)) AS samples
  FROM marked GROUP BY 1, 2, 3, 4)'''


def _samples(column: str) -> str:
    return ", ".join(f"{rnd(f'{column}[{i}]')} AS sample_{i}" for i in range(1, 6))


def sample_columns(df):
    return df.select(*[c for c in df.columns if c != "samples"], *[
        F.get("samples", F.lit(i - 1)).alias(f"sample_{i}") for i in range(1, 6)
    ])


@query("range_check_by_type", VIEW + f''', {TYPED}
SELECT "column", type, low, high, n_values, n_outside, {rnd("outside_pct")} AS outside_pct,
  {rnd("outside_min")} AS outside_min, {rnd("outside_max")} AS outside_max, outside_pct <= 5 AS passed,
  {_samples("samples")} FROM typed_report''')
def _range_check_by_type(spark, folder):
    return rounded(sample_columns(checks.range_check_by_type(stored_view(spark, folder))))


def _global_line(c: str, low: float, high: float, source: str) -> str:
    out = f"({c} < {num(low)} OR {c} > {num(high)})"
    pct = f"100.0::DOUBLE * count(*) FILTER ({out}) / count({c})"
    return f'''SELECT {text(c)} AS "column", {num(low)} AS low, {num(high)} AS high, count({c}) AS n_values,
  count(*) FILTER ({out}) AS n_outside, {rnd(pct)} AS outside_pct,
  CASE WHEN count(*) FILTER ({out}) = 0 THEN 'ok' WHEN {pct} > 5 THEN 'error' ELSE 'warning' END AS status,
  list_sort(min({c}::DOUBLE, 5) FILTER ({out})) AS samples FROM {source}'''


CUSTOMER_BOUNDS = {"c_acctbal": (0.0, 9900.0), "c_nationkey": (0.0, 24.0), "c_custkey": (10.0, 1e12)}


@query("range_check_global", "WITH report AS (" + union([
    _global_line(c, *b, "customer") for c, b in CUSTOMER_BOUNDS.items()
]) + f''') SELECT "column", low, high, n_values, n_outside, outside_pct, status, {_samples("samples")} FROM report''')
def _range_check_global(spark, folder):
    return rounded(sample_columns(checks.range_check_global(table(spark, folder, "customer"), CUSTOMER_BOUNDS)))


def _line(check: str, subject: str, metric: str, value: str, status: str, source: str, shown: str = "CAST(NULL AS VARCHAR)") -> str:
    return (
        f"SELECT {text(check)} AS \"check\", {subject} AS subject, {text(metric)} AS metric,"
        f" {rnd(f'CAST({value} AS DOUBLE)')} AS value, {shown} AS text, {status} AS status {source}"
    )


STRATA = "strata AS (" + union([
    f'''SELECT {text(c)} AS c, "{c}" AS v FROM ind''' for c in ("Stratification1", "StratificationCategory1", "Stratification2")
]) + '''), strata_top AS (
  SELECT c, v, count(*) AS n, row_number() OVER (PARTITION BY c ORDER BY count(*) DESC, v) AS place
  FROM strata WHERE v IS NOT NULL GROUP BY 1, 2)'''
ONE_VALUE = f"SELECT {VALUE} AS v, \"DataValueType\" AS t FROM ind"


def _warn(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 'warning' ELSE 'ok' END"


BASIC_LINES = [
    _line("year", text(c), m, agg.format(c), _warn(f'quantile_cont("{c}", 0.5) NOT BETWEEN {low} AND {high}'), "FROM ind")
    for c, low, high in (("YearStart", 1990, 2030), ("YearEnd", 2000, 2030))
    for m, agg in (("min", 'min("{}")'), ("median", 'quantile_cont("{}", 0.5)'), ("max", 'max("{}")'))
] + [
    _line("value", "'DataValue'", "valid_pct", "100.0::DOUBLE * count(v) / count(*)",
          "CASE WHEN count(v) = 0 THEN 'error' WHEN 100 - 100.0::DOUBLE * count(v) / count(*) > 20 THEN 'warning' ELSE 'ok' END",
          f"FROM ({ONE_VALUE})"),
    _line("value", "'DataValue'", "min", "min(v)", _warn("min(v) < 0"), f"FROM ({ONE_VALUE})"),
    _line("value", "'DataValue'", "median", "quantile_cont(v, 0.5)", "'info'", f"FROM ({ONE_VALUE})"),
    _line("value", "'DataValue'", "max", "max(v)",
          _warn("max(v) > 100 AND bool_or(contains(t, 'Prevalence') OR contains(t, 'Percent'))"), f"FROM ({ONE_VALUE})"),
    _line("strata", "c", "n_distinct", "count(DISTINCT v)", _warn("count(DISTINCT v) = 0"), "FROM strata GROUP BY c"),
    _line("strata", "c", "top", "n", "'info'", "FROM strata_top WHERE place <= 3", "v"),
    _line("location", '"LocationAbbr"', "not_a_state", "count(*)", "'info'",
          f'FROM ind WHERE "LocationAbbr" NOT IN ({", ".join(text(s) for s in fv.STATES)}) GROUP BY "LocationAbbr"'),
    _line("nulls", "'*'", "null_pct", f"100.0::DOUBLE * {ALL_NULLS} / {ALL_CELLS}",
          _warn(f"100.0::DOUBLE * {ALL_NULLS} / {ALL_CELLS} > 30"), "FROM ind"),
    _line("duplicates", "'*'", "n_duplicates", "count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM ind))",
          _warn("count(*) > (SELECT count(*) FROM (SELECT DISTINCT * FROM ind))"), "FROM ind"),
]
SUITE_LINES = [
    _line("schema", text(c), "n_values", f'count("{c}")', "'ok'", "FROM ind") for c in fv.REQUIRED_COLUMNS
] + [
    _line("not_empty", "'*'", "has_rows", "CAST(count(*) > 0 AS INTEGER)", "CASE WHEN count(*) > 0 THEN 'ok' ELSE 'error' END", "FROM ind"),
    _line("types", '"DataValueType"', "n_rows", "count(*)", "'info'", 'FROM ind WHERE "DataValueType" IS NOT NULL GROUP BY "DataValueType"'),
    _line("range", "\"column\" || ': ' || type", "outside_pct", "outside_pct",
          "CASE WHEN n_outside = 0 THEN 'ok' WHEN outside_pct <= 5 THEN 'warning' ELSE 'error' END", "FROM typed_report"),
] + [
    _line("range", text(c), "outside_pct", f'100.0::DOUBLE * count(*) FILTER ("{c}" NOT BETWEEN 2000 AND 2030) / count("{c}")',
          f'''CASE WHEN count(*) FILTER ("{c}" NOT BETWEEN 2000 AND 2030) = 0 THEN 'ok'
          WHEN 100.0::DOUBLE * count(*) FILTER ("{c}" NOT BETWEEN 2000 AND 2030) / count("{c}") > 5 THEN 'error' ELSE 'warning' END''',
          "FROM ind") for c in ("YearStart", "YearEnd")
]


@query("basic_quality", VIEW + f", {STRATA}\n" + union(BASIC_LINES))
def _basic_quality(spark, folder):
    return rounded(checks.basic_quality(stored_view(spark, folder)))


@query("raw_validation_suite", VIEW + f", {TYPED}, {STRATA}\n" + union(SUITE_LINES + BASIC_LINES))
def _raw_validation_suite(spark, folder):
    return rounded(checks.raw_validation_suite(stored_view(spark, folder)))




@query("post_clean_checks", f"WITH {COERCED}\n" + union([
    f'''SELECT '{k}' AS "check", '{c}' AS "column", {n} AS n_rows, CASE WHEN {n} > 0 THEN 'warning' ELSE 'ok' END AS status FROM coerced'''
    for k, c, n in [("nulls", c, f'count(*) FILTER ("{c}" IS NULL)') for c in fv.CRITICAL_COLUMNS]
    + [("not_numeric", "DataValue", 'count(*) FILTER ("DataValue" IS NULL)'),
       ("duplicates", "*", "count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM coerced))")]
] + ['''SELECT 'rows' AS "check", '*' AS "column", count(*) AS n_rows, CASE WHEN count(*) = 0 THEN 'error' ELSE 'ok' END AS status FROM coerced''']))
def _post_clean_checks(spark, folder):
    coerced = coerce_numeric(normalise_strings(stored_view(spark, folder)), [fv.VALUE, *fv.COERCED_COLUMNS])
    return checks.post_clean_checks(coerced)


ML_COLUMNS = ["event_id", "user_id", "event_type", "value", "ratio", "same"]
ML_TABLE = """SELECT event_id, user_id, event_type, CASE WHEN event_id % 7 <> 0 THEN value END AS value,
  CASE WHEN event_id % 100 = 0 THEN 'inf'::DOUBLE WHEN event_id % 100 = 1 THEN '-inf'::DOUBLE ELSE value END AS ratio,
  3 AS same FROM events"""


def _ml_line(c: str) -> str:
    numeric = c != "event_type"
    infinite = f"count(*) FILTER (isinf({c}::DOUBLE))" if numeric else "0::BIGINT"
    constant = f"count({c}) > 1 AND min({c}) = max({c})" if numeric else "false"
    return f'''SELECT '{c}' AS "column", {str(numeric).lower()} AS is_numeric, count(*) FILTER ({c} IS NULL) AS n_null,
  {infinite} AS n_infinite, {constant} AS is_constant, false AS too_many_columns FROM noisy'''


def noisy_events(spark, folder):
    value = F.when(F.col("event_id") % 7 != 0, F.col("value"))
    ratio = (
        F.when(F.col("event_id") % 100 == 0, F.lit(float("inf")))
        .when(F.col("event_id") % 100 == 1, F.lit(float("-inf"))).otherwise(F.col("value"))
    )
    return table(spark, folder, "events").select(
        "event_id", "user_id", "event_type", value.alias("value"), ratio.alias("ratio"), F.lit(3).alias("same")
    )


@query("ml_ready_report", f"WITH noisy AS ({ML_TABLE})\n" + union([_ml_line(c) for c in ML_COLUMNS]))
def _ml_ready_report(spark, folder):
    return checks.ml_ready_report(noisy_events(spark, folder))


@query("ml_ready", "SELECT event_id, user_id, value FROM events")
def _ml_ready(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "value", F.lit(1).alias("same"))
    return checks.ml_ready(events)


@query("input_checks", f"WITH noisy AS ({ML_TABLE})\n" + union([
    f'''SELECT '{c}' AS "column", {str(c == "value").lower()} AS is_target, {str(c != "event_type").lower()} AS is_numeric,
  count(*) FILTER ({c} IS NULL) AS n_null,
  {f"count(*) FILTER (isinf({c}::DOUBLE))" if c != "event_type" else "0::BIGINT"} AS n_infinite,
  {str(c != "event_type").lower()} AND count(*) FILTER ({c} IS NULL) = 0
    AND {f"count(*) FILTER (isinf({c}::DOUBLE)) = 0" if c not in ("event_type", "value") else "true"} AS passed FROM noisy'''
    for c in ML_COLUMNS
]))
def _input_checks(spark, folder):
    return checks.input_checks(noisy_events(spark, folder), "value", on_fail="report")


# --- imputation -------------------------------------------------------------------------------------
def coerced_view(spark, folder):
    return coerce_numeric(normalise_strings(stored_view(spark, folder)), [fv.VALUE, *fv.COERCED_COLUMNS])


@query("group_transform", f'''WITH {FILLED}
SELECT "ResponseID", "DataValueType", "DataValue", {rnd("group_median")} AS group_median
FROM coerced LEFT JOIN medians USING ("DataValueType")''')
def _group_transform(spark, folder):
    view = coerced_view(spark, folder).select("ResponseID", "DataValueType", "DataValue")
    return rounded(impute.group_transform(view))


# Events of type "error" lose all values, so that group needs the global step; "view" rows lose their group.
GAPPY = """gappy AS (
  SELECT event_id, CASE WHEN event_type <> 'view' THEN event_type END AS kind,
    CASE WHEN event_type <> 'error' AND event_id % 3 <> 0 THEN value END AS value FROM events)"""


@query("group_median_impute", f"""WITH {GAPPY},
medians AS (SELECT kind, quantile_cont(value, 0.5) AS m FROM gappy GROUP BY 1),
grouped AS (SELECT event_id, gappy.kind, coalesce(value, m) AS value FROM gappy LEFT JOIN medians ON gappy.kind = medians.kind)
SELECT event_id, kind, {rnd("coalesce(value, (SELECT quantile_cont(value, 0.5) FROM grouped))")} AS value FROM grouped""")
def _group_median_impute(spark, folder):
    gappy = table(spark, folder, "events").select(
        "event_id", F.when(F.col("event_type") != "view", F.col("event_type")).alias("kind"),
        F.when((F.col("event_type") != "error") & (F.col("event_id") % 3 != 0), F.col("value")).alias("value"),
    )
    return rounded(impute.group_median_impute(gappy, "value", "kind"))


@query("median_impute_all", f"""WITH {GAPPY}
SELECT event_id, coalesce(kind, 'unknown') AS kind,
  {rnd("coalesce(value, (SELECT quantile_cont(value, 0.5) FROM gappy))")} AS value FROM gappy""")
def _median_impute_all(spark, folder):
    gappy = table(spark, folder, "events").select(
        "event_id", F.when(F.col("event_type") != "view", F.col("event_type")).alias("kind"),
        F.when((F.col("event_type") != "error") & (F.col("event_id") % 3 != 0), F.col("value")).alias("value"),
    )
    return rounded(impute.median_impute_all(gappy, skip=()))


# --- outliers ---------------------------------------------------------------------------------------
def doubles(columns: list[str]) -> list[str]:
    return [c for c in columns if c in ("DataValue", "LowConfidenceLimit", "HighConfidenceLimit")]


@query("iqr_cap", f"WITH {CAPPED}\n" + select_rounded(COLUMNS, doubles(COLUMNS), "capped"))
def _iqr_cap(spark, folder):
    filled = impute.median_impute_all(impute.group_median_impute(materialise(coerced_view(spark, folder), "coerced")))
    return rounded(outliers.iqr_cap(filled))


def _remove_sql(inside: str, stats: str) -> str:
    return f"""WITH noisy AS (
  SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_orderkey % 19 <> 0 THEN l_shipdate::VARCHAR || l_returnflag END AS grp,
    CASE WHEN l_orderkey % 17 = 0 THEN NULL WHEN l_partkey % 50 = 0 THEN l_extendedprice * 9 ELSE l_extendedprice END AS price
  FROM lineitem),
stats AS (SELECT grp, count(*) AS n, count(price) AS filled, {stats} FROM noisy WHERE grp IS NOT NULL GROUP BY 1)
SELECT l_orderkey, l_linenumber, l_partkey, noisy.grp, {rnd("price")} AS price FROM noisy LEFT JOIN stats ON noisy.grp = stats.grp
WHERE stats.grp IS NULL OR n < 10 OR filled = 0 OR coalesce({inside}, false)"""


def noisy_lines(spark, folder):
    price = F.col("l_extendedprice")
    day = F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(F.col("l_orderkey") % 19 != 0, F.concat(day, "l_returnflag")).alias("grp"),
        F.when(F.col("l_orderkey") % 17 == 0, F.lit(None)).when(F.col("l_partkey") % 50 == 0, price * 9)
        .otherwise(price).alias("price"),
    )


@query("outlier_remove_by_group", _remove_sql(
    "price BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)",
    "quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3"))
def _outlier_remove_by_group(spark, folder):
    return rounded(outliers.outlier_remove_by_group(noisy_lines(spark, folder), "price", "grp", threshold=1.5))


@query("outlier_remove_zscore", _remove_sql(
    "price IS NULL OR abs(price - mean) / nullif(std, 0) <= 2", "avg(price) AS mean, stddev_pop(price) AS std"))
def _outlier_remove_zscore(spark, folder):
    return rounded(outliers.outlier_remove_by_group(noisy_lines(spark, folder), "price", "grp", "zscore", 2.0))


OUTLIERS = """WITH q AS (SELECT """ + ", ".join(
    f"quantile_cont({c}, 0.25) AS {c}_1, quantile_cont({c}, 0.75) AS {c}_3" for c in ("value", "user_id", "event_id")
) + " FROM events), report AS (" + union([
    f"""SELECT '{c}' AS feature, count(*) FILTER ({c} < {c}_1 - ({c}_3 - {c}_1) OR {c} > {c}_3 + ({c}_3 - {c}_1)) AS outlier_count,
  count({c}) AS n, any_value({c}_1 - ({c}_3 - {c}_1)) AS lower_bound, any_value({c}_3 + ({c}_3 - {c}_1)) AS upper_bound,
  min({c})::DOUBLE AS min_value, max({c})::DOUBLE AS max_value FROM events, q""" for c in ("value", "user_id", "event_id")
]) + ") "


@query("outlier_totals", OUTLIERS + """SELECT count(*) AS n_columns, CAST(coalesce(sum(outlier_count), 0) AS BIGINT) AS total_outliers,
  (SELECT count(*) FROM events) AS total_rows, true AS has_time FROM report WHERE outlier_count > 0""")
def _outlier_totals(spark, folder):
    events = table(spark, folder, "events")
    report = outliers.outlier_report(events, ["value", "user_id", "event_id"], 1.0)
    totals = outliers.outlier_totals(report, events.count())
    return totals.withColumn("has_time", F.col("reported_at").isNotNull()).drop("reported_at")


@query("outlier_report", OUTLIERS + f"""SELECT feature, outlier_count, {rnd("100.0::DOUBLE * outlier_count / n")} AS outlier_percent,
  {rnd("lower_bound")} AS lower_bound, {rnd("upper_bound")} AS upper_bound, min_value, max_value
FROM report WHERE outlier_count > 0""")
def _outlier_report(spark, folder):
    return rounded(outliers.outlier_report(table(spark, folder, "events"), ["value", "user_id", "event_id"], 1.0))


@query("target_range_filter", """WITH far AS (
  SELECT event_id, CASE WHEN event_id % 500 = 0 THEN value * 100 ELSE value END AS value FROM events),
q AS (SELECT quantile_cont(value, 0.01) AS a, quantile_cont(value, 0.99) AS b FROM far)
SELECT event_id, value FROM far, q WHERE value BETWEEN a - 3 * (b - a) AND b + 3 * (b - a)""")
def _target_range_filter(spark, folder):
    far = F.when(F.col("event_id") % 500 == 0, F.col("value") * 100).otherwise(F.col("value"))
    return outliers.target_range_filter(table(spark, folder, "events").select("event_id", far.alias("value")), "value")


# --- encoding ---------------------------------------------------------------------------------------
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("one_hot", "WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 10 <> 0 THEN c_mktsegment END AS s FROM customer) SELECT c_custkey, "
       + ", ".join(f"CAST(coalesce(s = '{s}', false) AS INTEGER) AS \"Demo_{s}\"" for s in SEGMENTS) + " FROM c")
def _one_hot(spark, folder):
    customers = table(spark, folder, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 10 != 0, F.col("c_mktsegment")).alias("segment"))
    return encode.one_hot(customers, "segment", "Demo")


@query("topk_bucket", """WITH top AS (SELECT p_name FROM part GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 20)
SELECT p_partkey, CASE WHEN p_name IN (SELECT p_name FROM top) THEN p_name ELSE 'Other' END AS p_name FROM part""")
def _topk_bucket(spark, folder):
    return encode.topk_bucket(table(spark, folder, "part").select("p_partkey", "p_name"), "p_name")


@query("assemble_features", """
SELECT l_orderkey, l_quantity AS f1, l_discount AS f2, l_tax AS f3, l_extendedprice AS label FROM lineitem""")
def _assemble_features(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_quantity", "l_discount", "l_tax", "l_extendedprice")
    out = encode.assemble_features(lines, "l_extendedprice", skip=["l_orderkey"], keep=["l_orderkey"])
    parts = vector_to_array("features")
    return out.select("l_orderkey", *[parts[i].alias(f"f{i + 1}") for i in range(3)], "label")


@query("clean_data", f"WITH {CLEANED}\n" + select_rounded(
    COLUMNS + ["DataValue_Extreme_Flag", "CI_Missing_Flag"], doubles(COLUMNS), "cleaned"))
def _clean_data(spark, folder):
    return rounded(clean_data(stored_view(spark, folder)))


@query("cleaning_report", f"""WITH {CLEANED}
SELECT (SELECT count(*) FROM ind) AS rows_before, count(*) AS rows_after, (SELECT count(*) FROM ind) - count(*) AS rows_removed,
  {len(COLUMNS)} AS columns_before, {len(COLUMNS) + 2} AS columns_after,
  (SELECT CAST({ALL_NULLS} AS BIGINT) FROM ind) AS nulls_before, CAST({ALL_NULLS} AS BIGINT) AS nulls_after,
  (SELECT count(*) FROM ind) - (SELECT count(*) FROM (SELECT DISTINCT * FROM ind))
    - (count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM cleaned))) AS duplicates_removed,
  CAST(sum("DataValue_Extreme_Flag") AS BIGINT) AS outliers_handled FROM cleaned""")
def _cleaning_report(spark, folder):
    raw = stored_view(spark, folder)
    return checks.cleaning_report(raw, clean_data(raw))


FEATURES = f"WITH {CLEANED},\n{features_from('cleaned')}\n" + select_rounded(
    FEATURE_NUMBERS + ["active_features"], FEATURE_DOUBLES, "features")


@query("engineer_features", FEATURES)
def _engineer_features(spark, folder):
    return rounded(row_form(engineer_features(clean_data(stored_view(spark, folder)))))


@query("full_run", FEATURES)
def _full_run(spark, folder):
    return rounded(row_form(prepare(stored_view(spark, folder))))


# --- ordered results --------------------------------------------------------------------------------
@query("every_n", """SELECT event_id, ts, value, n AS row_number FROM (
  SELECT *, row_number() OVER (ORDER BY ts, event_id) AS n FROM events) WHERE n % 100 = 0""")
def _every_n(spark, folder):
    events = table(spark, folder, "events").select("event_id", "ts", "value")
    return ranking.every_n(events, ["ts", "event_id"], 100)


@query("first_k_samples", """SELECT event_type, value, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value) AS rank FROM events WHERE value > 100) WHERE rank <= 5""")
def _first_k_samples(spark, folder):
    events = table(spark, folder, "events").where("value > 100").select("event_type", "value")
    return ranking.first_k_samples(events, ["event_type"], "value")


