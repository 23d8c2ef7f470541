"""SQL building blocks of the DuckDB twins."""

from __future__ import annotations

from gaugeflow import fixed_values as fv
from gaugeflow.plans.indicator_view import LOCATIONS, METRICS

TEXTS = [
    "LocationAbbr", "LocationDesc", "Topic", "Question", "DataValue", "DataValueUnit", "DataValueType",
    "Stratification1", "StratificationCategory1", "Stratification2", "GeoLocation", "ResponseID", "TopicID",
    "DataSource",
]
COLUMNS = [
    "YearStart", "YearEnd", "LocationAbbr", "LocationDesc", "Topic", "Question", "DataValue", "DataValueUnit",
    "DataValueType", "LowConfidenceLimit", "HighConfidenceLimit", "Stratification1", "StratificationCategory1",
    "Stratification2", "GeoLocation", "ResponseID", "LocationID", "TopicID", "DataSource",
]


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def rnd(expr: str, digits: int = 6) -> str:
    return f"(round({expr}, {digits}) + 0.0)::DOUBLE"


def num(value: float) -> str:
    return f"{value!r}::DOUBLE"


def stripped(c: str) -> str:
    return f"trim({c}, {text(fv.WHITE_SPACE)})"


def normalised(c: str) -> str:
    return (
        f"CASE WHEN {c} IS NULL THEN {text(fv.NULL_TEXT)} WHEN {stripped(c)} = '' THEN {text(fv.BLANK_TEXT)}"
        f" ELSE {stripped(c)} END"
    )


def number(c: str) -> str:
    return f"CASE WHEN regexp_matches(trim({c}), {text(fv.NUMBER_PATTERN)}) THEN try_cast(trim({c}) AS DOUBLE) END"


def _metric(place: int) -> str:
    values = [(text(m[place]) if isinstance(m[place], str) else str(m[place])) for m in METRICS]
    return "CASE o_orderpriority " + " ".join(
        f"WHEN {text(m[0])} THEN {v}" for m, v in zip(METRICS, values)
    ) + " END"


INDICATORS = f"""
base AS (
  SELECT *, (l_orderkey * 7 + l_linenumber) % 10 AS noise,
    CAST(round(l_extendedprice * 100) AS BIGINT) // ({_metric(3)})
      * (CASE WHEN (l_orderkey * 13 + l_linenumber) % 100 = 0 THEN 40 ELSE 1 END) / 100.0::DOUBLE AS val,
    (l_orderkey * 3 + l_linenumber) % 9 AS no_limit, (l_partkey + l_suppkey) % 11 AS place,
    (l_partkey % 250 + 250) / 10.0::DOUBLE AS lat, (l_suppkey % 600 - 1250) / 10.0::DOUBLE AS lon,
    (l_orderkey + l_linenumber) % 23 AS group_noise
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey
),
once AS (
  SELECT CAST(least(year(o_orderdate), year(l_shipdate)) + 15 AS INTEGER) AS "YearStart",
    CAST(greatest(year(o_orderdate), year(l_shipdate)) + 15 AS INTEGER) AS "YearEnd",
    [{", ".join(text(x) for x in LOCATIONS)}][n_nationkey + 1] AS "LocationAbbr",
    n_name AS "LocationDesc", p_type AS "Topic", p_name AS "Question",
    CASE WHEN noise = 0 THEN '' WHEN noise = 1 THEN 'Suppressed' WHEN noise > 2 THEN CAST(val AS VARCHAR) END AS "DataValue",
    {_metric(2)} AS "DataValueUnit", {_metric(1)} AS "DataValueType",
    CASE WHEN no_limit <> 0 THEN val * 0.96::DOUBLE END AS "LowConfidenceLimit",
    CASE WHEN no_limit <> 1 THEN val * 1.04::DOUBLE END AS "HighConfidenceLimit",
    CASE group_noise WHEN 0 THEN NULL WHEN 1 THEN ' ' || chr(9) || ' ' WHEN 2 THEN chr(9) || c_mktsegment || chr(160)
      WHEN 3 THEN '  ' || c_mktsegment ELSE c_mktsegment END AS "Stratification1",
    CASE WHEN group_noise <> 4 THEN 'Segment' END AS "StratificationCategory1",
    CAST(NULL AS VARCHAR) AS "Stratification2",
    CASE WHEN place = 1 THEN 'POINT (' || CAST(lon AS VARCHAR) || ' ' || CAST(lat AS VARCHAR) || ')'
      WHEN place > 1 THEN '(' || CAST(lat AS VARCHAR) || ', ' || CAST(lon AS VARCHAR) || ')' END AS "GeoLocation",
    concat_ws('-', 'R', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INTEGER)) AS "ResponseID",
    n_nationkey AS "LocationID", 'T' || CAST(p_size AS VARCHAR) AS "TopicID", o_orderstatus AS "DataSource",
    CASE WHEN l_orderkey % 50 = 0 THEN 2 ELSE 1 END AS copies
  FROM base
),
ind AS (SELECT * EXCLUDE (copies, copy) FROM (SELECT *, unnest(range(copies)) AS copy FROM once))"""


def _coerced(c: str) -> str:
    if c == "DataValue":
        return f'{number(normalised(c))} AS "DataValue"'
    return f'{normalised(c)} AS "{c}"' if c in TEXTS else f'"{c}"'


COERCED = f"{INDICATORS},\ncoerced AS (SELECT {', '.join(_coerced(c) for c in COLUMNS)} FROM ind)"

FILLED = f"""{COERCED},
medians AS (SELECT "DataValueType", quantile_cont("DataValue", 0.5) AS group_median FROM coerced GROUP BY 1),
grouped AS (
  SELECT coerced.* REPLACE (coalesce("DataValue", group_median) AS "DataValue")
  FROM coerced LEFT JOIN medians USING ("DataValueType")
),
middles AS (
  SELECT quantile_cont("DataValue", 0.5) AS dv, quantile_cont("LowConfidenceLimit", 0.5) AS lo,
    quantile_cont("HighConfidenceLimit", 0.5) AS hi FROM grouped
),
filled AS (
  SELECT grouped.* REPLACE (coalesce("DataValue", dv) AS "DataValue",
    coalesce("LowConfidenceLimit", lo) AS "LowConfidenceLimit",
    coalesce("HighConfidenceLimit", hi) AS "HighConfidenceLimit")
  FROM grouped, middles
)"""


def _capped(c: str) -> str:
    low, high = {"DataValue": (2, 7)}.get(c, (None, 6))
    expr = f'least("{c}", "{c}_q"[{high}])'
    if low:
        expr = f'greatest({expr}, "{c}_q"[{low}])'
    reach = f'{fv.FENCE_WIDTH} * ("{c}_q"[5] - "{c}_q"[4])'
    hit = f'"{c}_q"[1] < "{c}_q"[4] - {reach} OR "{c}_q"[8] > "{c}_q"[5] + {reach}'
    return f'CASE WHEN "{c}_q"[5] <> "{c}_q"[4] AND ({hit}) THEN {expr} ELSE "{c}" END AS "{c}"'


CAP_COLUMNS = ["DataValue", "LowConfidenceLimit", "HighConfidenceLimit"]
CAP_QUANTILES = ", ".join(
    f'quantile_cont("{c}", [0, 0.005, 0.01, 0.25, 0.75, 0.99, 0.995, 1]) AS "{c}_q"' for c in CAP_COLUMNS
)
CAPPED = f"""{FILLED},
caps AS (SELECT {CAP_QUANTILES} FROM filled),
capped AS (SELECT filled.* REPLACE ({", ".join(_capped(c) for c in CAP_COLUMNS)}) FROM filled, caps)"""

CLEANED = f"""{CAPPED},
single AS (SELECT DISTINCT * FROM capped),
top AS (SELECT quantile_cont("DataValue", 0.99) AS p99 FROM single),
cleaned AS (
  SELECT single.* REPLACE (CAST(least(greatest("YearStart", 1900), 2030) AS INTEGER) AS "YearStart",
    CAST(least(greatest("YearEnd", 1900), 2030) AS INTEGER) AS "YearEnd"),
    CAST("DataValue" > p99 AS INTEGER) AS "DataValue_Extreme_Flag", 0 AS "CI_Missing_Flag"
  FROM single, top
)"""


def region(c: str) -> str:
    lines = " ".join(
        f"WHEN {c} IN ({', '.join(text(s) for s in states)}) THEN {text(name)}" for name, states in fv.REGIONS.items()
    )
    return f"CASE {lines} ELSE {text(fv.NO_REGION)} END"


CENTROIDS = "centres AS (SELECT * FROM (VALUES " + ", ".join(
    f"({text(s)}, {num(lat)}, {num(lon)})" for s, (lat, lon) in fv.CENTROIDS.items()
) + ") AS t(state, centre_lat, centre_lon))"


def coordinate(pattern: str) -> str:
    return number(f"""regexp_extract("GeoLocation", {text(pattern)}, 1)""")


def features_from(table: str) -> str:
    """CTE ``features``: the engineered table in row form, with the active categories as one text."""
    return f"""{CENTROIDS},
located AS (
  SELECT t.*, {coordinate(fv.LATITUDE_PATTERN)} AS lat0, {coordinate(fv.LONGITUDE_PATTERN)} AS lon0 FROM {table} AS t
),
placed AS (
  SELECT located.*, coalesce(lat0, centre_lat, {num(fv.COUNTRY_CENTROID[0])}) AS "Latitude",
    coalesce(lon0, centre_lon, {num(fv.COUNTRY_CENTROID[1])}) AS "Longitude", {region('"LocationAbbr"')} AS region
  FROM located LEFT JOIN centres ON "LocationAbbr" = state
),
ranked AS (
  SELECT "Question", row_number() OVER (ORDER BY count(*) DESC, "Question") AS place FROM placed GROUP BY 1
),
features AS (
  SELECT "YearStart", "DataValue", "LowConfidenceLimit", "HighConfidenceLimit", "DataValue_Extreme_Flag",
    "CI_Missing_Flag", 0 AS "DataValue_Missing_Flag",
    "HighConfidenceLimit" - "LowConfidenceLimit" AS "ConfidenceIntervalWidth", "Latitude", "Longitude",
    "YearStart" - 2020 AS "YearsSince2020",
    concat_ws('|', 'Region_' || region,
      'Demo_' || CASE WHEN "Stratification1" = 'unknown' THEN 'unknown_2' ELSE "Stratification1" END,
      'Topic_' || "Topic", 'Question_' || CASE WHEN place <= 20 THEN "Question" ELSE 'Other' END) AS active_features
  FROM placed JOIN ranked USING ("Question")
)"""


FEATURE_NUMBERS = [
    "YearStart", "DataValue", "LowConfidenceLimit", "HighConfidenceLimit", "DataValue_Extreme_Flag",
    "CI_Missing_Flag", "DataValue_Missing_Flag", "ConfidenceIntervalWidth", "Latitude", "Longitude", "YearsSince2020",
]
FEATURE_DOUBLES = [
    "DataValue", "LowConfidenceLimit", "HighConfidenceLimit", "ConfidenceIntervalWidth", "Latitude", "Longitude",
]


def select_rounded(columns: list[str], doubles: list[str], table: str, digits: int = 6) -> str:
    return "SELECT " + ", ".join(
        f'{rnd(chr(34) + c + chr(34), digits)} AS "{c}"' if c in doubles else f'"{c}"' for c in columns
    ) + f" FROM {table}"


def share(seed: int, expr: str) -> str:
    """Hash share in [0, 1) of an id, as the split uses it."""
    digest = f"substr(md5({text(f'{seed}|')} || CAST({expr} AS VARCHAR)), 1, 8)"
    return f"(CAST(('0x' || {digest}) AS UBIGINT) / 4294967296.0::DOUBLE)"
