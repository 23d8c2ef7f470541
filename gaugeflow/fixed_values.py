"""Names, lists, bounds and coordinates that results depend on.

Everything here is data. Operators take these as default parameters, so other schemas can be used.
"""

# --- fixed values: columns of the indicator table -------------------------------------------------
VALUE = "DataValue"
VALUE_TYPE = "DataValueType"
LOW_LIMIT = "LowConfidenceLimit"
HIGH_LIMIT = "HighConfidenceLimit"
YEAR_START = "YearStart"
YEAR_END = "YearEnd"

REQUIRED_COLUMNS = [
    "YearStart",
    "LocationAbbr",
    "LocationDesc",
    "Topic",
    "Question",
    "DataValue",
    "LowConfidenceLimit",
    "HighConfidenceLimit",
    "DataValueType",
]
METRIC_COLUMNS = ["DataValue", "DataValueAlt", "LowConfidenceLimit", "HighConfidenceLimit"]
COERCED_COLUMNS = ["YearStart", "YearEnd", "LowConfidenceLimit", "HighConfidenceLimit"]
CRITICAL_COLUMNS = ["YearStart", "DataValue", "LocationAbbr"]
UNCAPPED_COLUMNS = ["LocationID", "YearStart", "YearEnd", "DataValue_Missing_Flag"]

IDENTIFIER_COLUMNS = [
    "ResponseID", "LocationID", "TopicID", "QuestionID", "DataValueTypeID",
    "StratificationCategoryID1", "StratificationID1",
    "StratificationCategoryID2", "StratificationID2",
    "StratificationCategoryID3", "StratificationID3",
    "DataValueFootnoteSymbol", "DatavalueFootnote", "DataSource",
]
DESCRIPTIVE_COLUMNS = [
    "LocationAbbr", "LocationDesc",
    "StratificationCategory1", "StratificationCategory2", "Stratification2",
    "StratificationCategory3", "Stratification3", "DataValueUnit", "DataValueType",
]
LEAKAGE_COLUMNS = [
    "DataValueAlt", "LowConfidenceLimit", "HighConfidenceLimit",
    "DataValueType", "DataValueUnit", "DataValueFootnoteSymbol",
    "DatavalueFootnote", "DataValueTypeID", "DataValue_Missing_Flag",
    "CI_Missing_Flag", "DataValue_Extreme_Flag",
]

# --- fixed values: text markers -------------------------------------------------------------------
NULL_TEXT = "unknown"
BLANK_TEXT = "Unknown"
# Cell texts a CSV reader takes as missing.
MISSING_MARKERS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# --- fixed values: patterns -----------------------------------------------------------------------
NUMBER_PATTERN = r"^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)$"
LATITUDE_PATTERN = r"\(([^,]+),"
LONGITUDE_PATTERN = r",\s*([^)]+)\)"
# Characters taken off at both ends of a text.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
MODEL_FILE_PATTERN = r"^(.*)_v(.*)$"

# --- fixed values: value bounds per metric type ---------------------------------------------------
# (words looked for in the lower-cased type label, low, high); the first line that matches counts.
VALUE_BOUNDS = [
    (["prevalence", "percent", "percentage"], 0.0, 100.0),
    (["rate"], 0.0, 5000.0),
    (["number", "count"], 0.0, 10_000_000.0),
    (["yes/no"], 0.0, 1.0),
    (["mean", "average", "median"], 0.0, 10_000.0),
    (["dollars"], 0.0, 1_000_000.0),
]
# Confidence columns have no line of their own for means and medians.
LIMIT_BOUNDS = [
    (["prevalence", "percent", "percentage"], 0.0, 100.0),
    (["rate"], 0.0, 5000.0),
    (["number", "count"], 0.0, 10_000_000.0),
    (["yes/no"], 0.0, 1.0),
    (["dollars"], 0.0, 1_000_000.0),
]
OTHER_BOUNDS = (0.0, 10_000.0)
GLOBAL_BOUNDS = {
    "YearStart": (2000.0, 2030.0),
    "YearEnd": (2000.0, 2030.0),
    "DataValue": (0.0, 10_000_000.0),
    "LowConfidenceLimit": (0.0, 5000.0),
    "HighConfidenceLimit": (0.0, 5000.0),
}
MAX_OUTSIDE_PERCENT = 5.0
PERCENT_TYPE_WORDS = ["Prevalence", "Percent", "Percentage"]

# --- fixed values: thresholds ---------------------------------------------------------------------
MAX_NULL_PERCENT = 30.0
MAX_NON_NUMERIC_PERCENT = 20.0
FENCE_WIDTH = 3.0
VALID_YEARS = (1900, 2030)
BASE_YEAR = 2020
TOP_CATEGORIES = 20
MIN_GROUP_ROWS = 10
LEAKAGE_CORRELATION = 0.95
IDENTIFIER_WORDS = ["id", "code", "index"]
MAX_FEATURES = 1000
RATIO_FLOOR = 1e-10
MACHINE_EPSILON = 2.220446049250313e-16
INTERVAL_WIDTH = 1.96
ANOMALY_RANGE = (0.0, 1000.0)
DRIFT_THRESHOLD = 2.0
DEFAULT_REFERENCE_STATS = {
    "YearStart": (2020.0, 2.0),
    "Latitude": (36.5, 5.2),
    "Longitude": (-95.0, 8.5),
}
SEVERITIES = {"info": 0, "warning": 1, "error": 2, "critical": 3}

# --- fixed values: accepted ranges of scoring rows ------------------------------------------------
# (column, low, high, required)
REQUEST_RANGES = [
    ("YearStart", 2000.0, 2030.0, True),
    ("YearsSince2020", 0.0, 10.0, True),
    ("ConfidenceIntervalWidth", 0.0, None, False),
    ("Latitude", 20.0, 50.0, True),
    ("Longitude", -130.0, -60.0, True),
]
REQUIRED_FLAGS = [
    "Region_Midwest", "Region_Northeast", "Region_South", "Region_West",
    "Demo_Overall", "Demo_Male", "Demo_Female", "Demo_Age_65_plus", "Demo_Age_18_64",
]
OPTIONAL_FLAGS = [
    "DataValue_Missing_Flag", "Region_Unknown",
    "Topic_Alcohol", "Topic_Arthritis", "Topic_Asthma", "Topic_Cancer",
    "Topic_Diabetes", "Topic_Disability", "Topic_Immunization", "Topic_Tobacco",
    "Question_Other",
]

# --- fixed values: forest settings ----------------------------------------------------------------
FOREST_SETTINGS = {
    "numTrees": 100, "maxDepth": 15, "minInstancesPerNode": 5,
    "featureSubsetStrategy": "sqrt", "bootstrap": True, "seed": 42,
}
SEARCH_GRID = {
    "numTrees": [50, 100, 150],
    "maxDepth": [10, 15, 20],
    "minInstancesPerNode": [2, 4, 8],
    "featureSubsetStrategy": ["sqrt", "log2"],
}
SEARCH_DRAWS = 15
FOLDS = 3

# --- fixed values: geography ----------------------------------------------------------------------
REGIONS = {
    "Northeast": ["CT", "ME", "MA", "NH", "RI", "VT", "NJ", "NY", "PA"],
    "Midwest": ["IL", "IN", "MI", "OH", "WI", "IA", "KS", "MN", "MO", "NE", "ND", "SD"],
    "South": [
        "DE", "FL", "GA", "MD", "NC", "SC", "VA", "DC", "WV",
        "AL", "KY", "MS", "TN", "AR", "LA", "OK", "TX",
    ],
    "West": ["AZ", "CO", "ID", "MT", "NV", "NM", "UT", "WY", "AK", "CA", "HI", "OR", "WA"],
}
NO_REGION = "Unknown"
STATES = [
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA",
    "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD",
    "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ",
    "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC",
    "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY",
]
COUNTRY_CENTROID = (39.8283, -98.5795)
CENTROIDS = {
    "AL": (32.8067, -86.7911), "AK": (61.3707, -152.4044), "AZ": (33.7298, -111.4312),
    "AR": (34.9697, -92.3731), "CA": (36.1162, -119.6816), "CO": (39.0598, -105.3111),
    "CT": (41.5978, -72.7554), "DE": (38.9108, -75.5277), "FL": (27.7663, -81.6868),
    "GA": (32.3294, -83.1137), "HI": (21.0943, -157.4983), "ID": (44.2405, -114.4788),
    "IL": (40.3495, -88.9861), "IN": (39.8934, -86.1346), "IA": (42.0115, -93.2105),
    "KS": (38.5266, -96.7265), "KY": (37.6681, -84.6701), "LA": (31.1695, -91.8678),
    "ME": (44.6939, -69.3819), "MD": (39.0639, -76.8021), "MA": (42.2302, -71.5301),
    "MI": (43.3266, -84.5361), "MN": (45.6945, -93.9002), "MS": (32.7416, -89.6787),
    "MO": (38.4561, -92.2884), "MT": (46.9219, -110.4544), "NE": (41.1254, -98.2681),
    "NV": (38.3135, -117.0558), "NH": (43.4525, -71.5639), "NJ": (40.2989, -74.5210),
    "NM": (34.8405, -106.2485), "NY": (42.1657, -74.9481), "NC": (35.6301, -79.8064),
    "ND": (47.5289, -99.7840), "OH": (40.3888, -82.7649), "OK": (35.5653, -96.9289),
    "OR": (44.5720, -122.0709), "PA": (40.5908, -77.2098), "RI": (41.6809, -71.5118),
    "SC": (33.8569, -80.9450), "SD": (44.2998, -99.4388), "TN": (35.7478, -86.6923),
    "TX": (31.0545, -97.5635), "UT": (40.1500, -111.8624), "VT": (44.0459, -72.7107),
    "VA": (37.7693, -78.1693), "WA": (47.4009, -121.4905), "WV": (38.4912, -80.9545),
    "WI": (44.2685, -89.6165), "WY": (42.7560, -107.3025),
    "DC": (38.9072, -77.0369), "PR": (18.2208, -66.5901), "VI": (18.3358, -64.8963),
    "GU": (13.4443, 144.7937), "AS": (-14.2710, -170.1322), "MP": (15.0979, 145.6739),
    "US": (39.8283, -98.5795), "": (39.8283, -98.5795),
}
