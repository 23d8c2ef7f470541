from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from gaugeflow.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(name="tests")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return DATA


@pytest.fixture
def small_table(spark):
    """100 rows in the shape of the small preparation table, made by rule."""
    places = ["WA", "OR", "ME", "KS", "AL", "UT", "VT"]
    subjects, kinds = ["Sleep", "Noise", "Water", "Air"], ["Mean", "Percent", "Count of cases"]
    groups = ["Overall", "Female", "Male"]
    rows = []
    for i in range(100):
        value = 3.0 + (i * 29 % 71)
        place = places[i % len(places)]
        point = None if i % 5 == 3 else f"({28 + i % 17}.125, -{75 + i % 40}.5)"
        rows.append((
            2011 + i % 9, 2011 + i % 9 + i % 3, place, f"Place {place}", subjects[i % 4], f"Item {i % 6}",
            None if i % 11 == 5 else f"{value}", value - 1.5, value + 2.5, kinds[i % 3], point, groups[i % 3],
            "Group", f"row-{i}", i % 13,
        ))
    return spark.createDataFrame(rows, (
        "YearStart int, YearEnd int, LocationAbbr string, LocationDesc string, Topic string, Question string,"
        " DataValue string, LowConfidenceLimit double, HighConfidenceLimit double, DataValueType string,"
        " GeoLocation string, Stratification1 string, StratificationCategory1 string, ResponseID string, LocationID int"
    ))
