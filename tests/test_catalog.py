"""Every registered query runs, and equals its SQL twin where there is one."""

from __future__ import annotations

import __spark_entry__ as entry_points
import pytest
from compare import compare, oracle

QUERIES, TWINS = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck(folder):
    return oracle(folder)


def test_every_twin_belongs_to_a_query():
    assert set(TWINS) <= set(QUERIES)


def test_flagship(spark):
    out = entry_points.entry(spark)
    assert out.count() > 0 and "DataValue" in out.columns


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, folder, name):
    assert compare(spark, duck, name, folder, QUERIES, TWINS) == ""
