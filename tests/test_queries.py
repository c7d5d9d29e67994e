"""Every registered query against its SQL check, on the smallest tables."""

from __future__ import annotations

import pytest
from compare import DATA, check, connect

import __spark_entry__ as entry

SF = DATA / "sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_checks_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    ok, note = check(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), SF)
    assert ok, note


def test_entry(spark):
    assert entry.entry(spark).columns[-1] == "tool_lifetime_efficiency"
