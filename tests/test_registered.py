"""Every registered query against its SQL, exactly."""

from __future__ import annotations

import pytest
from conftest import SMALL

import __spark_entry__ as entry
from compare import connect, differences
from workload.expected import expected_sql
from workload.registry import all_queries

NAMES = sorted(expected_sql())


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_each_query_has_its_sql():
    assert sorted(all_queries()) == NAMES
    assert set(NAMES) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    assert differences(entry.queries()[name](spark, SMALL), duck, entry.oracle_sql()[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
