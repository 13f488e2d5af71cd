"""Every registered query beside its SQL, on the small tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from flarebook.plans import expected
from flarebook.plans import queries as registered
from oracle import differences

TABLES = "/root/testdata/sf0.001"
QUERIES, ORACLE = registered.queries(), expected.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, TABLES), ORACLE[name], TABLES) == []


def test_entry_registers_them():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
