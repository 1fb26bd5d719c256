"""Every registered query against its plain SQL."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, queries
from oracle.sql import ORACLE_SQL
from tidemark.registry import QUERIES
from tests.oracle_compare import compare, connect


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, folder, duck, name):
    assert compare(QUERIES[name](spark, folder), duck, ORACLE_SQL[name]) == []
