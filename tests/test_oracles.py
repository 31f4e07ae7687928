"""Every registered query with SQL gives the same rows as DuckDB; the others run."""

from __future__ import annotations

import pytest
from oracle import SF, assert_same

from textloom.catalogue import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, name):
    assert_same(spark, QUERIES[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows_without_sql(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
