"""Every registered query against its SQL at the smallest scale."""

import pytest

import __spark_entry__ as entry
from compare import compare, connect

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_equals_sql(spark, sf, con, name):
    query = entry.queries()[name]
    if name not in SQL:
        assert query(spark, sf).count() > 0
        return
    verdict, _ = compare(spark, con, query, SQL[name], sf)
    assert verdict == "ok"


def test_every_statement_has_a_query():
    assert set(SQL) <= set(entry.queries())


def test_entry_has_rows(spark):
    frame = entry.entry(spark)
    assert frame.columns[:3] == ["store_id", "category", "sale_hour"]
    assert frame.count() > 0
