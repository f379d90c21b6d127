"""Every query with a SQL twin gives the same rows as DuckDB; the others give rows."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference
from workload import oracle
from workload.queries import QUERIES

SQL = oracle.statements()
PLAIN = sorted(set(QUERIES) - set(SQL))


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


def test_names_match():
    assert set(SQL) <= set(QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, sf, name):
    assert difference(spark, duck, sf, QUERIES[name], SQL[name]) is None


@pytest.mark.parametrize("name", PLAIN)
def test_gives_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["label", "word", "value", "rank"]
    assert result.groupBy("label").count().count() == 2
