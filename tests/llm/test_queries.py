"""Every query of the subpackage: against its SQL twin, or for the rows that its contract asks for."""

import pytest

import __spark_entry__ as entry
from reviewlens.llm.oracle import SQL
from reviewlens.llm.queries import QUERIES
from tests.compare import connect, difference


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


def test_one_query_per_operator():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, sf, name):
    assert difference(spark, duck, sf, QUERIES[name], SQL[name]) is None
