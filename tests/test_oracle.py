"""Every registered query against its SQL twin, at the smallest scale."""

import pytest
from compare import connect, differences, rows_of_duck, rows_of_spark

from tidemark.plans.catalog import QUERIES
from tidemark.plans.oracle import oracle

SQL = oracle()


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


def test_every_twin_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf, name):
    got = rows_of_spark(QUERIES[name](spark, sf))
    if name in SQL:
        assert differences(got, rows_of_duck(duck, SQL[name])) == []


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[:2] == ["ticker", "trade_date"]
