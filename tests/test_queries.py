"""Every registered query against its SQL; those without SQL must give rows."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 100


def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns == ["event_type", "anomaly_rate"] and out.count() == 5


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, con, sf, name):
    assert compare(spark, con, name, sf) == ""
