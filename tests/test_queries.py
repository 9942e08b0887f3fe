"""Every registered query against its SQL statement on the smallest driver data."""

import pytest

import __spark_entry__ as entry
from checks import compare as comparing
from checks.compare import compare, connect
from checks.jobs import METADATA, QUERIES
from checks.oracles import metadata_sql, oracle_sql

SF = "/root/testdata/sf0.001"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    good, note = compare(spark, duck, SF, name, SQL[name])
    assert good, note


@pytest.mark.parametrize("name", sorted(METADATA))
def test_metadata_equals_sql(spark, duck, monkeypatch, name):
    monkeypatch.setattr(comparing, "QUERIES", METADATA)
    good, note = compare(spark, duck, SF, name, metadata_sql()[name])
    assert good, note


def test_queries_without_sql_return_rows(spark):
    for name in set(QUERIES) - set(SQL):
        assert QUERIES[name](spark, SF).count() > 0, name


def test_registered_queries():
    assert set(QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
